"""Feed configs (YAML) and database connection options. Read once, on the driver."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

import yaml


# --- Fixed values: defaults of the config files ---------------------------------
DATASET_FOLDER = "data/kaggle/{name}"
DB_DEFAULTS = {"host": "localhost", "port": 5432, "database": "insurdb"}


@dataclass(frozen=True)
class FeedConfig:
    """What to read and how to map it. Paths in ``files`` are ready to open."""

    feed_id: str
    name: str
    files: Mapping[str, str]
    column_map: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    defaults: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    csv_options: Mapping[str, object] = field(default_factory=dict)


def _read_yaml(path: str):
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)


def read_client_config(path: str) -> FeedConfig:
    """A client's own files; paths are taken as written."""
    raw = _read_yaml(path)
    if not isinstance(raw, dict):
        found = "empty file" if raw is None else type(raw).__name__
        raise ValueError(f"{path}: expected a mapping of settings, found {found}")
    client = raw.get("client_id")
    if not client:
        raise ValueError(f"{path}: no client_id")
    if not raw.get("files"):
        raise ValueError(f"{path}: no files; at least the claims file must be named")
    return FeedConfig(
        feed_id=str(client),
        name=raw.get("client_name", client),
        files=raw["files"],
        column_map=raw.get("column_map") or {},
        defaults=raw.get("defaults") or {},
        csv_options=raw.get("csv_options") or {},
    )


def read_dataset_config(path: str, active: str | None = None) -> FeedConfig:
    """One of several named datasets; file paths are relative to the dataset's folder."""
    raw = _read_yaml(path) or {}
    name = active or raw.get("active_dataset")
    if not name:
        raise ValueError(f"{path}: no dataset chosen (active_dataset)")
    datasets = raw.get("datasets") or {}
    if name not in datasets:
        raise KeyError(f"{path}: no dataset {name!r}, only {sorted(datasets)}")
    chosen = datasets[name]
    folder = chosen.get("dest_dir", DATASET_FOLDER.format(name=name)).rstrip("/")
    files = {role: f"{folder}/{file}" for role, file in (chosen.get("files") or {}).items()}
    return FeedConfig(
        feed_id=name,
        name=name,
        files=files,
        column_map=chosen.get("column_map") or {},
        defaults=chosen.get("defaults") or {},
        csv_options=chosen.get("csv_options") or {},
    )


# ---- JDBC ----------------------------------------------------------------------
def read_db_config(path: str, env: Mapping[str, str] | None = None) -> dict:
    """Settings of a database config file with ``${NAME}`` replaced from the environment."""
    env = os.environ if env is None else env
    raw = (_read_yaml(path) or {}) if os.path.exists(path) else {}
    whole = re.compile(r"^\$\{(.*)\}$", re.DOTALL)

    def expand(value):
        match = whole.match(value) if isinstance(value, str) else None
        return env.get(match.group(1)) if match else value

    return {key: expand(value) for key, value in raw.items()}


def jdbc_options(config: Mapping[str, object], env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``: URL from the environment, else config, else host parts."""
    env = os.environ if env is None else env
    url = env.get("DATABASE_URL") or config.get("engine_url")
    if url:
        return _from_url(str(url))

    def part(variable: str, key: str) -> str:
        value = env.get(variable, config.get(key, DB_DEFAULTS.get(key)))
        if value is None:
            raise ValueError(f"database {key} is not set: {variable} in the environment or '{key}' in the config")
        return str(value)

    return {
        "url": f"jdbc:postgresql://{part('DB_HOST', 'host')}:{part('DB_PORT', 'port')}/{part('DB_NAME', 'database')}",
        "user": part("DB_USER", "user"),
        "password": part("DB_PASS", "password"),
        "driver": "org.postgresql.Driver",
    }


def _from_url(url: str) -> dict[str, str]:
    match = re.match(r"^(?:jdbc:)?(\w+)(?:\+\w+)?://(?:([^:/@]+)(?::([^@]*))?@)?(.+)$", url)
    if not match:
        raise ValueError("not a database URL")
    kind, user, password, rest = match.groups()
    kind = {"postgres": "postgresql"}.get(kind, kind)
    out = {"url": f"jdbc:{kind}://{rest}"}
    if user:
        out["user"] = unquote(user)
    if password:
        out["password"] = unquote(password)
    if kind == "postgresql":
        out["driver"] = "org.postgresql.Driver"
    return out
