"""Stored tables with all-or-nothing refresh.

A refresh writes every table under a new version folder and then adds one small
commit row. Readers take the newest committed version, so they never see half
a refresh, and a job that dies leaves only an uncommitted folder behind.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

logger = logging.getLogger(__name__)

COMMIT = (
    "version string, tables array<struct<name: string, rows: bigint, fields: string, nulls: map<string, bigint>, totals: map<string, decimal(38,2)>>>"
)

#: Columns whose exact total is kept with a table: money, by their names' ends.
MONEY = ("_amount", "_total")


@dataclass(frozen=True)
class TableStats:
    """What a table's write has counted: rows, null values per column, totals of its money columns (null: none)."""

    rows: int
    nulls: Mapping[str, int]
    totals: Mapping[str, Decimal | None]


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], TableStats]]:
    """``df``, and what gives its statistics after it was written.

    The counts are made by the writing tasks themselves, directly before the
    rows go to their files: a task that runs again counts once, and no row is
    read for them.
    """
    counted = Observation()
    money = [c for c, kind in df.dtypes if c.endswith(MONEY) and kind.startswith(("decimal", "double", "float"))]
    cents = lambda c: F.sum(F.col(f"`{c}`").cast("decimal(28,2)"))
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    metrics += [cents(c).alias(f"t{i}") for i, c in enumerate(money)]

    def stats() -> TableStats:
        found = counted.get
        return TableStats(found["rows"], {c: found[f"n{i}"] for i, c in enumerate(df.columns)}, {c: found[f"t{i}"] for i, c in enumerate(money)})

    return df.observe(counted, *metrics), stats


def _paths(root: str) -> tuple[str, str]:
    root = root.rstrip("/")
    return f"{root}/versions", f"{root}/commits"


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    check: Callable[[dict[str, DataFrame], dict[str, TableStats]], None] | None = None,
) -> str:
    """Write ``tables`` as the new version of ``root`` and commit it; returns the version.

    ``check`` sees the written tables (not the plans that made them, which would
    run again) and what their writes counted, and may raise: then nothing is
    committed and the last version stays. The counts are committed with the tables.
    """
    versions, commits = _paths(root)
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    written, stats = {}, {}
    for name, df in tables.items():
        keys = (partition_by or {}).get(name)
        rows, counted = observed(df)
        writer = rows.write.partitionBy(*keys) if keys else rows.write
        writer.option("compression", "zstd").parquet(f"{versions}/{version}/{name}")
        stats[name] = counted()
        written[name] = spark.read.schema(df.schema).parquet(f"{versions}/{version}/{name}")
        logger.info("%s: %d rows", name, stats[name].rows)
    if check:
        check(written, stats)
    entries = [(name, stats[name].rows, df.schema.json(), stats[name].nulls, stats[name].totals) for name, df in written.items()]
    commit = spark.createDataFrame([(version, entries)], COMMIT)
    commit.coalesce(1).write.mode("append").json(commits)
    return version


def table_stats(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, rows, column_name, nulls, total) of the newest version, from its commit; no table is read."""
    _, commits = _paths(root)
    newest = _commits(spark, commits).agg(F.max_by("tables", "version").alias("tables")).select(F.inline("tables"))
    columns = newest.select(F.col("name").alias("table_name"), "rows", "totals", F.explode("nulls").alias("column_name", "nulls"))
    return columns.select("table_name", "rows", "column_name", "nulls", F.try_element_at("totals", F.col("column_name")).cast("double").alias("total"))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all versions but the last ``keep`` committed ones; returns their names.

    An uncommitted version older than the newest commit belongs to a job that
    failed and goes too; one that is newer may still be written and stays.
    """
    versions, commits = _paths(root)
    committed = sorted(r[0] for r in _commits(spark, commits).select("version").collect()) if _exists(spark, commits) else []
    if not committed:
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(versions)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(s.getPath().getName() for s in files.listStatus(folder))
    gone = [v for v in found if v < committed[-1] and v not in committed[-keep:]]
    for version in gone:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{versions}/{version}"), True)
    return gone


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _commits(spark: SparkSession, commits: str) -> DataFrame:
    return spark.read.schema(COMMIT).json(commits)


def current_version(spark: SparkSession, root: str) -> tuple[str, dict[str, StructType]] | None:
    """The newest committed version and the schema of each of its tables."""
    _, commits = _paths(root)
    try:
        log = _commits(spark, commits)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = log.agg(F.max_by(F.struct("version", "tables"), "version").alias("c")).first()["c"]
    return (newest["version"], {t["name"]: StructType.fromJson(json.loads(t["fields"])) for t in newest["tables"]}) if newest else None


def version_folder(root: str, version: str) -> str:
    return f"{_paths(root)[0]}/{version}"


def open_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest committed version (empty if nothing was ever committed)."""
    current = current_version(spark, root)
    if current is None:
        return {}
    version, schemas = current
    return {n: spark.read.schema(fields).parquet(f"{version_folder(root, version)}/{n}") for n, fields in schemas.items()}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables listable and queryable by name in this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())
