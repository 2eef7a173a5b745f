"""Session helpers: a local builder for tests and bench, and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


SHUFFLED_SHARE = 0.2  # of a feed's bytes; keys, dates and amounts move, texts mostly do not
PARTITION_BYTES = 256 << 20


def local_session(cores: int | str = 8, app: str = "claimloom", **conf) -> SparkSession:
    """Single-JVM session for tests and bench; clusters bring their own session."""
    settings = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables (``spark.checkpoint.dir``).

    Where that is unset, a folder in the warehouse; on a cluster it must not be a
    local one, which other machines cannot see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return shared.rstrip("/")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is a local folder")
    return folder


_run_folder: ContextVar[str | None] = ContextVar("claimloom_run_folder", default=None)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Drop what ``stage`` wrote inside the scope when it ends (a batch would leave a copy of its feed)."""
    folder = f"{work_folder(spark)}/claimloom/{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Stored size of files or folders."""
    conf = spark._jsc.hadoopConfiguration()
    jpaths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in jpaths)


@contextmanager
def sized_for(spark: SparkSession, size: int) -> Iterator[int]:
    """Raise the shuffle partitions to fit an input of ``size`` bytes, for the time of a batch.

    A session default of 200 would make partitions of 100 GB out of a 100 TB
    feed. Too many do no harm on small data: adaptive execution merges them.
    """
    key = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(key))
    wanted = max(before, int(size * SHUFFLED_SHARE / PARTITION_BYTES))
    spark.conf.set(key, wanted)
    try:
        yield wanted
    finally:
        spark.conf.set(key, before)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, inside the current staging scope if there is one."""
    folder = _run_folder.get() or f"{work_folder(spark)}/claimloom"
    return f"{folder}/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a value must not change if a task is run again (row order of a
    text scan) or where a result is read many times. Parquet rather than
    ``checkpoint()``, so that later readers prune columns.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
