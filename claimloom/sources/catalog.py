"""Committed tables under names in the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources import store


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register(spark: SparkSession, root: str, database: str) -> list[str]:
    """Point the names of ``database`` at the newest committed version of ``root``; returns them.

    Called after a commit. A name is a view over the version's files, replaced in
    one step, so a reader sees the old version or the new one. A refresh that
    fails commits nothing and calls nothing: the names stay readable as they were.
    A table that the new version no longer has loses its name.
    """
    current = store.current_version(spark, root)
    if current is None:
        return []
    version, schemas = current
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    for name, fields in schemas.items():
        columns = ", ".join(f"CAST({_quoted(f.name)} AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in fields)
        path = f"{store.version_folder(root, version)}/{name}".replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database)}.{_quoted(name)} AS SELECT {columns} FROM parquet.`{path}`")
    for name in list_names(spark, database):
        if name not in schemas:
            spark.sql(f"DROP VIEW {_quoted(database)}.{_quoted(name)}")
    return sorted(schemas)


def list_names(spark: SparkSession, database: str) -> list[str]:
    rows = spark.sql(f"SHOW VIEWS IN {_quoted(database)}").where("NOT isTemporary")
    return sorted(r["viewName"] for r in rows.collect())  # one row a table


def preview(spark: SparkSession, database: str, name: str, rows: int = 10) -> DataFrame:
    return spark.table(f"{_quoted(database)}.{_quoted(name)}").limit(rows)


def described(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, columns, rows) of every registered table, counted in one frame."""
    out = None
    for name in list_names(spark, database):
        table = spark.table(f"{_quoted(database)}.{_quoted(name)}")
        row = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), F.lit(len(table.columns)).alias("columns"), "rows")
        out = row if out is None else out.unionByName(row)
    return spark.createDataFrame([], "table_name string, columns int, rows bigint") if out is None else out
