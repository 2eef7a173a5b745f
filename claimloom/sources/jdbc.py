"""Operational tables read over JDBC, columns pruned at the source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from claimloom.model import ROLE_TABLE


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    schema: str = "insurance",
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
) -> DataFrame:
    """A lazy table scan; with a numeric key and its bounds the read is split into ranges.

    Bounds only place the splits, rows outside them are still read.
    """
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", f"{schema}.{table}")
    reader = reader.option("fetchsize", 10_000)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def read_operational(
    spark: SparkSession, connection: Mapping[str, str], schema: str = "insurance", partitions: int = 32
) -> dict[str, DataFrame]:
    """The operational tables, each read in ranges of its key: one small query per table asks for the key's bounds."""
    out = {}
    for name, fields in ROLE_TABLE.values():
        key = fields.fieldNames()[0]
        ask = f"(SELECT min({key}) AS low, max({key}) AS high FROM {schema}.{name}) bounds"
        low, high = spark.read.format("jdbc").options(**connection).option("dbtable", ask).load().first()
        bounds = (low, high + 1) if low is not None else None
        out[name] = read_table(spark, connection, name, schema, key, bounds, partitions)
    return out
