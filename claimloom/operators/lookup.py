"""Dictionary lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_fill(df: DataFrame, source: str, target: str, mapping: Mapping[str, str], default: str = "") -> DataFrame:
    """Add ``target`` = mapping[source], or ``default`` where there is no entry.

    The dictionary is a driver-side argument whose size Spark knows, so Spark
    chooses the join.
    """
    spark = df.sparkSession
    table = spark.createDataFrame(list(mapping.items()), f"`{source}` string, `_hit` string")
    hit = F.coalesce(F.col("_hit"), F.lit(default)).alias(target)
    return df.join(table, source, "left").select(*[F.col(c) for c in df.columns if c != target], hit)
