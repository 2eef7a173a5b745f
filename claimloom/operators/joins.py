"""Joins that hold when one key carries a large share of the fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Null keys of a left join match nothing, so they may go anywhere; they are dealt to so many buckets.
NULL_BUCKETS = 4096


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join fact rows to a dimension that is unique on ``key`` (inner or left).

    No broadcast hint: Spark broadcasts the dimension when its measured size is
    under the session's threshold and shuffles both sides otherwise. A hot key
    then lands in one reduce partition, which adaptive execution splits. In a
    left join the null keys, which match nothing, are spread by a hash of their
    row in any session.
    """
    if how != "left":
        return fact.join(dim, key, how)
    row = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(NULL_BUCKETS)).cast("int")
    left = fact.withColumn("_null_bucket", F.when(F.col(key).isNull(), row + 1).otherwise(0))
    right = dim.withColumnRenamed(key, "_dim_key")
    # always 0, but no literal: the optimizer would take a literal out of the keys that rows are dealt by
    right = right.withColumn("_dim_bucket", F.pmod(F.xxhash64("_dim_key"), F.lit(1)).cast("int"))
    same = (F.col(key) == F.col("_dim_key")) & (F.col("_null_bucket") == F.col("_dim_bucket"))
    return left.join(right, same, "left").drop("_null_bucket", "_dim_key", "_dim_bucket")


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Per fact key without a dimension row, its number of fact rows (null keys included).

    Fact rows are counted per key before the shuffle, so a key that fills a
    third of the table travels as one row per task.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("rows"))
    return per_key.join(dim.select(key), key, "left_anti")


def missing_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null fact keys absent from the dimension."""
    return orphan_rows(fact, dim, key).filter(F.col(key).isNotNull()).select(key)
