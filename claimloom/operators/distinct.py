"""Exact distinct counts of whole-number ids by bitmaps that merge.

An id is one bit of a bitmap of 32,768 ids. Tasks build the bitmaps of the ids
they read; only bitmaps are shuffled, by bucket. Ids that are given out without
large gaps (serial numbers, also per partition) fill their bitmaps, so a
bitmap stands for thousands of ids. Ids with gaps are counted the plain way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.session import stage

BITS = 1 << 15  # ids of a bucket
#: A bucket's bitmap has 4 KB; below so many ids a bucket, shuffling the ids themselves is cheaper.
LEAST_FILL = 512
#: Relative error of the estimated number of buckets.
ESTIMATE_ERROR = 0.05

BUCKET, BITMAP, ROWS = "bucket", "bits", "rows"


def id_bitmaps(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """(by..., bucket, bits, rows): one bitmap per bucket of 32,768 ids; null ids are left out.

    A table's bitmaps can be stored with it and merged with those of other
    tables or partitions (``merge_bitmaps``), without reading the ids again.
    """
    ids = df.where(F.col(key).isNotNull())
    number = F.col(key).cast("bigint")
    return ids.groupBy(*(by or []), F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP), F.count("*").alias(ROWS)
    )


def merge_bitmaps(bitmaps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One bitmap per bucket (and ``by``) from the bitmaps of several tables or partitions."""
    return bitmaps.groupBy(*(by or []), BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP), F.sum(ROWS).alias(ROWS))


def distinct_of(bitmaps: DataFrame) -> DataFrame:
    """One row: distinct_ids, rows, surplus (rows beyond the first of their id)."""
    ids, rows = F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0)), F.coalesce(F.sum(ROWS), F.lit(0))
    return bitmaps.agg(ids.alias("distinct_ids"), rows.alias("rows"), (rows - ids).alias("surplus"))


def repeated_buckets(bitmaps: DataFrame) -> DataFrame:
    """Buckets with more rows than ids: where the ids given out twice are."""
    return bitmaps.where(F.col(ROWS) > F.bitmap_count(BITMAP)).select(BUCKET)


def repeated_ids(df: DataFrame, key: str, bitmaps: DataFrame | None = None) -> DataFrame:
    """(key, rows) of every id that occurs more than once. Only rows of buckets that hold one are grouped."""
    suspects = repeated_buckets(id_bitmaps(df, key) if bitmaps is None else bitmaps)
    rows = df.select(key).where(F.col(key).isNotNull()).withColumn(BUCKET, F.bitmap_bucket_number(F.col(key).cast("bigint")))
    counts = rows.join(suspects, BUCKET, "leftsemi").groupBy(key).agg(F.count("*").alias(ROWS))
    return counts.where(F.col(ROWS) > 1)


def distinct_by(df: DataFrame, key: str, by: list[str], out: str, aggregates: list[Column], ids: DataFrame) -> DataFrame:
    """``df`` grouped by ``by``, with ``out``, the distinct non-null ids of a group, and ``aggregates``.

    ``ids`` holds every id at least as often as ``df``, as the table does that
    ``df`` joins to unique keys. Ids that it holds once are counted as rows; only
    rows of buckets that hold one twice are told apart, so no id is shuffled where
    ids are serial numbers. Ids with gaps are counted the plain way.
    """
    if not is_dense(ids, key):
        return df.groupBy(*by).agg(F.count_distinct(key).alias(out), *aggregates)
    groups = df.groupBy(*by).agg(F.count(key).alias(out), *aggregates)
    buckets = stage(repeated_buckets(id_bitmaps(ids, key)), "repeated_buckets")
    if buckets.isEmpty():
        return groups
    rows = df.select(*by, key).withColumn(BUCKET, F.bitmap_bucket_number(key)).join(buckets, BUCKET, "leftsemi")
    named = [F.col(c).alias(f"_by_{c}") for c in by]
    surplus = rows.groupBy(*named).agg((F.count(key) - F.count_distinct(key)).alias("_surplus"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = groups.join(surplus, same, "left")
    return joined.withColumn(out, F.col(out) - F.coalesce("_surplus", F.lit(0))).select(groups.columns)


def is_key(df: DataFrame, key: str) -> bool:
    """Whether a column holds no null and no id twice, by bitmaps; false as well for ids with gaps, which are not looked at."""
    if not is_dense(df, key):
        return False
    rows, surplus = surplus_of(df, key, dense=True)
    nulls = F.coalesce(F.sum(F.when(F.col(BITMAP).isNull(), F.col(ROWS))), F.lit(0))
    return rows.agg(F.coalesce(surplus, F.lit(0)) + nulls).first()[0] == 0


def covers(dim: DataFrame, fact: DataFrame, key: str) -> bool:
    """Whether every non-null key of ``fact`` is one of ``dim``, by bitmaps of both: no key is shuffled.

    False as well where either side's keys have gaps, which are not looked at.
    """
    if not (is_dense(dim, key) and is_dense(fact, key)):
        return False
    known = id_bitmaps(dim, key).withColumn("known", F.lit(True))
    both = known.unionByName(id_bitmaps(fact, key).withColumn("known", F.lit(False)))
    both = both.groupBy(BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP), F.bitmap_or_agg(F.when(F.col("known"), F.col(BITMAP))).alias("listed"))
    return both.agg(F.coalesce(F.sum(F.bitmap_count(BITMAP) - F.bitmap_count("listed")), F.lit(0))).first()[0] == 0


def is_dense(df: DataFrame, key: str) -> bool:
    """Whether the ids of a column fill their buckets well, by an estimate of the number of buckets from one pass."""
    kind = dict(df.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        return False
    number = F.col(key).cast("bigint")
    row = df.agg(F.count(key).alias("n"), F.approx_count_distinct(F.bitmap_bucket_number(number), ESTIMATE_ERROR).alias("buckets")).first()
    # a few buckets are few bitmaps, however empty
    return row["buckets"] <= max(1024, row["n"] // LEAST_FILL)


def surplus_of(df: DataFrame, key: str, dense: bool | None = None) -> tuple[DataFrame, Column]:
    """A frame and an aggregate over it: rows of ``df`` beyond the first of each id, null ids included."""
    if is_dense(df, key) if dense is None else dense:
        nulls = df.where(F.col(key).isNull()).agg(F.count("*").alias(ROWS)).select(F.lit(None).cast("binary").alias(BITMAP), ROWS)
        parts = id_bitmaps(df, key).select(BITMAP, ROWS).unionByName(nulls)
        return parts, F.sum(ROWS) - F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0))
    return df, F.count("*") - F.count_distinct(key)
