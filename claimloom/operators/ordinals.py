"""Gap-free row numbers without sending all rows through one task.

A plain ``row_number() over (order by ...)`` pulls the whole table into one
partition. Here every window partition has a size bound that does not depend
on the data: offsets come from counts per input block or per ordinal bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import stage

SRC_FILE, SRC_BLOCK, SRC_SEQ = "_src_file", "_src_block", "_src_seq"
ORD = "_ord"

BUCKET = 1 << 20  # ordinals per window partition
BUCKETS_PER_GROUP = 1 << 12


def tag_source_order(scan: DataFrame, columns: list[Column]) -> DataFrame:
    """Project a text scan and record file, block and position of each row.

    The position is only stable once written, so stage the result before use.
    """
    return scan.select(
        *columns,
        F.col("_metadata.file_path").alias(SRC_FILE),
        F.col("_metadata.file_block_start").alias(SRC_BLOCK),
        F.monotonically_increasing_id().alias(SRC_SEQ),
    )


def tag_by_file(scan: DataFrame, columns: list[Column]) -> tuple[DataFrame, DataFrame | None]:
    """``tag_source_order`` with a hash of the path for a tag, and the paths for ``add_file_ordinal``.

    A number costs a tenth of a long path to store and to join by; the driver's
    list of the files gives the paths back. Should two paths have one hash, rows
    carry the paths.
    """
    paths = scan.sparkSession.createDataFrame([(path,) for path in set(scan.inputFiles())], "_path string")
    paths = paths.select(F.xxhash64("_path").alias(SRC_FILE), "_path")
    if not paths.groupBy(SRC_FILE).count().where("count > 1").isEmpty():
        return tag_source_order(scan, columns), None
    rows = scan.select(
        *columns,
        F.xxhash64(F.input_file_name()).alias(SRC_FILE),  # spelt as the list spells it
        F.col("_metadata.file_block_start").alias(SRC_BLOCK),
        F.monotonically_increasing_id().alias(SRC_SEQ),
    )
    return rows, paths


def stage_in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sort, store, and add ``_ord`` by position: an ordinal in the order of ``keys``.

    The sort is range partitioned; part files carry the range order in their
    number and Parquet knows each row's position in its file.
    """
    stored = stage(df.orderBy(*keys), name)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    tagged = stored.select(
        "*",
        F.concat(F.lpad(part, 10, "0"), F.col("_metadata.file_name")).alias(SRC_FILE),
        F.lit(0).cast("bigint").alias(SRC_BLOCK),
        F.col("_metadata.row_index").alias(SRC_SEQ),
    )
    return add_file_ordinal(tagged)


def _sum_before(value: str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def add_file_ordinal(staged: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Replace the source tags by ``_ord``: 0, 1, 2, ... in file-name and row order.

    ``paths`` gives the path (``_path``) of each file where the tag is not the path itself.

    Positions within a block are consecutive, so a row's ordinal is its position
    plus a shift known per block. Only the block table goes through windows: one
    row per block, and the file list the driver holds anyway. The counts are
    stored, so that the rows are counted once, and so are the shifts, so that
    readers of the result do not count again.
    """
    blocks = staged.groupBy(SRC_FILE, SRC_BLOCK).agg(
        F.count("*").alias("_rows"), F.min(SRC_SEQ).alias("_first")
    )
    blocks = stage(blocks, "block_counts")
    files = blocks.groupBy(SRC_FILE).agg(F.sum("_rows").alias("_file_rows"))
    by = SRC_FILE
    if paths is not None:
        by, lost = "_path", F.raise_error(F.lit("a file of the scan is not in the list of its files")).cast("string")
        files = files.join(paths, SRC_FILE, "left").withColumn(by, F.coalesce(by, lost))
    files = files.select(SRC_FILE, _sum_before("_file_rows", Window.orderBy(by)).alias("_file_shift"))
    in_file = Window.partitionBy(SRC_FILE).orderBy(SRC_BLOCK)
    shifts = (
        blocks.withColumn("_block_shift", _sum_before("_rows", in_file))
        .join(files, SRC_FILE)
        .select(
            SRC_FILE,
            SRC_BLOCK,
            (F.col("_file_shift") + F.col("_block_shift") - F.col("_first")).alias("_shift"),
        )
    )
    return (
        staged.join(stage(shifts, "block_shifts"), [SRC_FILE, SRC_BLOCK])
        .withColumn(ORD, F.col(SRC_SEQ) + F.col("_shift"))
        .drop(SRC_FILE, SRC_BLOCK, SRC_SEQ, "_shift")
    )


def number_by_ordinal(df: DataFrame, ordinal: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """Number rows 1..n in the order of a distinct non-negative BIGINT column with gaps.

    Rows are numbered per bucket of ordinals: distinct ordinals mean that no
    bucket can hold more than ``bucket`` rows, so every window stays bounded
    however they are spread. ``df`` is read twice: pass a stored frame.
    """
    rows = df.withColumn("_bucket", F.expr(f"`{ordinal}` div {bucket}"))
    counts = (
        rows.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_group", F.expr(f"_bucket div {BUCKETS_PER_GROUP}"))
    )
    groups = counts.groupBy("_group").agg(F.sum("_rows").alias("_group_rows"))
    groups = groups.select("_group", _sum_before("_group_rows", Window.orderBy("_group")).alias("_group_shift"))
    shifts = (
        counts.withColumn("_bucket_shift", _sum_before("_rows", Window.partitionBy("_group").orderBy("_bucket")))
        .join(groups, "_group")
        .select("_bucket", (F.col("_group_shift") + F.col("_bucket_shift")).alias("_shift"))
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(ordinal))
    return (
        rows.withColumn("_position", position)
        .join(shifts, "_bucket")
        .withColumn(out, (F.col("_position") + F.col("_shift")).cast("bigint"))
        .drop("_bucket", "_position", "_shift")
    )
