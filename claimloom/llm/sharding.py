"""Shards of near-equal bytes by histogram sort, in DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import stage

SHARDS = 40
ROW_BYTES = 16
#: A splitter may miss its share of the bytes by this part of one shard.
TOLERANCE = 0.005
#: A key is two numbers of 60 bits, read as 12-bit digits; a round of probes settles one digit.
_DIGIT, _DIGITS = 12, 10
_SUB_BITS = 8


def _digit(i: int) -> Column:
    key, place = ("_k1", i) if i < 5 else ("_k2", i - 5)
    return F.shiftright(key, 48 - _DIGIT * place).bitwiseAND((1 << _DIGIT) - 1).cast("int")


def with_keys(docs: DataFrame) -> DataFrame:
    """Sort key of every row: text first, so equal texts are neighbours, then doc_id."""
    sixty = lambda *c: F.shiftrightunsigned(F.xxhash64(*c), 4)
    return docs.withColumns(
        {
            "_k1": sixty(F.coalesce("text", F.lit(""))),
            "_k2": sixty("doc_id"),
            "_size": (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint"),
        }
    )


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """``shards - 1`` keys; a row belongs to the shard after the last splitter at or below its key.

    Round by round, the bytes below the probes of the next digit are counted
    exactly, over all rows, for the ranges in which a splitter is still open. A
    round brings at most ``shards`` x 4096 sums to the driver, whatever the input.
    A splitter is settled when a probe is within the tolerance; only a text with
    more bytes than that is split, by doc_id, and rows that agree in both go together.
    """
    total = keys.agg(F.sum("_size")).first()[0] or 0
    targets = [total * i / shards for i in range(1, shards)]
    slack = tolerance * total / shards
    found: list[tuple[int, ...]] = [()] * (shards - 1)
    open_: dict[tuple[int, ...], tuple[int, list[int]]] = {(): (0, list(range(shards - 1)))}
    for depth in range(_DIGITS if total else 0):
        rows = keys
        for j in range(depth):  # cheap first cut, then the exact prefixes
            rows = rows.where(_digit(j).isin(sorted({p[j] for p in open_})))
        sums: dict[tuple[int, ...], list[tuple[int, int]]] = {p: [] for p in open_}
        columns = [_digit(j).alias(f"d{j}") for j in range(depth + 1)]
        for *prefix, digit, size in rows.groupBy(*columns).agg(F.sum("_size")).collect():
            if tuple(prefix) in sums:
                sums[tuple(prefix)].append((digit, size))
        still: dict[tuple[int, ...], tuple[int, list[int]]] = {}
        for prefix, (below, waiting) in open_.items():
            digits, ends = [], [below]
            for digit, size in sorted(sums[prefix]):
                digits.append(digit)
                ends.append(ends[-1] + size)
            for i in waiting:
                at = min(max(bisect_left(ends, targets[i]) - 1, 0), len(digits) - 1)
                low, high = ends[at], ends[at + 1]
                near = low if targets[i] - low <= high - targets[i] else high
                if abs(targets[i] - near) <= slack or depth == _DIGITS - 1:
                    found[i] = (*prefix, digits[at] + (near == high))
                else:
                    still.setdefault((*prefix, digits[at]), (low, []))[1].append(i)
        open_ = still
        if not open_:
            break
    return [_numbers(digits) for digits in found]


def _numbers(digits: tuple[int, ...]) -> tuple[int, int]:
    """A splitter's two key numbers; a digit of 4096 carries into the one before."""
    value = 0
    for i in range(_DIGITS):
        value = (value << _DIGIT) + (digits[i] if i < len(digits) else 0)
    return value >> 60, value & ((1 << 60) - 1)


def histogram_shards(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row of ``docs`` with shard (0 to ``shards`` - 1), slot (0, 1, ... inside the shard) and size.

    size is the UTF-8 length of ``text`` (null: 0) plus 16. Shards differ from an
    equal share of the bytes by the tolerance at both ends, or by what a single
    row weighs where that is more. Equal texts are in one shard unless they
    outweigh the tolerance. Rows without a doc_id take part like others. An
    empty table gives no rows. Columns of the input called shard, slot or size are replaced.

    The rows move once: by (shard, first digit, part of the second number), which
    bounds what a task sorts even where one text makes up a third of the rows.
    """
    docs = docs.drop("shard", "slot", "size")
    keys = stage(with_keys(docs.select("doc_id", "text")).select("_k1", "_k2", "_size"), "shard_keys")
    bounds = splitters(keys, shards, tolerance)
    places = []
    for digit in range(1 << _DIGIT):
        inside = [b for b in bounds if b[0] >> 48 == digit]
        places.append((digit, sum(b[0] >> 48 < digit for b in bounds), inside))
    # 4096 rows whatever the input: where a first digit's rows start, and the splitters among them
    lookup = docs.sparkSession.createDataFrame(places, "_digit int, _base int, _bounds array<struct<a:bigint,b:bigint>>")

    def placed(rows: DataFrame) -> DataFrame:
        key = F.struct(F.col("_k1").alias("a"), F.col("_k2").alias("b"))
        after = F.size(F.filter("_bounds", lambda x: x <= key))
        sub = F.shiftright("_k2", 60 - _SUB_BITS).cast("int")
        found = rows.withColumn("_digit", _digit(0)).join(F.broadcast(lookup), "_digit")
        return found.withColumns({"shard": F.col("_base") + after, "_sub": sub}).drop("_base", "_bounds")

    bins = placed(keys).groupBy("shard", "_digit", "_sub").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_digit", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.select("shard", "_digit", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = placed(with_keys(docs)).join(starts, ["shard", "_digit", "_sub"])
    inside = Window.partitionBy("shard", "_digit", "_sub").orderBy("_k1", "_k2")
    slot = F.col("_start") + F.row_number().over(inside) - 1
    return rows.select(*docs.columns, F.col("_size").alias("size"), "shard", slot.cast("bigint").alias("slot"))
