"""Sources mixed to target weights along a time-varying curriculum, in DataFrame operations only.

Each source has a weight schedule over the run. Its integral, scaled to the
source's target, is the source's cumulative demand of words. A document that
starts at word ``c`` of its source is read where that demand reaches ``c``:
the inverse of the integral gives its position, and a range sort by position
gives the order of training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.ordinals import ORD, stage_in_order
from claimloom.session import stage

#: Weights of the sources in code point order, taken in turn.
WEIGHTS = (3, 1, 2)
#: Schedules in turn: (time, relative weight) from 0 to 1, straight lines between.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
SHARE = 1.5  # words of the mix as a share of all words
REPEATS = 2  # times that a document may be read
HEAVY = 1000  # a key with more than this part of all rows is split by where its rows are stored
_BIN_DIGITS = 4  # hex digits: 65,536 bins a source

_SOURCE = ["_src", "_null"]
_BIN = [*_SOURCE, "_bin", "_sub"]


def word_count(text: Column) -> Column:
    """Runs of anything but space and the five ASCII control spaces; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def inverse_demand(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of ``schedule`` has reached ``share`` (0 to 1) of its whole."""
    spans = list(zip(schedule, schedule[1:]))
    areas = [(w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in spans]
    end = F.lit(float(schedule[-1][0]))
    found = end
    for k in reversed(range(len(spans))):
        (t0, w0), (t1, w1) = spans[k]
        rest = share * F.lit(sum(areas)) - F.lit(float(sum(areas[:k])))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * (w1 - w0) / (t1 - t0)) * rest, F.lit(0.0)))
        at = F.lit(t0) + F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(0.0)
        found = F.when(rest < areas[k], at).otherwise(found)
    return F.least(found, end)


def source_targets(sources: DataFrame, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (size and weight of each) with ``target``: words that the mix takes of it.

    The targets share ``share`` of all words by weight. One that would be above
    ``repeats`` times its source's size stops there, and what it leaves over is
    shared again by weight, until none is above. A round brings three sums to the driver.
    """
    cap = F.col("size") * repeats
    whole, weights = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1))).first()
    open_, stopped = (share * whole, float(weights)), 0
    while True:
        wanted = F.lit(open_[0]) * F.col("weight") / F.lit(open_[1])
        above = wanted > cap
        row = sources.agg(
            F.count_if(above), F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if row[0] == stopped:
            return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(wanted))
        stopped, open_ = row[0], (share * whole - row[1], float(row[2]))


def _sum_before(value: str, by: list[str], order: list[str]) -> Column:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _with_bins(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``_sub`` and ``_part``: bins of a source, in the order of its keys, none with a great share of the rows.

    A bin takes one range of hashed keys. Only a key that many rows share can
    make it heavy; such a key (fewer than ``HEAVY`` of them) is a part of its own,
    split by the partition that stored its rows. Rows with one key are alike, so
    it does not matter to the result which of them comes first.
    """
    limit = keyed.count() // HEAVY
    full = keyed.groupBy(*_SOURCE, "_bin").count().where(F.col("count") > limit).drop("count")
    shared = keyed.join(F.broadcast(full), [*_SOURCE, "_bin"], "leftsemi").groupBy(*_SOURCE, "_bin", "_key").count()
    heavy = shared.where(F.col("count") > limit).groupBy(*_SOURCE, "_bin").agg(F.sort_array(F.collect_list("_key")).alias("_heavy"))
    heavy = stage(heavy, "heavy_keys")
    lower = F.size(F.filter("_heavy", lambda k: k < F.col("_key")))
    own = F.array_contains("_heavy", F.col("_key"))
    sub = F.when(F.col("_heavy").isNull(), 0).otherwise(2 * lower + own.cast("int"))
    part = F.when(F.coalesce(own, F.lit(False)), F.shiftright("_row", 33)).otherwise(0)
    return keyed.join(F.broadcast(heavy), [*_SOURCE, "_bin"], "left").withColumns({"_sub": sub, "_part": part}).drop("_heavy")


def curriculum(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    repeats: int = REPEATS,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
) -> DataFrame:
    """Every row of ``docs`` with source_size, target, taken and reads, range-sorted by the position of its first read.

    ``size_col`` holds a row's words (null or negative: 0). Sources in code point
    order, null last as a source of its own, take ``weights`` and ``schedules`` in turn.
    ``reads`` has one struct (position from 0 to 1, words) for each time the mix reads the row: the
    source's rows, in the order of a hash of doc_id, are read from the first on
    until its target is reached, and again from the first up to ``repeats`` times.
    So ``taken`` of a source adds up to the whole part of its target, and the last
    read of a source may end inside a document. Rows without words have no reads;
    rows without reads come last. Rows that agree in source, doc_id and size are
    interchangeable; all others get the same reads in every run. Input columns called
    source_size, target, taken or reads are replaced. An empty table gives no rows.

    The rows are stored once with what columns they have (pass no texts where
    only the plan is wanted), dealt once by source and bin, and once by position.
    """
    docs = docs.drop("source_size", "target", "taken", "reads")
    columns = docs.columns
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    hashed = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    keyed = docs.withColumns(
        {
            "_src": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
            "_null": F.col(source_col).isNull(),
            "_size": size,
            "_key": F.concat(hashed, F.lpad(F.hex(size), 16, "0")),
            "_bin": F.substring(hashed, 1, _BIN_DIGITS),
            "_row": F.monotonically_increasing_id(),
        }
    )
    keyed = stage(keyed, "mix_rows")
    sizes = keyed.groupBy(*_SOURCE).agg(F.sum("_size").alias("size"))
    turn = lambda n: (F.col(ORD) % n).cast("int")
    sources = stage_in_order(sizes, ["_null", "_src"], "mix_sources").withColumns(
        {"weight": F.element_at(F.lit(list(weights)), turn(len(weights)) + 1), "_shape": turn(len(schedules))}
    )
    sources = source_targets(stage(sources, "mix_weights"), share, repeats)

    rows = _with_bins(keyed)
    parts = stage(rows.groupBy(*_BIN, "_part").agg(F.sum("_size").alias("_words")), "mix_bins")
    bins = parts.groupBy(*_BIN).agg(F.sum("_words").alias("_words"))
    # sums before a bin in two steps of at most 256 bins (and the keys split off), not one over all bins of a source
    top = [*_SOURCE, "_top"]
    bins = bins.withColumn("_top", F.substring("_bin", 1, _BIN_DIGITS // 2))
    tops = bins.groupBy(*top).agg(F.sum("_words").alias("_words"))
    tops = tops.select(*top, _sum_before("_words", _SOURCE, ["_top"]).alias("_above"))
    bins = bins.select(*_BIN, "_top", _sum_before("_words", top, ["_bin", "_sub"]).alias("_within")).join(tops, top)
    bins = bins.select(*_BIN, (F.col("_above") + F.col("_within")).alias("_first"))
    starts = parts.select(*_BIN, "_part", _sum_before("_words", _BIN, ["_part"]).alias("_inside")).join(bins, _BIN)
    starts = starts.join(sources.select(*_SOURCE, F.col("size").alias("source_size"), "target", "_shape"), _SOURCE)

    start = F.col("_first") + F.col("_inside") + _sum_before("_size", [*_BIN, "_part"], ["_key", "_row"])
    placed = rows.join(starts, [*_BIN, "_part"]).withColumn("_start", start)

    def read(again: Column) -> Column:
        at = F.col("_start") + again * F.col("source_size")
        words = F.greatest(F.least(F.col("_size"), F.floor("target") - at), F.lit(0))
        part = F.try_divide(at, F.col("target"))
        position = F.lit(None).cast("double")
        for k, schedule in enumerate(schedules):
            position = F.when(F.col("_shape") == k, inverse_demand(part, schedule)).otherwise(position)
        return F.struct(position.alias("position"), words.cast("bigint").alias("words"))

    reads = F.filter(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), read), lambda r: r["words"] > 0)
    taken = F.aggregate("reads", F.lit(0).cast("bigint"), lambda n, r: n + r["words"])
    done = placed.withColumn("reads", reads).withColumns({"taken": taken, "_at": F.get("reads", F.lit(0))["position"]})
    return done.orderBy(F.col("_at").asc_nulls_last(), "_key", "_row").select(*columns, "source_size", "target", "taken", "reads")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each read of the result of ``curriculum``, range-sorted by ``position``; ``words`` of it are read."""
    reads = mixed.drop("position", "words").select("*", F.inline("reads")).drop("reads")
    return reads.orderBy("position")
