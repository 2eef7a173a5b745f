"""Exact order statistics and quantiles with bounded memory.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here
a first pass makes a mergeable quantile sketch per series, which brackets the
wanted ranks; a second pass counts exactly what is below and inside the
brackets. Where a bracket holds many values it is cut into ``SLICES`` slices,
and only a slice with more than one value needs a further pass over its rows.
A sketch may be wrong: the counts tell, and the search goes on where the rank is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICES = 1 << 14
SKETCH_K = 4096  # items of a sketch's widest level; some 100 KB a series
MARGIN = 0.002  # of the rows, on both sides of a rank: over twice the error of such a sketch


@dataclass(frozen=True)
class Series:
    """Values to rank: a column, null where a row takes no part; whole numbers are BIGINT, others DOUBLE."""

    value: Column
    whole: bool = True


@dataclass(frozen=True)
class Span:
    """Size, value range and sketch of a series."""

    rows: int
    low: float
    high: float
    sketch: bytes


@dataclass(frozen=True)
class Target:
    """Find the value of 0-based ``rank``; it is taken to be from ``low`` to ``high``."""

    series: str
    rank: int
    low: float
    high: float


def in_units(amount: Column, scale: int) -> Column:
    """A DECIMAL or whole number as BIGINT multiples of 10^-scale (fails if it does not fit)."""
    return (amount * 10**scale).cast("bigint")


def sketch_of(series: Series) -> Column:
    """Aggregate: rows, low, high and sketch of a series."""
    v = series.value
    make = F.kll_sketch_agg_bigint if series.whole else F.kll_sketch_agg_double
    named = {"rows": F.count(v), "low": F.min(v), "high": F.max(v), "sketch": make(v, F.lit(SKETCH_K))}
    return F.struct(*[c.alias(n) for n, c in named.items()])


def sketched_quantiles(sketch: Column, probabilities: Sequence[float], whole: bool = True) -> Column:
    """Approximate quantiles (an array of values that occur) of a sketch, within about 0.1 % of the rows in rank."""
    ask = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
    return ask(sketch, F.lit(list(map(float, probabilities))))


def merge_sketches(sketch: Column, whole: bool = True) -> Column:
    """Aggregate: one sketch of all rows behind several sketches."""
    return (F.kll_merge_agg_bigint if whole else F.kll_merge_agg_double)(sketch, F.lit(SKETCH_K))


def _brackets(spark: SparkSession, series: Mapping[str, Series], spans: Mapping[str, Span], wanted: list[tuple[str, int]]) -> list[Target]:
    """The value range that should hold each rank; the sketches are asked in one small job of a row a series."""
    ends: dict[str, list[float]] = {}
    for name, rank in wanted:
        n = spans[name].rows
        ends.setdefault(name, []).extend([max(rank / n - MARGIN, 0.0), min((rank + 1) / n + MARGIN, 1.0)])
    asked = [sketched_quantiles(F.lit(bytes(spans[name].sketch)), points, series[name].whole) for name, points in ends.items()]
    found = dict(zip(ends, spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(asked)]).first()))
    out, at = [], dict.fromkeys(ends, 0)
    for name, rank in wanted:
        k, span = at[name], spans[name]
        low = span.low if ends[name][k] == 0.0 else found[name][k]
        high = span.high if ends[name][k + 1] == 1.0 else found[name][k + 1]
        at[name] = k + 2
        out.append(Target(name, rank, low, high))
    return out


def _slice(value: Column, low: float, high: float, slices: int, whole: bool) -> Column:
    """Slice of a value: grows with it, and the ends of the range are never in the same slice.

    Whole numbers are cut by an arithmetic shift, which cannot overflow however
    far apart the ends are; doubles by their share of the range.
    """
    if low == high:
        return F.lit(0).cast("bigint")
    if whole:
        shift = next(s for s in range(64) if (high >> s) - (low >> s) < slices)
        return F.shiftright(value, shift)
    # halves, as the width of a range may exceed the largest double
    share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    return F.least(F.floor(share * slices), F.lit(slices - 1)).cast("bigint")


def _disjoint(ranges: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _cell(number: int, series: Series, ranges: list[tuple[float, float]], slices: int, inside_only: bool) -> Column:
    """Where a value stands: its region (odd: a range, even: between ranges) and its slice of the range."""
    v, nothing = series.value, F.lit(0).cast("bigint")
    at = lambda region, part: F.struct(
        F.lit(number).alias("_series"), F.lit(region).alias("_region"), part.alias("_slice"),
        (v if series.whole else F.lit(None)).cast("bigint").alias("_whole"), (F.lit(None) if series.whole else v).cast("double").alias("_double"),
    )
    cell = F.when(v.isNull(), None)
    for i, (low, high) in enumerate(ranges):
        between = F.lit(None) if inside_only else at(2 * i, nothing)
        cell = cell.when(v < low, between).when(v <= high, at(2 * i + 1, _slice(v, low, high, slices, series.whole)))
    return cell if inside_only else cell.otherwise(at(2 * len(ranges), nothing))


def _narrow(df: DataFrame, series: Mapping[str, Series], targets: list[Target], slices: int, first: bool) -> list[Target]:
    """One pass: count the values per region and slice, and step into the slot that holds each rank.

    In the first pass ranks count from the start of a series, so the values
    between the brackets are counted too. Later, each open range stands for itself.
    """
    groups: dict[tuple, list[tuple[float, float]]] = {}
    for t in targets:
        groups.setdefault((t.series,) if first else (t.series, t.low, t.high), []).append((t.low, t.high))
    number = {key: i for i, key in enumerate(groups)}
    cells = [_cell(number[key], series[key[0]], _disjoint(ranges), slices, not first) for key, ranges in groups.items()]
    if not first:
        inside = [series[name].value.between(low, high) for name, low, high in groups]
        df = df.where(reduce(or_, inside))
    hits = df.select(F.inline(F.array(*cells))).where("_series is not null")
    counts = hits.groupBy("_series", "_region", "_slice").agg(
        F.count("*").alias("_n"), *[f(c).alias(f"{n}{c}") for c in ("_whole", "_double") for n, f in (("least", F.min), ("most", F.max))]
    )
    # At most `slices` rows per range and window partition.
    upto = F.sum("_n").over(Window.partitionBy("_series").orderBy("_region", "_slice"))
    ranked = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
    keys = [(t.series,) if first else (t.series, t.low, t.high) for t in targets]
    holds = F.lit(False)
    for t, key in zip(targets, keys):
        holds |= (F.col("_series") == number[key]) & (F.col("_before") <= t.rank) & (F.col("_upto") > t.rank)
    slots = ranked.filter(holds).collect()  # at most one row per target
    out = []
    for t, key in zip(targets, keys):
        slot = next(r for r in slots if r["_series"] == number[key] and r["_before"] <= t.rank < r["_upto"])
        kind = "_whole" if series[t.series].whole else "_double"
        out.append(Target(t.series, t.rank - slot["_before"], slot[f"least{kind}"], slot[f"most{kind}"]))
    return out


def search_ranks(
    df: DataFrame, series: Mapping[str, Series], spans: Mapping[str, Span], wanted: Iterable[tuple[str, int]], slices: int = SLICES
) -> dict[tuple[str, int], float]:
    """Value at each (series, 0-based rank), in one pass over ``df`` or, where a slice stays open, a few."""
    keys = list(wanted)
    if not keys:
        return {}
    # each value is computed once a row, and then compared with many limits
    used = sorted({name for name, _ in keys}, key=str)
    df = df.select(*[series[name].value.alias(f"_v{i}") for i, name in enumerate(used)])
    series = {name: Series(F.col(f"_v{i}"), series[name].whole) for i, name in enumerate(used)}
    targets = _narrow(df, series, _brackets(df.sparkSession, series, spans, keys), slices, True)
    while open_at := [i for i, t in enumerate(targets) if t.low < t.high]:
        for i, t in zip(open_at, _narrow(df, series, [targets[i] for i in open_at], slices, False)):
            targets[i] = t
    return {key: t.low for key, t in zip(keys, targets)}


def _classes(df: DataFrame, value: Column, whole: bool, group: str | None) -> tuple[DataFrame, dict[str, Series], dict[str, Span]]:
    """Series and spans of a column, one per value of ``group``; groups here are classes, never data keys."""
    name = F.col(group).cast("string") if group else F.lit("")
    rows = df.select(name.alias("_group"), value.alias("_value")).filter("_value is not null")
    found = rows.groupBy("_group").agg(sketch_of(Series(F.col("_value"), whole)).alias("s")).collect()
    same = lambda g: F.col("_group").isNull() if g is None else F.col("_group") == g
    series = {r["_group"]: Series(F.when(same(r["_group"]), F.col("_value")), whole) for r in found}
    return rows, series, {r["_group"]: Span(**r["s"].asDict()) for r in found}


def ranked_values(
    df: DataFrame, value: str, ranks: dict[str, Sequence[int]], group: str | None = None, slices: int = SLICES
) -> dict[tuple[str, int], int]:
    """Values at the given 0-based ranks of BIGINT column ``value``, per group.

    ``df`` is read once for the sketches and once or a few times to count: pass a
    stored frame. ``ranks`` maps a group name (``""`` without ``group``) to ranks; null values are skipped.
    """
    rows, series, spans = _classes(df, F.col(value).cast("bigint"), True, group)
    return search_ranks(rows, series, spans, [(g, k) for g, ks in ranks.items() for k in ks], slices)


def quantiles(
    df: DataFrame, series: Mapping[str, Series], spans: Mapping[str, Span], probabilities: Sequence[float], units: Mapping[str, int] | None = None
) -> dict[str, list[float]]:
    """Linearly interpolated exact quantiles of each series with values, divided by its ``units`` (1)."""
    filled = {name: span for name, span in spans.items() if span.rows}
    places = {(name, p): p * (span.rows - 1) for name, span in filled.items() for p in probabilities}
    wanted = sorted({(name, r) for (name, _), x in places.items() for r in (math.floor(x), math.ceil(x))}, key=lambda w: (w[0] or "", w[1]))
    found = search_ranks(df, series, spans, wanted)

    def interpolate(name: str, p: float) -> float:
        x, unit = places[name, p], (units or {}).get(name, 1)
        below, above = found[name, math.floor(x)] / unit, found[name, math.ceil(x)] / unit
        return below + (above - below) * (x - math.floor(x))

    return {name: [interpolate(name, p) for p in probabilities] for name in filled}


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], scale: int = 0, group: str | None = None, kind: str = "bigint"
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of a BIGINT column of ``in_units(amount, scale)``, per group.

    With ``kind="double"`` the column is DOUBLE (no units; NaN is left out).
    Returns one list per group (``""`` without ``group``); a group without
    values is absent, the ungrouped result then holds nulls.
    """
    v = F.col(value).cast(kind)
    rows, series, spans = _classes(df, F.nanvl(v, F.lit(None)) if kind == "double" else v, kind == "bigint", group)
    out: dict[str, list[float | None]] = quantiles(rows, series, spans, probabilities, dict.fromkeys(series, 10**scale))
    if group is None:
        out.setdefault("", [None] * len(probabilities))
    return out
