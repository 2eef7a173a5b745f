"""Hard negatives of anchors: candidates of another label that score within a window below a positive's score.

Scores are inner products of whole numbers. Anchors and candidates meet in
tiles, whose products are computed by Strassen's recursion on 64-bit integers.
Each tile keeps heaps: the best positives of its anchors, then the best rows of
each window; heaps of tiles are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.components import join_heavy
from claimloom.session import stage

POSITIVES, NEGATIVES = 5, 10
SCALE = 256  # a component x becomes floor(SCALE * x)
LOW_PERCENT, HIGH_PERCENT = 30, 90  # of a positive's score: the window of its negatives
TILE_ANCHORS, TILE_CANDIDATES = 4096, 8192  # rows that meet in one group
_STEP_ANCHORS, _STEP_CANDIDATES = 512, 2048  # scores held at a time: 8 MB
_LEAF = 128  # rows or columns below which a product is computed directly
_SAFE = 1 << 62


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers. Odd sizes are padded with zeros; a small side ends the recursion.

    Additions are exact: 64-bit integers wrap, so a result that fits is right
    whatever the intermediate sums were.
    """
    m, d, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, n) < 2 * _LEAF or d < 16:
        return a @ b
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    m, d, n = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :n], b[:d, n:], b[d:, :n], b[d:, n:]
    out = np.empty((2 * m, 2 * n), dtype=a.dtype)
    c11, c12, c21, c22 = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    p = strassen(a11 + a22, b11 + b22)
    c11[:] = p
    c22[:] = p
    p = strassen(a21 + a22, b11)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12)
    c11 += strassen(a12 - a22, b21 + b22)
    return out


def whole_numbers(column: pa.Array, scale: int = SCALE) -> np.ndarray:
    """Vectors as rows of floor(scale * x), shorter ones filled up with zeros.

    64-bit integers, or Python's where a component is too large for them.
    """
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    if len(scaled) and not np.abs(scaled).max() < 1 << 53:
        values = np.array([math.floor(Fraction(float(x)) * scale) for x in flat], dtype=object)
    else:
        values = scaled.astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=values.dtype)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = values
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns, and with Python's integers if 64 bits might not hold a product."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    most = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) if x.size else 0
    if most(a) * most(b) * width >= _SAFE:
        return a.astype(object), b.astype(object)
    return a.astype(np.int64), b.astype(np.int64)


class Heaps:
    """The best rows of each group so far: higher scores first, then lower places."""

    def __init__(self, size: int):
        self.size = size
        self.group, self.score, self.place = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        group, score, place = (np.concatenate(p) for p in ((self.group, group), (self.score, score), (self.place, place)))
        order = np.lexsort((place, ~score, group))
        group = group[order]
        first = np.searchsorted(group, group, side="left")
        order = order[np.arange(len(group)) - first < self.size]
        self.group = group[np.arange(len(group)) - first < self.size]
        self.score, self.place = score[order], place[order]

    def least(self, groups: int, otherwise: np.ndarray) -> np.ndarray:
        """Score that a further row must reach to enter each group's heap."""
        found = otherwise.copy()
        ends = np.searchsorted(self.group, np.arange(groups), side="right") - 1
        full = np.bincount(self.group, minlength=groups) == self.size
        found[full] = np.maximum(found[full], self.score[ends[full]])
        return found


def _order(table: pa.Table) -> np.ndarray:
    return np.lexsort((table.column("h").to_numpy(), table.column("vec_id").to_numpy()))


def _steps(rows: int, size: int) -> Iterator[slice]:
    return (slice(at, min(at + size, rows)) for at in range(0, rows, size))


def _vectors(table: pa.Table, scale: int) -> np.ndarray:
    return whole_numbers(table.column("vector").combine_chunks(), scale)


def _long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; one that does not fit becomes the nearest."""
    limits = np.iinfo(np.int64)
    return np.minimum(np.maximum(scores, limits.min), limits.max).astype(np.int64)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _long(strassen(a, b.T))


def _positives(scale: int, size: int):
    """Best positives of the anchors of a tile among its candidates, all of one label."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if len(anchors) and len(rows):
            rows = rows.take(pa.array(_order(rows)))
            a, b = _same_width(_vectors(anchors, scale), _vectors(rows, scale))
            ids, hashes = (rows.column(c).to_numpy() for c in ("vec_id", "h"))
            own_ids, own_hashes = (anchors.column(c).to_numpy() for c in ("vec_id", "h"))
            for some in _steps(len(a), _STEP_ANCHORS):
                heaps, lowest = Heaps(size), np.full(some.stop - some.start, np.iinfo(np.int64).min)
                for others in _steps(len(b), _STEP_CANDIDATES):
                    scores = _scores(a[some], b[others])
                    other = (own_ids[some, None] != ids[None, others]) | (own_hashes[some, None] != hashes[None, others])
                    x, y = np.nonzero(other & (scores >= heaps.least(len(lowest), lowest)[:, None]))
                    heaps.add(x, scores[x, y], y + others.start)
                at = heaps.group + some.start
                found.append((own_ids[at], own_hashes[at], ids[heaps.place], hashes[heaps.place], heaps.score))
        return _table(["anchor_id", "anchor_h", "vec_id", "h", "score"], found)

    return run


def _negatives(scale: int, size: int, low: int, high: int):
    """Best rows of each window of a tile's anchors among the tile's candidates of other labels."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if len(anchors) and len(rows):
            rows = rows.take(pa.array(_order(rows)))
            a, b = _same_width(_vectors(anchors, scale), _vectors(rows, scale))
            ids, hashes, labels = (rows.column(c).to_numpy() for c in ("vec_id", "h", "label"))
            own_ids, own_hashes, own_labels = (anchors.column(c).to_numpy() for c in ("vec_id", "h", "label"))
            lists = anchors.column("positives").combine_chunks()
            starts = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            owner = np.repeat(np.arange(len(a)), np.diff(starts))
            positive_id, positive = (lists.flatten().field(c).to_numpy() for c in ("vec_id", "score"))
            # whole scores from low % of the positive's, rounded up, to high % of it, rounded down
            floor = _long(np.array([-(-low * int(p) // 100) for p in positive], dtype=object))
            ceiling = _long(np.array([high * int(p) // 100 for p in positive], dtype=object))
            for some in _steps(len(a), _STEP_ANCHORS):
                heaps, of = Heaps(size), slice(starts[some.start], starts[some.stop])
                begin, end = starts[some] - of.start, starts[some.start + 1 : some.stop + 1] - of.start
                for others in _steps(len(b), _STEP_CANDIDATES):
                    scores = _scores(a[some], b[others])
                    least = heaps.least(of.stop - of.start, floor[of])
                    lowest, highest = np.full(len(begin), np.iinfo(np.int64).max), np.full(len(begin), np.iinfo(np.int64).min)
                    np.minimum.at(lowest, owner[of] - some.start, least)
                    np.maximum.at(highest, owner[of] - some.start, ceiling[of])
                    inside = (scores >= lowest[:, None]) & (scores <= highest[:, None])
                    x, y = np.nonzero(inside & (own_labels[some, None] != labels[None, others]))
                    value, parts = scores[x, y], []
                    for k in range(int((end - begin).max(initial=0))):  # a score meets the windows of its anchor
                        window = np.minimum(begin[x] + k, end[x] - 1)
                        fits = (begin[x] + k < end[x]) & (value >= least[window]) & (value <= ceiling[of][window])
                        parts.append((window[fits], value[fits], y[fits] + others.start))
                    if parts:
                        heaps.add(*(np.concatenate(p) for p in zip(*parts)))
                w = heaps.group + of.start
                place = (owner[w], w - starts[owner[w]], heaps.place)
                found.append((own_ids[place[0]], own_hashes[place[0]], place[1], positive_id[w], positive[w], ids[place[2]], hashes[place[2]], heaps.score))
        return _table(["anchor_id", "anchor_h", "positive", "positive_id", "positive_score", "vec_id", "h", "score"], found)

    return run


def _table(names: list[str], found: list[tuple]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found)] if found else [[] for _ in names]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _merged(heaps: DataFrame, by: list[str], size: int) -> DataFrame:
    """The best ``size`` rows of each group of all tiles' heaps, with their ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "h")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _met(left: DataFrame, right: DataFrame, key: list[str]):
    """Groups of both sides by tile, dealt by the whole key (not by a label alone, after a join by it)."""
    left, right = (side.toDF(*side.columns) for side in (left, right))  # own names: both come from one table
    return left.repartition(*key).groupBy(*key).cogroup(right.repartition(*key).groupBy(*key))


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    label: Column | str = "label",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    scale: int = SCALE,
    tile: tuple[int, int] = (TILE_ANCHORS, TILE_CANDIDATES),
) -> DataFrame:
    """For each row where ``anchors`` (a condition on ``vec_id``) holds and each of its positives, the best rows of the window.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    A score is the inner product of the vectors of floor(scale * x). Higher scores
    come first, ties by smaller id. Positives are the first ``positives`` other rows of the anchor's
    label; negatives are the first rows of another label whose score is from
    ``low_percent`` to ``high_percent`` of the positive's.

    Rows without id, label or vector, or with a null or non-finite component take
    no part. Equal rows (id, label, vector) count once; rows that share an id but
    differ count each, and ties among them go by a hash of label and vector. A
    shorter vector counts as filled up with zeros. A score beyond 64 bits becomes
    the nearest 64-bit number. An anchor without positives, or a window without
    rows, has no rows in the result, nor has an empty table.

    1. Positives: anchors meet the rows of their label, in tiles of about 4096 by 8192 rows.
    2. Negatives: anchors with their positives meet all rows, in such tiles.
    Each row is copied once per tile of anchors and each anchor once per tile of
    rows, a few bytes against the tile's products; labels of any size fill many
    tiles. Only counts reach the driver.
    """
    if isinstance(label, str):
        label = F.col(label)
    finite = ~F.exists(F.col("vector"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    known = known.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite)
    known = known.withColumn("h", F.xxhash64("label", "vector")).dropDuplicates(["vec_id", "label", "vector"])
    known = stage(known, "vectors")
    chosen = known.where(anchors)
    per_label = known.groupBy("label").agg(F.count("*").alias("n"), F.count("*").alias("n_rows"), F.count_if(anchors).alias("n_anchors"))
    per_label = stage(per_label.where("n_anchors > 0"), "labels")
    total = known.count()

    # a label's rows fill as many tiles as they need
    tiles = lambda n, size: F.greatest(F.ceil(n / size), F.lit(1)).cast("int")
    at = lambda n, size: F.pmod(F.xxhash64("vec_id", "h"), tiles(n, size)).cast("int")
    every = lambda n, size: F.explode(F.sequence(F.lit(0), tiles(n, size) - 1))
    n, n_anchors = F.col("n_rows"), F.col("n_anchors")
    whole = ["vec_id", "h", "vector"]
    left = join_heavy(chosen, per_label, "label", total).select("label", at(n_anchors, tile[0]).alias("i"), every(n, tile[1]).alias("j"), *whole)
    right = join_heavy(known, per_label, "label", total).select("label", every(n_anchors, tile[0]).alias("i"), at(n, tile[1]).alias("j"), *whole)
    found = _met(left, right, ["label", "i", "j"]).applyInArrow(
        _positives(scale, positives), "anchor_id bigint, anchor_h bigint, vec_id bigint, h bigint, score bigint"
    )
    best = _merged(found, ["anchor_id", "anchor_h"], positives)
    entry = F.struct("rank", F.col("vec_id").alias("other"), "score")
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda p: F.struct(p["other"].alias("vec_id"), p["score"].alias("score")))
    lists = best.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_h").alias("h")).agg(ordered.alias("positives"))
    ready = stage(chosen.join(lists, ["vec_id", "h"]), "anchors")

    n, n_anchors = F.lit(total), F.lit(ready.count())
    whole = ["vec_id", "h", "label", "vector"]
    left = ready.select(at(n_anchors, tile[0]).alias("i"), every(n, tile[1]).alias("j"), *whole, "positives")
    right = known.select(every(n_anchors, tile[0]).alias("i"), at(n, tile[1]).alias("j"), *whole)
    found = _met(left, right, ["i", "j"]).applyInArrow(
        _negatives(scale, negatives, low_percent, high_percent),
        "anchor_id bigint, anchor_h bigint, positive bigint, positive_id bigint, positive_score bigint, vec_id bigint, h bigint, score bigint",
    )
    best = _merged(found, ["anchor_id", "anchor_h", "positive", "positive_id", "positive_score"], negatives)
    rank, negative, score = F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    return best.select("anchor_id", "positive_id", rank, negative, "positive_score", score)
