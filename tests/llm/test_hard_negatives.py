import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm.hard_negatives import Heaps, hard_negatives, strassen

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, every=100):
    """All anchors against all rows, in Python's integers."""
    seen = {(i, tuple(v), l) for i, v, l in rows if i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v)}
    known = [(i, [math.floor(x * 256) for x in v], l, v) for i, v, l in seen]
    out = []
    for a in known:
        if a[0] % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2], b) for b in known), key=lambda s: (-s[0], s[1]))
        for p in [s for s in scored if s[2] == a[2] and s[3] is not a][:5]:
            fits = [s for s in scored if s[2] != a[2] and 30 * p[0] <= 100 * s[0] <= 90 * p[0]][:10]
            out += [(a[0], p[1], k, s[1], p[0], s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out)


def got(spark, rows, every=100, **options):
    frame = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, **options)
    return sorted(map(tuple, frame.collect()))


def vectors(n, labels, seed=0, width=16):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=width)], int(rng.choice(labels))) for i in range(n)]


@pytest.mark.parametrize("tile", [(4096, 8192), (7, 90)])
def test_same_as_all_pairs(spark, tile):
    rows = vectors(700, [0, 0, 0, 1, 2])
    assert got(spark, rows, 20, tile=tile) == plain(rows, 20)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.9, 0.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [1.0, -inf], 2),
        (5, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (6, [0.5], 2), (7, [0.5, 0.5, 0.5], 2), (8, [], 1), (9, [1.0, 0.0], 1), (10, [1.0, 0.0], 1),
        (11, [0.5, 0.1], 2), (12, [0.5, 0.1], 3), (100, [-1.0, 0.0], 1), (200, [0.0, 0.0], 1), (300, [0.2, 0.2], 9),
    ]
    assert got(spark, rows) == plain(rows)
    assert got(spark, [], 100) == []
    assert got(spark, rows[2:5], 1) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [1e4 + i * 0.37, 2e5 * i, 2.0**20], i % 2) for i in range(1, 40)]
    assert got(spark, rows, 5) == plain(rows, 5)
    huge = [(i, [1e12 * i, 1e300 if i == 3 else 0.0], i % 2) for i in range(1, 9)]
    found = got(spark, huge, 1)
    assert found == []  # all scores become the largest number, and none is below 90 % of another


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(20)] + [(i, [0.5, 0.0], 1) for i in range(20, 60)]
    found = got(spark, rows, 100, tile=(1, 7))
    assert found == plain(rows)
    assert sorted({r[1] for r in found}) == [1, 2, 3, 4, 5] and {r[3] for r in found} == set(range(20, 30))


def test_extra_columns_and_floats(spark):
    rows = vectors(300, [0, 1])
    frame = spark.createDataFrame(rows, SCHEMA).select(
        "vec_id", F.col("embedding").cast("array<float>").alias("embedding"), "label", F.lit(1).alias("h"), F.lit(2).alias("n"), F.lit(3).alias("score")
    )
    floats = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    assert sorted(map(tuple, hard_negatives(frame, F.col("vec_id") % 50 == 0).collect())) == plain(floats, 50)


@pytest.mark.parametrize("shape", [(1, 1, 1), (300, 65, 517), (256, 64, 256), (513, 33, 700), (600, 16, 256)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 20), 1 << 20, shape[:2]), rng.integers(-(1 << 20), 1 << 20, shape[1:])
    assert (strassen(a, b) == a @ b).all()
    assert (strassen(a.astype(object), b.astype(object)) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    group, score, place = rng.integers(0, 9, 4000), rng.integers(0, 50, 4000), rng.permutation(4000)
    whole, parts = Heaps(10), Heaps(10)
    whole.add(group, score, place)
    for some in np.array_split(np.arange(4000), 13)[::-1]:
        parts.add(group[some], score[some], place[some])
    for a, b in zip((whole.group, whole.score, whole.place), (parts.group, parts.score, parts.place)):
        assert (a == b).all()
