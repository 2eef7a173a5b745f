import numpy as np
import pytest

from claimloom.llm.components import components
from claimloom.llm.near_dedup import banding, min_max, near_duplicates, one_of_each
from claimloom.llm.text import odd_multipliers


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows, percent):
    """doc_id -> (size, smallest id that it reaches), all pairs compared."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_same_as_all_pairs(spark, small, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(small, percent).collect()}
    assert got == plain([(r.doc_id, r.text) for r in small.collect()], percent)


def test_large_group_of_variants_meets_in_blocks(spark):
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(700):  # more than one block
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            words[at] = f"x{rng.integers(1e9)}"
        rows.append((int(i), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 85).collect()}
    assert got == plain(rows, 85)


def test_edge_rows(edge):
    rows = near_duplicates(edge, 80).collect()
    assert len(rows) == edge.count()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert (1, 12, 1, True) in got and (2, 12, 1, False) in got
    assert (3, 0, 3, True) in got and (4, 0, 4, True) in got and (5, 0, 5, True) in got
    assert (7, 29_997, 6, False) in got
    assert (8, 1, 8, True) in got and (9, 1, 8, False) in got
    assert {(r.component_id, r.kept) for r in rows if r.doc_id is None} == {(None, True)}


def test_one_of_each_judges_every_text(spark, edge, nothing):
    kept = one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 10]  # the copy without an id goes, the empty row stays
    assert one_of_each(nothing).count() == 0
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (3, c), (3, c), (None, c), (None, a + " more"), (None, "alone here"), (None, None), (4, ""), (4, "x")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame([(1, a), (2, b), (3, c), (None, "alone here"), (None, None), (4, ""), (4, "x")], "doc_id bigint, text string").collect()))


def test_empty_table(nothing):
    assert near_duplicates(nothing).count() == 0


def test_bands_and_signature():
    for percent in (50, 80, 85, 95, 100):
        r, b = banding(percent)
        assert r * b <= 420 and r * b % 2 == 0
        assert (1 - (percent / 100) ** r) ** b <= 1e-6
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    values = odd_multipliers(400, 9)
    x, y = min_max(a[:2500], values), min_max(a[500:], values)
    assert abs((x == y).mean() - 2000 / 3000) < 0.08  # both halves estimate the similarity
    assert abs((x[400:] == y[400:]).mean() - 2000 / 3000) < 0.1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (5, 5), (None, 3)], "u bigint, v bigint")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}


def test_a_component_is_dealt_by_pairs_of_blocks(spark, monkeypatch):
    from claimloom.llm import near_dedup

    plans = []

    def seen(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links)

    monkeypatch.setattr(near_dedup, "components", seen)
    near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string"), 80)
    assert "hashpartitioning(root" in plans[1].split("FlatMapGroupsInArrow")[1].split("Generate")[0]
    assert "i#" in plans[1].split("hashpartitioning(root")[1].split(")")[0]


def test_components_of_a_star_keep_the_centre_spread(spark):
    links = spark.range(1, 5000).selectExpr("id as u", "id % 7 * 0 as v").unionByName(spark.createDataFrame([(9000, 9001)], "u bigint, v bigint"))
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(5000)} | {9000: 9000, 9001: 9000}
