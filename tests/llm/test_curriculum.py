from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from claimloom.llm.curriculum import curriculum, inverse_demand, source_targets, training_order, word_count


def plain_targets(sizes, weights, share=1.5, repeats=2):
    """Shared by weight, round by round."""
    found, left, open_ = {}, share * sum(sizes), set(range(len(sizes)))
    while open_:
        whole = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / whole > repeats * sizes[i]]
        if not above:
            return [found[i] if i in found else left * weights[i] / whole for i in range(len(sizes))]
        for i in above:
            found[i] = float(repeats * sizes[i])
        left -= sum(repeats * sizes[i] for i in above)
        open_ -= set(above)
    return [found[i] for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 700, 20, 3], [0, 0], [7], [5, 0, 100, 1, 1, 1, 90]])
def test_targets(spark, sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    given = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights)), "i int, size bigint, weight int")
    got = [r.target for r in source_targets(given).orderBy("i").collect()]
    assert got == pytest.approx(plain_targets(sizes, weights))


def test_inverse_of_the_integral(spark):
    schedule = ((0.0, 0.0), (0.25, 2.0), (0.5, 0.0), (0.75, 0.0), (1.0, 3.0))
    areas = [0.25, 0.25, 0.0, 0.375]

    def integral(t):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            done += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return done / sum(areas)

    shares = [i / 200 for i in range(200)]
    frame = spark.createDataFrame([(s,) for s in shares], "s double").select("s", inverse_demand(F.col("s"), schedule).alias("t"))
    rows = frame.collect()
    assert all(integral(r.t) == pytest.approx(r.s, abs=1e-9) for r in rows)
    assert [r.t for r in rows] == sorted(r.t for r in rows)


def check(rows, repeats=2):
    """Targets are met by reads in hash order, and nothing is read more often than allowed."""
    taken, target, size = Counter(), {}, {}
    for r in rows:
        assert r.taken == sum(w for _, w in r.reads) <= repeats * max(r["size"] or 0, 0)
        assert all(0 <= p <= 1 and w > 0 for p, w in r.reads)
        assert [p for p, _ in r.reads] == sorted(p for p, _ in r.reads)
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    assert all(taken[s] == int(target[s]) for s in target)
    firsts = [r.reads[0][0] if r.reads else 2 for r in rows]
    assert firsts == sorted(firsts)
    return target


def test_small_table(spark, small):
    docs = small.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    rows = curriculum(docs).collect()
    assert len(rows) == small.count()
    words = sum(len((r.text or "").encode().split()) for r in small.collect())
    assert sum(r["size"] for r in rows) == words
    target = check(rows)
    assert sum(target.values()) == pytest.approx(1.5 * words)
    again = curriculum(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_half_of_the_rows_are_one_key(spark):
    """A source, an id and a size that most rows share: bins stay small and every read is dealt once."""
    docs = spark.range(0, 6000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.lit("z")).alias("source"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("size"),
    )
    rows = curriculum(docs, share=0.7).collect()
    check(rows)
    alike = defaultdict(Counter)
    for r in rows:
        alike[r.source, r.doc_id, r["size"]][r.taken] += 1
    again = defaultdict(Counter)
    for r in curriculum(docs.repartition(5), share=0.7).collect():
        again[r.source, r.doc_id, r["size"]][r.taken] += 1
    assert alike == again


def test_reads_follow_the_schedules(spark):
    """The first source falls, the third rises: early reads are more of the first."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("source"), F.lit(10).alias("size"))
    reads = training_order(curriculum(docs)).collect()
    assert [r.position for r in reads] == sorted(r.position for r in reads)
    half = Counter((r.source, r.position < 0.5) for r in reads)
    assert half["a", True] == pytest.approx(1250, abs=20) and half["a", False] == pytest.approx(750, abs=20)  # 1.25 to 0.75
    assert half["b", True] == pytest.approx(half["b", False], abs=20)
    assert half["c", True] < half["c", False]


def test_edge_rows(edge, nothing):
    docs = edge.withColumn("size", word_count(F.col("text")))
    rows = curriculum(docs).collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(rows[0].asDict())
    check(rows)
    assert {r.taken for r in rows if r.text is None} == {0}
    assert curriculum(docs.withColumn("size", -F.col("size"))).agg(F.sum("taken")).first()[0] == 0
    assert curriculum(nothing.withColumn("size", F.lit(1))).count() == 0


def test_no_python_in_the_plan(spark, small):
    plan = curriculum(small.select("doc_id", "source", word_count(F.col("text")).alias("size")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "RDD scan"))
