"""Quantile sketches, bitmaps of ids and key filters: exact results and the plans that give them."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import order_stats, summaries
from claimloom.operators.order_stats import Series, Span, merge_sketches, search_ranks, sketch_of, sketched_quantiles


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(4)
    data = [(i, int(rng.gauss(0, 1e6)), rng.lognormvariate(0, 3), rng.choice([None, 7])) for i in range(20_000)]
    return spark.createDataFrame(data, "id bigint, v bigint, d double, few bigint").repartition(6).cache()


def test_one_pass_after_the_sketch(numbers, monkeypatch):
    passes = []
    narrow = order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a: passes.append(1) or narrow(*a))
    series = {"v": Series(F.col("v")), "d": Series(F.col("d"), False), "few": Series(F.col("few"))}
    found = numbers.agg(*[sketch_of(s).alias(n) for n, s in series.items()]).first()
    spans = {n: Span(**found[n].asDict()) for n in series}
    ranks = {"v": [0, 5_000, 19_999], "d": [10, 10_000], "few": [0, spans["few"].rows - 1]}
    got = search_ranks(numbers, series, spans, [(n, r) for n, rs in ranks.items() for r in rs])
    rows = numbers.collect()
    for name, wanted in ranks.items():
        values = sorted(r[name] for r in rows if r[name] is not None)
        assert [got[name, r] for r in wanted] == [values[r] for r in wanted]
    assert len(passes) <= 2


def test_a_wrong_sketch_costs_passes_and_no_result(numbers):
    series = {"v": Series(F.col("v"))}
    values = sorted(r.v for r in numbers.collect())
    low = numbers.where("v < 0").agg(sketch_of(series["v"]).alias("s")).first()["s"]  # a sketch of other rows
    spans = {"v": Span(len(values), values[0], values[-1], low["sketch"])}
    got = search_ranks(numbers, series, spans, [("v", r) for r in (3, 9_000, 15_000, 19_990)])
    assert got == {("v", r): values[r] for r in (3, 9_000, 15_000, 19_990)}


def test_sketches_merge(numbers):
    parts = numbers.groupBy((F.col("id") % 7).alias("part")).agg(sketch_of(Series(F.col("v"))).alias("s"))
    merged = parts.agg(merge_sketches(F.col("s.sketch")).alias("sketch"), F.sum("s.rows").alias("n"))
    row = merged.select("n", sketched_quantiles(F.col("sketch"), [0.1, 0.5, 0.9]).alias("q")).first()
    values = sorted(r.v for r in numbers.collect())
    assert row.n == len(values)
    for p, v in zip((0.1, 0.5, 0.9), row.q):
        assert abs(values.index(v) / len(values) - p) < order_stats.MARGIN


def test_profile_reads_its_input_three_times(spark, numbers, tmp_path, monkeypatch):
    numbers.drop("d").withColumn("name", F.concat(F.lit("n"), F.col("id") % 9)).write.parquet(f"{tmp_path}/t")
    scans, frame = [], type(numbers)
    narrow = order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a: scans.append("count") or narrow(*a))
    first = frame.first
    monkeypatch.setattr(frame, "first", lambda self: (scans.append("aggregate") if "FileScan" in plan(self) else None, first(self))[1])
    out = summaries.profile(spark.read.parquet(f"{tmp_path}/t"))
    assert scans == ["aggregate", "count"] and plan(out).count("FileScan") == 1  # the texts
    rows = {r.column_name: r for r in out.collect()}
    values = sorted(r.v for r in numbers.collect())
    assert rows["v"].p50 == (values[9_999] + values[10_000]) / 2 and rows["name"].unique_values == 9
    assert rows["few"].p25 == rows["few"].p75 == 7.0


# ---- bitmaps of ids ----------------------------------------------------------------
from claimloom.operators import distinct, filters  # noqa: E402


@pytest.fixture(scope="module")
def ids(spark):
    """Serial ids of four partitions, some given out twice, some null."""
    base = spark.range(0, 60_000, 1, 4).select(F.when(F.col("id") % 1000 != 7, F.col("id") + 5_000_000_000).alias("claim_id"), (F.col("id") % 3).alias("client"))
    return base.unionByName(base.where("claim_id % 500 = 3")).repartition(5).cache()


def test_bitmaps_count_like_a_set(ids):
    row = distinct.distinct_of(distinct.id_bitmaps(ids, "claim_id")).first()
    known = [r.claim_id for r in ids.collect() if r.claim_id is not None]
    assert tuple(row) == (len(set(known)), len(known), len(known) - len(set(known)))
    frame, surplus = distinct.surplus_of(ids, "claim_id")
    assert frame.agg(surplus).first()[0] == ids.count() - len(set(known))
    assert distinct.distinct_of(distinct.id_bitmaps(ids.limit(0), "claim_id")).first() == (0, 0, 0)


def test_bitmaps_merge_over_partitions(ids):
    parts = distinct.id_bitmaps(ids, "claim_id", ["client"])
    whole = distinct.distinct_of(distinct.merge_bitmaps(parts)).first()
    assert whole == distinct.distinct_of(distinct.id_bitmaps(ids, "claim_id")).first()


def test_repeated_ids(ids):
    got = {r.claim_id: r.rows for r in distinct.repeated_ids(ids, "claim_id").collect()}
    assert got == {5_000_000_000 + i: 2 for i in range(60_000) if (5_000_000_000 + i) % 500 == 3 and i % 1000 != 7}


def test_no_id_is_shuffled(ids):
    frame, surplus = distinct.surplus_of(ids, "claim_id")
    text = plan(frame.agg(surplus))
    assert "bitmap_construct_agg" in text and "distinct" not in text and "hashpartitioning(claim_id" not in text


def test_ids_with_gaps_are_counted_plainly(spark):
    wide = spark.range(4000).select((F.col("id") % 3000 * 1_000_003_000).alias("claim_id"))
    assert not distinct.is_dense(wide, "claim_id")
    frame, surplus = distinct.surplus_of(wide, "claim_id")
    assert frame.agg(surplus).first()[0] == 1000
    assert not distinct.is_dense(wide.select(F.col("claim_id").cast("string")), "claim_id")


# ---- key filters -------------------------------------------------------------------
@pytest.fixture(scope="module")
def star(spark):
    dim = spark.range(0, 5_000).where("id % 11 <> 0").select(F.col("id").alias("member_id"))
    dim = dim.unionByName(spark.createDataFrame([(None,), (-7,)], "member_id bigint"))
    fact = spark.range(0, 40_000, 1, 6).select(F.when(F.col("id") % 97 != 0, F.col("id") % 6_000 - 9).alias("member_id"), F.lit("x").alias("more"))
    return fact, dim


def plain_orphans(fact, dim):
    known = {r.member_id for r in dim.collect() if r.member_id is not None}
    out = {}
    for r in fact.collect():
        if r.member_id not in known:
            out[r.member_id] = out.get(r.member_id, 0) + 1
    return out


@pytest.mark.parametrize("rate", [0.3, 0.01, 1e-6])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_orphans_at_any_error_rate(star, rate, kind):
    fact, dim = (df.withColumn("member_id", F.col("member_id").cast(kind)) for df in star)
    got = {r.member_id: r["rows"] for r in filters.orphan_counts(fact, dim, "member_id", error_rate=rate, exact=False).collect()}
    assert got == plain_orphans(fact, dim)


def test_a_full_filter_is_still_exact(star, monkeypatch):
    monkeypatch.setattr(filters, "MAX_WORDS", 4)
    fact, dim = star
    members = filters.key_filter(dim, "member_id")
    assert members.hashes and members.words.count() <= 4
    got = {r.member_id: r["rows"] for r in filters.orphan_counts(fact, dim, "member_id").collect()}
    assert got == plain_orphans(fact, dim)


def test_dense_keys_need_no_join(star):
    fact, dim = star
    frame = filters.orphan_counts(fact, dim, "member_id")
    text = plan(frame)
    assert {r.member_id: r["rows"] for r in frame.collect()} == plain_orphans(fact, dim)
    assert "BroadcastHashJoin" in text and "LeftAnti" not in text and text.count("Exchange hashpartitioning") == 1


def test_only_suspects_reach_the_join(star):
    """Certain orphans are counted on a branch of their own; what is joined has passed the filter."""
    fact, dim = (df.withColumn("member_id", F.concat(F.lit("m"), "member_id")) for df in star)
    text = plan(filters.orphan_counts(fact, dim, "member_id", error_rate=0.05))
    assert text.count("LeftAnti") == 1
    certain, rest = text.split("LeftAnti")
    below = rest.split("FileScan")[0]
    assert "_b__known" in below  # the probe stands below the join's fact side
    passed = filters.key_filter(dim, "member_id", 0.01).probe(fact, "member_id", "_known")
    orphans, wrong = passed.join(dim, "member_id", "left_anti").agg(F.count("*"), F.count_if("_known")).first()
    assert wrong <= 0.02 * orphans


def test_missing_counts_of_all_dimensions_at_once(spark, star):
    fact, dim = star
    fact = fact.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("member_id") % 40).cast("int")))
    days = spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    counts = filters.missing_counts(fact, {"members": (dim, "member_id", "member_id"), "days": (days, "d", "day")})
    rows = fact.collect()
    listed = {r.d for r in days.collect()}
    assert tuple(counts.first()) == (sum(plain_orphans(fact, dim).values()), sum(r.day not in listed for r in rows))
    assert "Exchange hashpartitioning" not in plan(counts)
    assert filters.missing_counts(fact, {"x": (dim.withColumn("member_id", F.col("member_id").cast("string")), "member_id", "member_id")}) is None


# ---- ids per group, keys and references ------------------------------------------------
def test_distinct_ids_of_groups(spark, rows):
    """Repeated, null and missing ids in groups with a null key; the rows of a group that repeats none are only counted."""
    ids = spark.range(0, 100_000, 1, 5).select(
        F.when(F.col("id") % 101 != 0, F.when(F.col("id") % 1000 == 9, 9).otherwise(F.col("id"))).alias("claim_id"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"),
    )
    plain = ids.groupBy("a", "b").agg(F.count_distinct("claim_id").alias("ids"), F.count("*").alias("rows"))
    found = distinct.distinct_by(ids, "claim_id", ["a", "b"], "ids", [F.count("*").alias("rows")], ids)
    assert found.columns == plain.columns and rows(found) == rows(plain)
    unique = ids.dropDuplicates(["claim_id"]).localCheckpoint()
    once = distinct.distinct_by(unique, "claim_id", ["a", "b"], "ids", [], unique)
    assert "distinct" not in plan(once) and "claim_id" not in " ".join(x for x in plan(once).split("\n") if "Exchange" in x)
    assert rows(once) == rows(unique.groupBy("a", "b").agg(F.count_distinct("claim_id")))
    gaps = ids.withColumn("claim_id", F.col("claim_id") * 1_000_003)
    assert rows(distinct.distinct_by(gaps, "claim_id", ["a", "b"], "ids", [], gaps)) == rows(plain, "a", "b", "ids")


def test_keys_and_references_by_bitmaps(spark):
    dim = spark.range(1, 100_001).select(F.col("id").alias("k"))
    fact = spark.range(0, 100_001).select(F.nullif("id", F.lit(0)).alias("k"))
    assert distinct.is_key(dim, "k") and distinct.covers(dim, fact, "k")
    assert not distinct.is_key(fact, "k")
    assert not distinct.is_key(dim.unionByName(dim.where("k = 70000")), "k")
    assert not distinct.covers(dim.where("k <> 70000"), fact, "k")
    assert not distinct.covers(dim.where("k < 30000"), fact, "k")  # whole buckets that the dimension has not
    assert not distinct.is_key(dim.select((F.col("k") * 1_000_003).alias("k")), "k")
    assert distinct.covers(dim, fact.where("k < 0"), "k")
