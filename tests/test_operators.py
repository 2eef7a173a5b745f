"""Distributed building blocks against brute force, with hot keys and odd layouts."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import joins, lookup, ordinals, summaries
from claimloom.operators.order_stats import exact_quantiles, in_units, ranked_values
from claimloom.session import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 fact rows, 40 % of them on one key; some keys unknown, some null."""
    rng = random.Random(7)
    data = [(i, 1 if i % 5 < 2 else rng.randint(2, 60)) for i in range(980)] + [(i, None) for i in range(980, 1000)]
    fact = spark.createDataFrame(data, "id bigint, k bigint").repartition(4)
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(1, 51)], "k bigint, name string")
    return fact, dim, data


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_dimension_equals_plain_join(skewed, rows, how):
    fact, dim, _ = skewed
    assert rows(joins.join_dimension(fact, dim, "k", how), "id", "k", "name") == rows(fact.join(dim, "k", how), "id", "k", "name")


def test_null_keys_are_spread_in_any_session(spark):
    """A third of the rows without a key, no adaptive execution, no broadcast."""
    fact = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, null, id % 50) as k")
    dim = spark.range(50).selectExpr("id as k", "concat('n', id) as name")
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        joined = joins.join_dimension(fact, dim, "k", "left")
        sizes = [r["count"] for r in joined.filter("k is null").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key in changed:
            spark.conf.unset(key)
    assert sum(sizes) == 10_000 and max(sizes) < 2_000 and joined.count() == 30_000


def test_orphans_count_null_keys(skewed, rows):
    fact, dim, data = skewed
    expected = {}
    for _, k in data:
        if k is None or k > 50:
            expected[k] = expected.get(k, 0) + 1
    assert {r["k"]: r["rows"] for r in joins.orphan_rows(fact, dim, "k").collect()} == expected
    assert {r["k"] for r in joins.missing_keys(fact, dim, "k").collect()} == set(expected) - {None}


def test_stage_in_order_numbers_without_gaps(spark):
    df = spark.range(0, 5000, 1, 7).select(F.col("id"), F.xxhash64("id").alias("h")).repartition(5)
    staged = ordinals.stage_in_order(df, ["h"], "t")
    got = [(r[ordinals.ORD], r["h"]) for r in staged.orderBy(ordinals.ORD).collect()]
    assert [o for o, _ in got] == list(range(5000))
    assert [h for _, h in got] == sorted(h for _, h in got)


def test_file_ordinal_follows_names_and_lines(spark, tmp_path):
    """Many files of different sizes, split into many blocks: order is by name, then by line."""
    expected = []
    for name, n in [("b.csv", 3000), ("a.csv", 10), ("c.csv", 400)]:
        (tmp_path / name).write_text("v\n" + "".join(f"{name}-{i:05d}\n" for i in range(n)))
    for name, n in [("a.csv", 10), ("b.csv", 3000), ("c.csv", 400)]:
        expected += [f"{name}-{i:05d}" for i in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        scan = spark.read.option("header", True).csv(str(tmp_path))
        staged = stage(ordinals.tag_source_order(scan, [F.col("v")]), "lines")
        blocks = staged.select(ordinals.SRC_FILE, ordinals.SRC_BLOCK).distinct().count()
        assert blocks > 5
        got = ordinals.add_file_ordinal(staged).orderBy(ordinals.ORD).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["v"] for r in got] == expected
    assert [r[ordinals.ORD] for r in got] == list(range(len(expected)))


def test_stored_rows_carry_no_paths(spark, tmp_path):
    """Odd file names, a folder with a blank, many blocks: the order is that of the paths, and a row's file is a number."""
    home, expected = tmp_path / "in 100%", []
    home.mkdir()
    for name, n in [("a b.csv", 900), ("a%20c.csv", 5), ("b#+.csv", 700), ("\u00fc.csv", 40)]:
        (home / name).write_text("v\n" + "".join(f"{name}-{i:05d}\n" for i in range(n)))
        expected += [f"{name}-{i:05d}" for i in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        tagged, paths = ordinals.tag_by_file(spark.read.option("header", True).csv(str(home)), [F.col("v")])
        out = ordinals.add_file_ordinal(stage(tagged, "lines"), paths)
        got = out.orderBy(ordinals.ORD).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r) for r in got] == [(v, i) for i, v in enumerate(expected)]
    assert "_src_file:bigint" in out._jdf.queryExecution().executedPlan().toString().replace(" ", "")


@pytest.mark.parametrize("bucket", [1, 100, 1000, 1 << 20])
def test_number_by_ordinal_closes_gaps(spark, bucket):
    rng = random.Random(3)
    values = rng.sample(range(20_000), 300) + [5_000_000_000]
    df = spark.createDataFrame([(v,) for v in values], "o bigint").repartition(3)
    got = {r["o"]: r["n"] for r in ordinals.number_by_ordinal(df, "o", "n", bucket).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("slices", [2, 7, 1 << 12])
def test_ranked_values_equal_a_sort(spark, slices):
    rng = random.Random(11)
    data = [("a", rng.randint(-(2**63), 2**63 - 1)) for _ in range(198)] + [("a", -(2**63)), ("a", 2**63 - 1)]
    data += [("b", 5)] * 120 + [("b", rng.randint(0, 9)) for _ in range(80)] + [("b", None)]
    df = spark.createDataFrame(data, "g string, v bigint").cache()
    ranks = {"a": [0, 7, 100, 199], "b": [0, 60, 199]}
    if slices == 2:
        ranks = {"a": [100], "b": [60]}
    got = ranked_values(df, "v", ranks, group="g", slices=slices)
    for g, ks in ranks.items():
        values = sorted(v for gg, v in data if gg == g and v is not None)
        assert {k: got[g, k] for k in ks} == {k: values[k] for k in ks}


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 10]], "v int").select(in_units(F.col("v").cast("decimal(12,2)"), 2).alias("v"))
    assert exact_quantiles(df, "v", [0.0, 0.25, 0.9, 1.0], scale=2)[""] == pytest.approx([1, 2, 7.6, 10])
    assert exact_quantiles(df.filter("v = 300"), "v", [0.9], scale=2)[""] == [3.0]
    assert exact_quantiles(df.filter("v < 0"), "v", [0.9], scale=2)[""] == [None]


def test_exact_quantiles_of_doubles(spark):
    rng = random.Random(2)
    data = [rng.gauss(0, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)] + [1.7e308, -1.7e308, 0.0, 5e-324] + [0.25] * 50
    df = spark.createDataFrame([(v,) for v in [*data, None, float("nan")]], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.5, 1.0], kind="double")[""]
    ordered = sorted(data)
    assert got[0] == ordered[0] and got[2] == ordered[-1]
    n = len(ordered) - 1
    assert got[1] == ordered[n // 2] + (ordered[-(-n // 2)] - ordered[n // 2]) * (n * 0.5 - n // 2)


def test_lookup_keeps_rows_and_fills_default(spark, rows):
    cars = spark.createDataFrame([("Honda", 1), ("Kia", 2), ("Unseen", 3), (None, 4)], "make string, id int")
    out = lookup.lookup_fill(cars, "make", "country", {"Honda": "Japan", "Kia": "South Korea"})
    assert rows(out, "id", "country") == [(1, "Japan"), (2, "South Korea"), (3, ""), (4, "")]


def test_class_means_and_frequency(spark, rows):
    people = spark.createDataFrame(
        [(28, 40000, "IT"), (35, 55000, "HR"), (42, 65000, "Finance"), (30, 48000, "IT"), (50, 70000, "Finance")],
        "age int, salary int, department string",
    ).withColumn("age_group", F.when(F.col("age") >= 40, "Senior").otherwise("Junior"))
    assert rows(summaries.class_means(people, "age_group", "salary"), digits=2) == [
        ("Junior", 3, 47666.67, 7505.55, 40000.0, 55000.0),
        ("Senior", 2, 67500.0, 3535.53, 65000.0, 70000.0),
    ]
    assert rows(summaries.group_mean(people, "age_group", "salary"), digits=2) == [("Junior", 47666.67), ("Senior", 67500.0)]
    assert [tuple(r) for r in summaries.frequency(people, "department").collect()] == [("Finance", 2), ("IT", 2), ("HR", 1)]
    assert summaries.shape(people) == (5, 4)
    assert summaries.preview(people, 2).count() == 2


def test_profile(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (4, None), (9, "y")], "n int, t string")
    got = {r["column_name"]: r.asDict() for r in summaries.profile(df).collect()}
    assert (got["t"]["non_null"], got["t"]["unique_values"], got["t"]["top"], got["t"]["freq"]) == (3, 2, "x", 2)
    assert got["t"]["mean"] is None and got["t"]["p50"] is None
    assert (got["n"]["mean"], got["n"]["min"], got["n"]["max"]) == (4.0, 1.0, 9.0)
    assert [got["n"][p] for p in ("p25", "p50", "p75")] == pytest.approx([1.75, 3.0, 5.25])
