"""Member cost, threshold, stratified split, model and its fallbacks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.plans import classifier as c


def rows_frame(spark, rows):
    """(key, age, region, in_network, label)"""
    return spark.createDataFrame(rows, "k bigint, age double, member_region string, in_network string, label double")


@pytest.fixture(scope="module")
def population(spark):
    rows = []
    for i in range(1000):
        costly = i % 10 == 0
        rows.append((i, 70.0 + i % 9 if costly else 20.0 + i % 40, "East" if costly else "West", "true", float(costly)))
    return rows_frame(spark, rows).cache()


def test_member_cost_has_one_row_per_member_and_network(spark, rows):
    claims = spark.createDataFrame(
        [(1, 10, Decimal(5)), (1, 10, Decimal(7)), (1, 20, Decimal(1)), (2, 20, None), (9, 10, Decimal(1)), (1, 99, Decimal(1))],
        "member_id bigint, provider_id bigint, paid_amount decimal(12,2)",
    )
    members = spark.createDataFrame([(1, dt.date(1980, 1, 1), "East"), (2, None, None)], "member_id bigint, dob date, region string")
    providers = spark.createDataFrame([(10, True), (20, False)], "provider_id bigint, in_network boolean")
    out = c.member_cost(claims, members, providers)
    assert rows(out, "member_id", "member_region", "in_network", F.col("paid_total").cast("double")) == [
        (1, "East", False, 1.0),
        (1, "East", True, 12.0),
        (2, None, False, None),
    ]
    assert c.cost_threshold(out.cache()) == pytest.approx(10.9)
    labels = c.label_costs(out, 10.9)
    assert rows(labels, "member_id", "in_network", "high_cost") == [(1, False, 0), (1, True, 1), (2, False, 0)]
    assert rows(c.class_balance(labels)) == [(0, 2), (1, 1)]
    feats = c.features(labels, dt.date(2024, 1, 1))
    assert rows(feats, "member_id", "age", "member_region", "in_network", "label") == [
        (1, 44.0, "East", "false", 0.0),
        (1, 44.0, "East", "true", 1.0),
        (2, None, "(missing)", "false", 0.0),
    ]


@pytest.mark.parametrize("counts", [{0.0: 900, 1.0: 100}, {0.0: 7, 1.0: 4}, {0.0: 3, 1.0: 2}, {0.0: 101, 1.0: 99, 2.0: 50}])
def test_test_sizes_are_proportional(counts):
    sizes = c.test_sizes(counts)
    total = sum(counts.values())
    assert sum(sizes.values()) == -(-total * 2 // 10)
    for k, n in counts.items():
        assert abs(sizes[k] - n * 0.2) <= 1


def test_split_is_exact_and_repeatable(population, rows):
    counts = {0.0: 900, 1.0: 100}
    train, test = c.stratified_split(population, "label", ["k"], counts)
    assert rows(test.groupBy("label").count()) == [(0.0, 180), (1.0, 20)]
    assert rows(train.groupBy("label").count()) == [(0.0, 720), (1.0, 80)]
    again = c.stratified_split(population.repartition(7), "label", ["k"], counts)[1]
    assert rows(again, "k") == rows(test, "k")
    assert rows(c.stratified_split(population, "label", ["k"], counts, seed=1)[1], "k") != rows(test, "k")


def test_separable_classes_are_found(population):
    score = c.evaluate(population, ["k"])
    assert score.label == "LogisticRegression accuracy" and score.accuracy > 0.99
    assert score.line.startswith("LogisticRegression accuracy: ") and len(score.line.split(": ")[1]) == 6
    assert c.evaluate(population, ["k"], stratify=False).accuracy > 0.99


def test_unseen_categories_encode_as_zeros(spark, population):
    model = c.fit(population)
    odd = rows_frame(spark, [(1, 30.0, "Nowhere", "true", 0.0), (2, 30.0, "West", "true", 0.0)])
    vectors = {r["k"]: r["features"].toArray() for r in model.transform(odd).collect()}
    assert len(vectors[1]) == 1 + 2 + 1
    assert vectors[1][1:3].sum() == 0 and vectors[2][1:3].sum() == 1
    scaled = model.transform(population).agg(F.avg("_scaled"), F.stddev_pop("_scaled")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9) and scaled[1] == pytest.approx(1)


def test_penalty_and_weights_match_the_balanced_definition(population):
    """At the optimum the gradient of  sum(w_i * logloss_i) + |b|^2 / 2  is zero."""
    model = c.fit(population)
    regression = model.stages[-1]
    weight = F.when(F.col("label") == 1, 1000 / 200).otherwise(1000 / 1800)
    scored = model.transform(population).select("features", "label", "probability", weight.alias("w")).collect()
    gradient = regression.coefficients.toArray().copy()
    for r in scored:
        gradient += r["w"] * (r["probability"][1] - r["label"]) * r["features"].toArray()
    assert abs(gradient).max() < 0.05


def test_one_class_is_skipped(spark):
    score = c.evaluate(rows_frame(spark, [(i, 30.0, "E", "true", 0.0) for i in range(5)]), ["k"])
    assert score.line == "LogisticRegression skipped (single target class), baseline accuracy: 1.0000"


def test_tiny_class_is_scored_on_all_rows(spark):
    score = c.evaluate(rows_frame(spark, [(i, 30.0 + i, "E", "true", float(i == 8)) for i in range(9)]), ["k"])
    assert score.label == "LogisticRegression train accuracy (fallback, no stratified split)"
    assert 0.5 < score.accuracy <= 1


def test_rows_without_age_are_counted_and_left_out(spark, population):
    more = population.unionByName(rows_frame(spark, [(5000 + i, None, "East", "true", 1.0) for i in range(7)]))
    score = c.evaluate(more, ["k"])
    assert score.rows_without_age == 7 and score.accuracy > 0.99
