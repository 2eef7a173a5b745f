"""High-cost member classifier: cost per member, threshold, logistic regression."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.exprs import age_years, over_threshold
from claimloom.operators.joins import join_dimension
from claimloom.operators.order_stats import exact_quantiles, in_units, ranked_values
from claimloom.session import new_path, stage

COST_QUANTILE = 0.9
TEST_SHARE = 0.2
SEED = 42
MAX_ITER = 1000
CATEGORIES = ["member_region", "in_network"]

# --- Fixed values: texts of the metric line -------------------------------------
LABEL_SPLIT = "LogisticRegression accuracy"
LABEL_SINGLE = "LogisticRegression skipped (single target class), baseline accuracy"
LABEL_TRAIN = "LogisticRegression train accuracy (fallback, no stratified split)"


@dataclass(frozen=True)
class Score:
    label: str
    accuracy: float
    rows_without_age: int = 0

    @property
    def line(self) -> str:
        return f"{self.label}: {self.accuracy:.4f}"


def member_cost(claims: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """Paid total per member and network status, with the member's attributes.

    Claims are summed per member before they meet the member table: a member
    with a third of all claims is one row per task by then, and the member side
    joins sums instead of claims.
    """
    provider = providers.select("provider_id", "in_network")
    sums = (
        join_dimension(claims.select("member_id", "provider_id", "paid_amount"), provider, "provider_id")
        .groupBy("member_id", "in_network")
        .agg(F.sum("paid_amount").cast("decimal(22,2)").alias("paid_total"))
    )
    member = members.select("member_id", "dob", F.col("region").alias("member_region"))
    return join_dimension(sums, member, "member_id").select(
        "member_id", "dob", "member_region", "in_network", "paid_total"
    )


def cost_threshold(costs: DataFrame, q: float = COST_QUANTILE) -> float | None:
    """Exact interpolated quantile of the paid totals. ``costs`` is read several times."""
    cents = costs.select(in_units(F.col("paid_total"), 2).alias("cents"))
    return exact_quantiles(cents, "cents", [q], scale=2)[""][0]


def label_costs(costs: DataFrame, threshold: float | None) -> DataFrame:
    """``high_cost`` is 1 for totals strictly above the threshold (a null total is 0)."""
    above = over_threshold(F.col("paid_total").cast("double"), F.lit(threshold).cast("double"))
    return costs.withColumn("high_cost", F.coalesce(above, F.lit(0)))


def class_balance(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("high_cost").agg(F.count("*").alias("members"))


def features(labelled: DataFrame, as_of: dt.date) -> DataFrame:
    """Model inputs; a missing category is a category, a missing age stays null."""
    return labelled.select(
        "member_id",
        age_years(F.col("dob"), as_of).cast("double").alias("age"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("(missing)")).alias(c) for c in CATEGORIES],
        F.col("high_cost").cast("double").alias("label"),
    )


# ---- split ---------------------------------------------------------------------
def with_split_hash(rows: DataFrame, keys: list[str], seed: int = SEED) -> DataFrame:
    """Two 64-bit hashes of a row's keys that order rows at random but repeatably; the second settles ties of the first."""
    return rows.withColumns({"_hash": F.xxhash64(F.lit(seed), *keys), "_tie": F.xxhash64(F.lit(~seed), *keys)})


def test_sizes(counts: dict[float, int], share: float = TEST_SHARE) -> dict[float, int]:
    """Test rows per class: proportional, summing to ceil(share * n), largest remainders up."""
    total = sum(counts.values())
    wanted = math.ceil(total * share)
    exact = {c: n * wanted / total for c, n in counts.items()}
    sizes = {c: math.floor(x) for c, x in exact.items()}
    for c in sorted(exact, key=lambda c: (sizes[c] - exact[c], c))[: wanted - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def stratified_split(
    rows: DataFrame, label: str, keys: list[str], counts: dict[float, int], share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test): per class the rows with the smallest hashes are the test rows.

    Instead of a global sort the cut hash of each class is found as an order
    statistic, and so is the cut of the second hash among the rows that share the
    first; the split itself is a filter. ``keys`` identify a row.
    """
    hashed = with_split_hash(rows, keys, seed)
    sizes = {str(c): k for c, k in test_sizes(counts, share).items() if k > 0}
    name, first, second = F.col(label).cast("string"), F.col("_hash"), F.col("_tie")
    cuts = {c: cut for (c, _), cut in ranked_values(hashed, "_hash", {c: [k - 1] for c, k in sizes.items()}, group=label).items()}
    below, at_cut = F.lit(False), F.lit(False)
    for c, cut in cuts.items():
        below, at_cut = below | ((name == c) & (first < cut)), at_cut | ((name == c) & (first == cut))
    taken = {r[0]: r[1] for r in hashed.filter(below).groupBy(name).agg(F.count("*")).collect()}
    tied = hashed.filter(at_cut)
    last = ranked_values(tied, "_tie", {c: [sizes[c] - 1 - taken.get(c, 0)] for c in cuts}, group=label)
    is_test = below
    for (c, _), tie in last.items():
        is_test = is_test | ((name == c) & (first == cuts[c]) & (second <= tie))
    return hashed.filter(~is_test).drop("_hash", "_tie"), hashed.filter(is_test).drop("_hash", "_tie")


# ---- model ---------------------------------------------------------------------
def fit(train: DataFrame, numeric: str = "age", categories: list[str] | None = None) -> PipelineModel:
    """Standardised age, full one-hot categories, balanced L2 logistic regression.

    ``handleInvalid='keep'`` with ``dropLast`` encodes an unseen category as
    zeros. Balanced class weights sum to n, so a unit penalty is ``regParam=1/n``.
    """
    categories = CATEGORIES if categories is None else categories
    stats = train.agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.avg(numeric).alias("mean"),
        F.stddev_pop(numeric).alias("std"),
    ).first()
    n, positives = stats["n"], stats["positives"]
    weighted = train.withColumn(
        "_weight", F.when(F.col("label") == 1, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
    )
    indexer = StringIndexer(
        inputCols=categories, outputCols=[f"{c}_ix" for c in categories], handleInvalid="keep"
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in categories], outputCols=[f"{c}_hot" for c in categories], dropLast=True
    )
    scaler = _standardise(numeric, stats["mean"], stats["std"])
    assembler = VectorAssembler(inputCols=["_scaled", *[f"{c}_hot" for c in categories]], outputCol="features")
    regression = LogisticRegression(weightCol="_weight", maxIter=MAX_ITER, regParam=1.0 / n, standardization=False)
    fitted = Pipeline(stages=[scaler, indexer, encoder, assembler, regression]).fit(weighted)
    # stored and read back: a model fresh from its fit holds the session, which tasks cannot be sent once a write was observed
    path = new_path(train.sparkSession, "model")
    fitted.write().save(path)
    return PipelineModel.load(path)


def _standardise(column: str, mean: float, std: float):
    """Centre and scale by the population deviation (Spark's scaler uses the sample one)."""
    scale = 1 / std if std else 1.0
    return SQLTransformer(statement=f"SELECT *, ({column} - ({mean!r})) * ({scale!r}) AS _scaled FROM __THIS__")


def accuracy(model: PipelineModel, rows: DataFrame) -> float:
    return model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def evaluate(rows: DataFrame, keys: list[str], stratify: bool = True, numeric: str = "age",
             categories: list[str] | None = None) -> Score:
    """Fit and score; rows without an age cannot be fitted and are left out (and counted).

    ``rows`` is read many times: pass a stored frame.
    """
    groups = rows.groupBy("label").agg(F.count("*").alias("n"), F.count(numeric).alias("usable")).collect()
    dropped = sum(r["n"] - r["usable"] for r in groups)
    counts = {r["label"]: r["usable"] for r in groups if r["usable"]}
    if len(counts) < 2:
        return Score(LABEL_SINGLE, 1.0, dropped)
    usable = rows.filter(F.col(numeric).isNotNull())
    if stratify and min(counts.values()) < 2:
        model = fit(usable, numeric, categories)
        return Score(LABEL_TRAIN, accuracy(model, usable), dropped)
    if stratify:
        train, test = stratified_split(usable, "label", keys, counts)
    else:
        train, test = plain_split(usable, keys)
    model = fit(train, numeric, categories)
    return Score(LABEL_SPLIT, accuracy(model, test), dropped)


def plain_split(rows: DataFrame, keys: list[str], share: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Unstratified: a row is a test row if its hash falls in the lowest ``share``."""
    hashed = with_split_hash(rows, keys, seed)
    is_test = F.col("_hash") < int((1 << 64) * share) - (1 << 63)
    return hashed.filter(~is_test).drop("_hash", "_tie"), hashed.filter(is_test).drop("_hash", "_tie")


def high_cost_score(claims: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date) -> Score:
    """The whole model run. Member costs are stored once and read by every later step."""
    costs = stage(member_cost(claims, members, providers), "member_cost")
    labelled = label_costs(costs, cost_threshold(costs))
    return evaluate(features(labelled, as_of), ["member_id", "in_network"])


def score_frame(spark: SparkSession, score: Score) -> DataFrame:
    return spark.range(1).select(F.lit(score.label).alias("metric"), F.lit(score.accuracy).alias("score"))


def write_metrics(spark: SparkSession, score: Score, path: str) -> None:
    spark.range(1).select(F.lit(score.line).alias("value")).coalesce(1).write.mode("overwrite").text(path)
