"""Warehouse quality gate: eleven counts in one row, failures collected, JSON report."""

from __future__ import annotations

import datetime as dt

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.distinct import surplus_of
from claimloom.operators.filters import missing_counts
from claimloom.sources.store import TableStats

# The checks in report order
CHECKS = [
    "dim_member_count",
    "dim_provider_count",
    "dim_date_count",
    "fact_claims_count",
    "fact_claims_dup_claim_id",
    "missing_member_refs",
    "missing_provider_refs",
    "missing_date_refs",
    "null_member_pk",
    "null_provider_pk",
    "null_date_pk",
]

# What makes the gate fail (an empty provider table does not)
FAILURES = [
    ("dim_member_count = 0", "dim_member is empty"),
    ("dim_date_count = 0", "dim_date is empty"),
    ("fact_claims_count = 0", "fact_claims is empty"),
    ("fact_claims_dup_claim_id > 0", "duplicate claim_id in fact_claims"),
    ("null_member_pk > 0 or null_provider_pk > 0", "NULL primary keys found in dimensions"),
    ("null_date_pk > 0", "NULL primary keys found in dim_date"),
    ("missing_member_refs > 0", "fact_claims contains member_id values not present in dim_member"),
    ("missing_provider_refs > 0", "fact_claims contains provider_id values not present in dim_provider"),
    ("missing_date_refs > 0", "fact_claims contains date_key values not present in dim_date"),
]


def _metrics(df: DataFrame, **named: Column) -> DataFrame:
    """Aggregates of one frame as (name, value) rows, computed in one pass."""
    pairs = [F.struct(F.lit(n).alias("name"), c.cast("bigint").alias("value")) for n, c in named.items()]
    return df.agg(F.array(*pairs).alias("m")).select(F.inline("m"))


def missing_refs(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Fact rows without a dimension row, per dimension; null fact keys count.

    ``dims`` maps a metric name to (dimension, dimension key, fact key). Keys that
    are dense numbers or dates are probed in filters, in one pass that moves no
    fact row. Otherwise the fact is scanned once, its rows are counted per kind and
    key before the shuffle, and all kinds are joined together as texts.
    """
    names = list(dims)
    counts = missing_counts(fact, dims)
    if counts is not None:
        pairs = [F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]
        return counts.select(F.inline(F.array(*pairs)))
    cells = [F.struct(F.lit(i).alias("kind"), F.col(dims[n][2]).cast("string").alias("key")) for i, n in enumerate(names)]
    per_key = fact.select(F.inline(F.array(*cells))).groupBy("kind", "key").agg(F.count("*").alias("rows"))
    listed = None
    for i, n in enumerate(names):
        dim, dim_key, _ = dims[n]
        part = dim.select(F.lit(i).alias("kind"), F.col(dim_key).cast("string").alias("key"))
        listed = part if listed is None else listed.unionByName(part)
    orphans = per_key.join(listed, ["kind", "key"], "left_anti")
    return _metrics(orphans, **{n: F.coalesce(F.sum(F.when(F.col("kind") == i, F.col("rows"))), F.lit(0)) for i, n in enumerate(names)})


def _known(spark: SparkSession, **values: int) -> DataFrame:
    """Values that a write has counted, as (name, value) rows."""
    return spark.createDataFrame(list(values.items()), "name string, value bigint")


def check_metrics(
    members: DataFrame, providers: DataFrame, dates: DataFrame, fact: DataFrame, observed: Mapping[str, TableStats] | None = None
) -> DataFrame:
    """All check values as (name, value) rows. What was counted while the tables were written is not counted again."""
    observed = observed or {}

    def dim(df: DataFrame, name: str, key: str) -> DataFrame:
        if (stats := observed.get(f"dim_{name}")) is not None:
            return _known(df.sparkSession, **{f"dim_{name}_count": stats.rows, f"null_{name}_pk": stats.nulls[key]})
        return _metrics(df, **{f"dim_{name}_count": F.count("*"), f"null_{name}_pk": F.count_if(F.col(key).isNull())})

    def of_fact() -> list[DataFrame]:
        ids, surplus = surplus_of(fact, "claim_id")
        if (stats := observed.get("fact_claims")) is not None:
            return [_known(fact.sparkSession, fact_claims_count=stats.rows), _metrics(ids, fact_claims_dup_claim_id=surplus)]
        rows = F.count("*") if ids is fact else F.coalesce(F.sum("rows"), F.lit(0))
        return [_metrics(ids, fact_claims_count=rows, fact_claims_dup_claim_id=F.coalesce(surplus, F.lit(0)))]

    parts = [
        dim(members, "member", "member_id"),
        dim(providers, "provider", "provider_id"),
        dim(dates, "date", "date_key"),
        *of_fact(),
        missing_refs(
            fact,
            {
                "missing_member_refs": (members, "member_id", "member_id"),
                "missing_provider_refs": (providers, "provider_id", "provider_id"),
                "missing_date_refs": (dates, "date_key", "date_key"),
            },
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_checks(
    members: DataFrame, providers: DataFrame, dates: DataFrame, fact: DataFrame, observed: Mapping[str, TableStats] | None = None
) -> DataFrame:
    """One row: the check values, the joined failure texts and the status."""
    metrics = check_metrics(members, providers, dates, fact, observed)
    row = metrics.agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in CHECKS])
    texts = [F.when(F.expr(condition), F.lit(text)) for condition, text in FAILURES]
    row = row.withColumn("failures", F.concat_ws("; ", *texts))
    return row.withColumn("status", F.when(F.col("failures") == "", "ok").otherwise("failed"))


def enforce(checks: DataFrame) -> dict:
    """Raise if the gate failed; otherwise return the check values and status."""
    row = checks.first().asDict()
    failures = row.pop("failures")
    if failures:
        raise RuntimeError(f"DW quality checks failed: {failures}")
    return row


def write_quality_report(spark: SparkSession, results: dict, path: str, at: dt.datetime | None = None) -> None:
    """One JSON object ``{generated_at, checks}``. Called only after the gate passed."""
    at = at or dt.datetime.now(dt.timezone.utc)
    stamp = at.isoformat(timespec="seconds").replace("+00:00", "Z")
    checks = F.struct(*[F.lit(v).alias(k) for k, v in results.items()])
    report = spark.range(1).select(F.lit(stamp).alias("generated_at"), checks.alias("checks"))
    report.write.mode("overwrite").json(path)


def read_quality_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per check: name and value as text."""
    report = spark.read.json(path)
    names = report.schema["checks"].dataType.names
    pairs = [F.struct(F.lit(n).alias("check"), F.col(f"checks.{n}").cast("string").alias("value")) for n in names]
    return report.select("generated_at", F.inline(F.array(*pairs)))
