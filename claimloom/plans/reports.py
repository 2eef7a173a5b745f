"""The five KPI reports.

Every report is a roll-up of additive measures, so it can run on claim rows or
on a pre-aggregated cube. A single report rolls up the claim rows directly;
the full set builds the cube once (one pass over the fact, one shuffle of a few
thousand groups) and rolls that up five times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.exprs import age_band, age_years, as_double, guarded_pct, month_start, round_even
from claimloom.model import AGE_LABELS, REPORT_COLUMNS
from claimloom.operators.filters import classed_rows, known_rows
from claimloom.operators.joins import join_dimension

CUBE_KEYS = ["age_band", "member_region", "in_network", "month", "diagnosis_code"]
MEASURES = ["claims", "paid_claims", "paid", "billed", "allowed"]


def joined_claims(claims: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date) -> DataFrame:
    """Claims with their member and provider attributes; claims without either drop out.

    The provider side goes first: it is the smaller one and usually broadcast.
    Bands and months are computed on the narrow side of each join.
    """
    member = members.select(
        "member_id",
        age_band(age_years(F.col("dob"), as_of)).alias("age_band"),
        F.col("region").alias("member_region"),
    )
    provider = providers.select("provider_id", "in_network")
    return join_dimension(join_dimension(claims, provider, "provider_id"), member, "member_id")


def member_measures(claims: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date) -> DataFrame:
    """The measures of ``joined_claims``, summed per member before they meet the member table.

    Measures are additive, so the claims of a member, however many, are a row
    per network status, month and diagnosis (where the claims have these) and task.
    """
    provider = providers.select("provider_id", "in_network")
    keys = ["member_id", "in_network"]
    measured = claim_measures(join_dimension(claims, provider, "provider_id"), ["member_id"])
    keys += [k for k, c in (("month", "service_date"), ("diagnosis_code", "diagnosis_code")) if c in claims.columns]
    missing = [c for c in ("month", "diagnosis_code") if c not in keys]
    sums = measured.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])
    member = members.select(
        "member_id",
        age_band(age_years(F.col("dob"), as_of)).alias("age_band"),
        F.col("region").alias("member_region"),
    )
    kinds = dict(measured.dtypes)
    joined = join_dimension(sums, member, "member_id").withColumns({c: F.lit(None).cast(kinds[c]) for c in missing})
    return joined.select(*CUBE_KEYS, *MEASURES)


def batch_measures(claims: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date) -> DataFrame:
    """The measures for all reports at once. By month and diagnosis a member rarely has two claims, so sums per member gain nothing.

    Band and region of dense numeric members are looked up where the claims are;
    those of others are joined to sums per member.
    """
    member = members.select(
        "member_id",
        age_band(age_years(F.col("dob"), as_of)).alias("age_band"),
        F.col("region").alias("member_region"),
    )
    provider = providers.select("provider_id", "in_network")
    measured = claim_measures(join_dimension(claims, provider, "provider_id"), ["member_id"])
    found = classed_rows(measured, member, "member_id", ["age_band", "member_region"])
    return member_measures(claims, members, providers, as_of) if found is None else found.select(*CUBE_KEYS, *MEASURES)


def claim_rows(claims: DataFrame, members: DataFrame, providers: DataFrame, as_of: dt.date) -> DataFrame:
    """The measures claim by claim, for a report by month: a member rarely has two claims in one, so sums per member gain nothing."""
    return claim_measures(joined_claims(claims, members, providers, as_of)).select(*CUBE_KEYS, *MEASURES)


def known_claims(claims: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """The measures of claims that have both a member and a provider, without any of their attributes.

    Where the keys are dense numbers they are probed in filters and no claim is
    moved before it is grouped.
    """
    rows = known_rows(known_rows(claims, providers, "provider_id"), members, "member_id")
    nothing = {"age_band": "string", "member_region": "string", "in_network": "boolean"}
    rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in nothing.items()})
    return claim_measures(rows).select(*CUBE_KEYS, *MEASURES)


def _or_missing(df: DataFrame, name: str, dtype: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def claim_measures(joined: DataFrame, keys: Sequence[str] = ("age_band", "member_region")) -> DataFrame:
    """Additive measures per claim. ``paid_claims`` counts the claims an average divides by."""
    return joined.select(
        *keys,
        "in_network",
        month_start(_or_missing(joined, "service_date", "date")).alias("month"),
        _or_missing(joined, "diagnosis_code", "string").alias("diagnosis_code"),
        F.col("claim_id").isNotNull().cast("bigint").alias("claims"),
        F.col("paid_amount").isNotNull().cast("bigint").alias("paid_claims"),
        F.col("paid_amount").alias("paid"),
        _or_missing(joined, "billed_amount", "decimal(12,2)").alias("billed"),
        _or_missing(joined, "allowed_amount", "decimal(12,2)").alias("allowed"),
    )


def claim_cube(measures: DataFrame) -> DataFrame:
    return measures.groupBy(*CUBE_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


# ---- measures of a group ------------------------------------------------------
def _count() -> Column:
    return F.sum("claims").cast("bigint").alias("claims")


def _total(measure: str) -> Column:
    """Exact decimal sum, 0 for an all-null group."""
    return F.coalesce(as_double(F.sum(measure)), F.lit(0.0)).alias(f"{measure}_total")


def _paid_avg() -> Column:
    """Mean over the claims that have a paid amount; null if none has."""
    return (as_double(F.sum("paid")) / F.nullif(F.sum("paid_claims"), F.lit(0))).alias("paid_avg")


# ---- reports ------------------------------------------------------------------
def kpis(measures: DataFrame) -> DataFrame:
    return measures.groupBy("age_band", "member_region", "in_network").agg(_count(), _total("paid"), _paid_avg())


def monthly(measures: DataFrame) -> DataFrame:
    keys = ["month", "member_region", "in_network"]
    return measures.dropna(subset=keys).groupBy(*keys).agg(_count(), _total("paid"))


def loss_ratio(measures: DataFrame) -> DataFrame:
    totals = measures.groupBy("member_region", "in_network").agg(
        _count(), _total("billed"), _total("allowed"), _total("paid")
    )
    return with_loss_ratios(totals)


def with_loss_ratios(totals: DataFrame) -> DataFrame:
    return totals.select(
        "*",
        guarded_pct(F.col("paid_total"), F.col("billed_total")).alias("loss_ratio_pct"),
        guarded_pct(F.col("allowed_total"), F.col("billed_total")).alias("allowed_ratio_pct"),
    )


def network_summary(measures: DataFrame) -> DataFrame:
    totals = measures.groupBy("in_network").agg(_count(), _total("paid"), _paid_avg())
    # in_network is boolean, so the window sees at most three rows.
    share = as_double(F.col("claims")) / F.sum("claims").over(Window.partitionBy()) * 100
    return totals.select("*", round_even(share, 2).alias("utilization_pct"))


def diagnosis_summary(measures: DataFrame) -> DataFrame:
    totals = measures.groupBy("diagnosis_code").agg(_count(), _total("paid"), _paid_avg(), _total("billed"))
    return totals.orderBy(F.col("paid_total").desc(), F.col("diagnosis_code").asc_nulls_last())


REPORTS = {
    "kpis": kpis,
    "monthly": monthly,
    "loss_ratio": loss_ratio,
    "network_summary": network_summary,
    "diagnosis_summary": diagnosis_summary,
}


def all_reports(measures: DataFrame) -> dict[str, DataFrame]:
    return {name: build(measures).select(REPORT_COLUMNS[name]) for name, build in REPORTS.items()}


#: Keys of each report; one roll-up of the batch makes them all.
GROUPINGS = {
    "kpis": ["age_band", "member_region", "in_network"],
    "monthly": ["month", "member_region", "in_network"],
    "loss_ratio": ["member_region", "in_network"],
    "network_summary": ["in_network"],
    "diagnosis_summary": ["diagnosis_code"],
}
GROUPING = "grouping"


def _grouping(report: str) -> int:
    """Grouping id of a report: a bit for each key that it has not, the first key's highest."""
    keys = GROUPINGS[report]
    return sum(1 << (len(CUBE_KEYS) - 1 - i) for i, k in enumerate(CUBE_KEYS) if k not in keys)


def rollups(cube: DataFrame) -> DataFrame:
    """The groups of all reports in one frame, told apart by ``grouping``: one scan of the cube, one Expand, one shuffle.

    A null of a key is a group of its own; a key that a report has not is null
    as well, and only the grouping id tells the two apart.
    """
    sets = [[F.col(k) for k in keys] for keys in GROUPINGS.values()]
    grouped = cube.groupingSets(sets, *CUBE_KEYS)
    return grouped.agg(F.grouping_id().alias(GROUPING), *[F.sum(m).alias(m) for m in MEASURES])


def reports_of(rolled: DataFrame) -> dict[str, DataFrame]:
    """The reports from stored ``rollups``: each reads its groups, which are summed already."""
    parts = {name: rolled.where(F.col(GROUPING) == _grouping(name)) for name in REPORTS}
    return {name: REPORTS[name](part).select(REPORT_COLUMNS[name]) for name, part in parts.items()}


def in_report_order(name: str, report: DataFrame) -> DataFrame:
    """The row order of an exported report: keys ascending, bands in band order, nulls last."""
    if name == "diagnosis_summary":
        return report.orderBy(F.col("paid_total").desc(), F.col("diagnosis_code").asc_nulls_last())
    keys = [c for c in REPORT_COLUMNS[name] if c in CUBE_KEYS]
    order = [
        F.array_position(F.array(*map(F.lit, AGE_LABELS)), F.col(k)) if k == "age_band" else F.col(k) for k in keys
    ]
    return report.orderBy(*[c.asc_nulls_last() for c in order])
