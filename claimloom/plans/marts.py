"""Roll-ups behind the dashboard, built from the report frames (small by then)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.exprs import money_text, network_label, pct_text
from claimloom.plans.reports import with_loss_ratios

TOP = 10


def _sums(*names: str):
    """Exact sums: counts as BIGINT, money through DECIMAL so that row order cannot matter."""
    out = []
    for name in names:
        if name == "claims":
            out.append(F.coalesce(F.sum(name), F.lit(0)).alias(name))
        else:
            total = F.sum(F.col(name).cast("decimal(28,2)")).cast("double")
            out.append(F.coalesce(total, F.lit(0.0)).alias(name))
    return out


def kpi_cards(kpis: DataFrame) -> DataFrame:
    totals = kpis.agg(*_sums("paid_total", "claims"))
    average = F.when(F.col("claims") > 0, F.col("paid_total") / F.nullif(F.col("claims"), F.lit(0))).otherwise(0.0)
    return totals.select(
        F.col("paid_total").alias("total_paid"),
        F.col("claims").alias("total_claims"),
        average.alias("paid_avg"),
        money_text(F.col("paid_total"), 0).alias("total_paid_text"),
        F.format_number("claims", 0).alias("total_claims_text"),
        money_text(average, 2).alias("paid_avg_text"),
    )


def region_totals(kpis: DataFrame) -> DataFrame:
    return kpis.dropna(subset=["member_region"]).groupBy("member_region").agg(*_sums("claims", "paid_total"))


def top_regions(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.col("paid_total").desc(), F.col("member_region").asc_nulls_last()).limit(TOP)


def region_network_paid(kpis: DataFrame) -> DataFrame:
    """Paid total by network label and region, for the top regions."""
    keep = top_regions(region_totals(kpis)).select("member_region")
    return (
        kpis.join(keep, "member_region", "left_semi")
        .groupBy(network_label(F.col("in_network")).alias("network"), "member_region")
        .agg(*_sums("paid_total"))
    )


def monthly_region(monthly: DataFrame) -> DataFrame:
    """Month series per top region, network collapsed."""
    series = (
        monthly.dropna(subset=["month", "member_region"])
        .groupBy("month", "member_region")
        .agg(*_sums("paid_total", "claims"))
    )
    keep = top_regions(series.groupBy("member_region").agg(*_sums("paid_total"))).select("member_region")
    return series.join(keep, "member_region", "left_semi").orderBy("member_region", "month")


def region_loss_ratio(loss_ratio: DataFrame) -> DataFrame:
    """Loss ratio per top region from the collapsed totals; a null region is a region."""
    totals = loss_ratio.groupBy("member_region").agg(*_sums("claims", "billed_total", "allowed_total", "paid_total"))
    keep = top_regions(totals).select(F.col("member_region").alias("top_region"))
    kept = totals.join(keep, F.col("member_region").eqNullSafe(F.col("top_region")), "left_semi")
    return with_loss_ratios(kept).drop("allowed_ratio_pct")


def chart_flags(region_loss: DataFrame) -> DataFrame:
    """Which loss-ratio charts have anything to show."""
    return region_loss.agg(
        *[
            F.coalesce(F.bool_or(condition), F.lit(False)).alias(name)
            for name, condition in {
                "has_loss_ratio": F.col("loss_ratio_pct").isNotNull(),
                "has_billed": F.col("billed_total") > 0,
                "has_allowed": F.col("allowed_total") > 0,
            }.items()
        ]
    )


def network_mart(network: DataFrame) -> DataFrame:
    return network.select(
        network_label(F.col("in_network")).alias("network"),
        "claims",
        "paid_total",
        pct_text(F.col("utilization_pct"), "% util.").alias("utilization_text"),
    )


def diagnosis_top10(diagnosis: DataFrame) -> DataFrame:
    return diagnosis.orderBy(F.col("paid_total").desc(), F.col("diagnosis_code").asc_nulls_last()).limit(TOP)
