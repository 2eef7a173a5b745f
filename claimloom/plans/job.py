"""The daily batch: feed -> operational tables -> reports -> warehouse -> checks -> model -> export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from claimloom.model import SUMMARY_TABLES
from claimloom.plans import classifier, export, ingest, quality, reports, warehouse
from claimloom.session import input_bytes, sized_for, stage, staging_scope
from claimloom.sources import store
from claimloom.sources.config import FeedConfig


def report_frames(tables: Mapping[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The five reports; the fact is joined and scanned once for all of them."""
    measures = reports.batch_measures(tables["claim"], tables["member"], tables["provider"], as_of)
    return reports.reports_of(stage(reports.rollups(reports.claim_cube(measures)), "rollups"))


def run_reports(tables: Mapping[str, DataFrame], folder: str, as_of: dt.date) -> dict[str, DataFrame]:
    out = report_frames(tables, as_of)
    export.write_reports(out, folder)
    return out


def build_warehouse(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    report_frames: Mapping[str, DataFrame],
    root: str,
    quality_path: str,
    as_of: dt.date,
    calendar_start: dt.date = warehouse.CALENDAR_START,
) -> dict[str, DataFrame]:
    """Full refresh of the star schema and summaries; committed, and reported as JSON, if the gate passes."""
    results: dict = {}

    def gate(written: dict[str, DataFrame], observed: dict[str, store.TableStats]) -> None:
        star = (written[n] for n in ("dim_member", "dim_provider", "dim_date", "fact_claims"))
        results.update(quality.enforce(quality.run_checks(*star, observed=observed)))

    store.publish(
        spark,
        root,
        {
            "dim_member": warehouse.dim_member(tables["member"], as_of),
            "dim_provider": warehouse.dim_provider(tables["provider"]),
            "dim_date": warehouse.dim_date(spark, as_of, calendar_start).coalesce(1),
            "fact_claims": warehouse.partitioned_fact(warehouse.fact_claims(tables["claim"])),
            **{name: report_frames[source] for name, source in SUMMARY_TABLES.items()},
        },
        partition_by={"fact_claims": ["year", "month"]},
        check=gate,
    )
    quality.write_quality_report(spark, results, quality_path)
    return store.open_tables(spark, root)


def feed_bytes(spark: SparkSession, config: FeedConfig) -> int:
    """Size of the configured files; a missing one is left for the reader to report."""
    try:
        return input_bytes(spark, config.files.values())
    except Py4JJavaError:
        return 0


def run_feed(spark: SparkSession, config: FeedConfig, root: str, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Everything for one feed, under a folder of its own (feeds never share output).

    Report files are written after the warehouse has passed its gate, so a
    failed load leaves the reports beside the warehouse that they were made with.
    """
    as_of = as_of or dt.date.today()
    home = f"{root.rstrip('/')}/{config.feed_id}"
    with staging_scope(spark), sized_for(spark, feed_bytes(spark, config)):
        tables = ingest.ingest(spark, config, f"{home}/operational", as_of)
        frames = report_frames(tables, as_of)
        score = classifier.high_cost_score(tables["claim"], tables["member"], tables["provider"], as_of)
        stored = build_warehouse(spark, tables, frames, f"{home}/warehouse", f"{home}/quality", as_of)
        export.write_reports(frames, f"{home}/reports")
        classifier.write_metrics(spark, score, f"{home}/reports/model_metrics.txt")
        export.export_reports(spark, f"{home}/reports", f"{home}/export")
        for kept in ("operational", "warehouse"):
            store.vacuum(spark, f"{home}/{kept}")
    return stored
