"""Report files: CSVs, the validated report set by sheet name, the metrics line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.model import EMPTY_SHEET, METRICS_SHEET, SHEETS
from claimloom.operators.validate import require_report_columns
from claimloom.operators.ordinals import ORD, add_file_ordinal, tag_by_file
from claimloom.plans.reports import in_report_order
from claimloom.session import stage
from claimloom.sources.feeds import read_optional, scan_csv

EMPTY_STATUS = "No output data available. Run the pipeline first."


FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Headed CSV files that hold the rows of ``df`` in its order, file after file.

    A sorted frame is range partitioned: each task writes its range, in files of
    at most ``file_rows`` rows, and file names follow the order. Small results
    come out as one file, as adaptive execution merges their partitions.
    """
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", file_rows).csv(path)


def read_csv_in_order(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_csv`` wrote, with ``_ord``: 0, 1, 2, ... in the order in which it was written."""
    scan = scan_csv(spark, path)
    rows, paths = tag_by_file(scan, [F.col(f"`{c}`") for c in scan.columns])
    return add_file_ordinal(stage(rows, "ordered_csv"), paths)


def write_reports(reports: Mapping[str, DataFrame], folder: str, file_rows: int = FILE_ROWS) -> None:
    for name, df in reports.items():
        write_csv(in_report_order(name, df), f"{folder}/{name}.csv", file_rows)


def read_metrics(spark: SparkSession, folder: str) -> str | None:
    try:
        lines = spark.read.text(f"{folder}/model_metrics.txt", wholetext=True).collect()  # a one-line file
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return "".join(r["value"] for r in lines) or None


def read_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    """The stored reports in the order of their files; None for one that was never written."""

    def read(path: str) -> DataFrame | None:
        return None if read_optional(spark, path) is None else read_csv_in_order(spark, path).orderBy(ORD).drop(ORD)

    return {name: read(f"{folder}/{name}.csv") for name in SHEETS}


def report_set(spark: SparkSession, reports: Mapping[str, DataFrame | None], metrics: str | None) -> dict[str, DataFrame]:
    """Present reports under their sheet names, validated; a status sheet if there is nothing."""
    present = {name: df for name, df in reports.items() if df is not None}
    for name, df in present.items():
        require_report_columns(name, df)
    out = {SHEETS[name]: df for name, df in present.items() if name in SHEETS}
    if metrics:
        out[METRICS_SHEET] = spark.range(1).select(F.lit(metrics).alias("metric"))
    if not out:
        out[EMPTY_SHEET] = spark.range(1).select(F.lit(EMPTY_STATUS).alias("status"))
    return out


def export_reports(spark: SparkSession, folder: str, target: str) -> list[str]:
    """Compile a folder of reports into one CSV per sheet under ``target``; returns the sheet names."""
    sheets = report_set(spark, read_reports(spark, folder), read_metrics(spark, folder))
    for name, df in sheets.items():
        write_csv(df, f"{target}/{name}")
    return list(sheets)


def append_column_csv(spark: SparkSession, source: str, target: str, name: str, column: Column) -> None:
    """Read a CSV, add a column, write a CSV (as many files as the input has splits)."""
    df = scan_csv(spark, source).withColumn(name, column)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(target)
