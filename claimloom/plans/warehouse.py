"""Star schema: dimensions, calendar, fact and summary tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.exprs import age_band, age_years

CALENDAR_START = dt.date(2010, 1, 1)


def dim_member(members: DataFrame, as_of: dt.date) -> DataFrame:
    return members.select(
        "member_id", "dob", "gender", "region", age_band(age_years(F.col("dob"), as_of)).alias("age_band")
    )


def dim_provider(providers: DataFrame) -> DataFrame:
    return providers.select("provider_id", "specialty", "in_network", "region")


def calendar_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    ]


def dim_date(spark: SparkSession, as_of: dt.date, start: dt.date = CALENDAR_START) -> DataFrame:
    """Every day from ``start`` to one year after ``as_of``, both included."""
    days = F.sequence(F.lit(start), F.add_months(F.lit(as_of), 12), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_key")).select("date_key", *calendar_parts(F.col("date_key")))


def dim_date_covering(days: DataFrame, column: str) -> DataFrame:
    """A calendar over the days of a fact: from its first day to one year after its last."""
    bounds = days.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    sequence = F.sequence(F.col("first"), F.add_months(F.col("last"), 12), F.expr("interval 1 day"))
    return bounds.select(F.explode(sequence).alias("date_key")).select(
        "date_key", *calendar_parts(F.col("date_key"))
    )


def fact_claims(claims: DataFrame) -> DataFrame:
    money = [F.col(c).cast("double").alias(c) for c in ("billed_amount", "allowed_amount", "paid_amount")]
    return claims.select(
        "claim_id",
        "member_id",
        "provider_id",
        F.col("service_date").alias("date_key"),
        *money,
        "diagnosis_code",
        "procedure_code",
        "place_of_service",
    )


def partitioned_fact(fact: DataFrame) -> DataFrame:
    """The fact with its storage partitions (service year and month), balanced for writing.

    The rebalance hint lets adaptive execution split a month that holds a third
    of the rows and merge small ones, so files come out of even size.
    """
    day = F.col("date_key")
    return fact.withColumns({"year": F.year(day), "month": F.month(day)}).hint("rebalance", "year", "month")


def in_months(fact: DataFrame, year: int, months: range) -> DataFrame:
    """Rows of the stored fact for some months of a year: the other partitions' files are not opened."""
    return fact.where((F.col("year") == year) & F.col("month").between(months.start, months.stop - 1))


def with_calendar(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The stored fact with its calendar columns (inner: rows without a date drop out).

    The join also names the storage partitions, so that a filter on the calendar
    prunes the fact's files when the query runs.
    """
    days = dates.withColumnRenamed("month_num", "month")
    return fact.join(days, ["year", "month", "date_key"])
