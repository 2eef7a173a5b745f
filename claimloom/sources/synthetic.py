"""Synthetic members, providers and claims at any scale.

Each value is a hash of (row id, seed, column), so a row is the same whatever
the number of partitions and whichever executor makes it (``rand(seed)`` would
depend on both).
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: value domains ----------------------------------------------
REGIONS = ["Northeast", "Southeast", "West", "Midwest", "Southwest"]
GENDERS = ["male", "female"]
SPECIALTIES = [
    "General Practice",
    "Cardiology",
    "Orthopedics",
    "Oncology",
    "Neurology",
    "Dermatology",
    "Pediatrics",
    "Psychiatry",
    "Radiology",
    "Emergency Medicine",
]
DIAGNOSES = [
    "E11.9",
    "I10",
    "J06.9",
    "M54.5",
    "Z00.00",
    "F32.9",
    "J45.20",
    "K21.0",
    "N39.0",
    "S93.40",
    "I25.10",
    "C34.10",
    "G43.909",
    "L40.0",
    "H52.4",
]
PROCEDURES = ["99213", "99214", "93000", "71046", "80053", "99283", "27447", "43239", "45378", "70553"]
PLACES = ["Office", "Hospital", "Outpatient", "Urgent Care", "Emergency"]
# --- Fixed values: distributions ----------------------------------------------
IN_NETWORK_SHARE = 0.70
BILLED_LOG_MEAN, BILLED_LOG_SIGMA = 5.5, 1.2
ALLOWED_SHARE, PAID_SHARE = (0.60, 0.95), (0.80, 1.0)
SEED = 42


def uniform(name: str, seed: int, row: str = "id") -> Column:
    """Uniform in [0, 1) from 53 bits of a row hash."""
    return F.shiftrightunsigned(F.xxhash64(F.col(row), F.lit(seed), F.lit(name)), 11) * F.lit(2.0**-53)


def normal(name: str, seed: int) -> Column:
    """Standard normal by the Box-Muller transform."""
    radius = F.sqrt(-2 * F.log(1 - uniform(f"{name}:r", seed)))
    return radius * F.cos(2 * math.pi * uniform(f"{name}:a", seed))


def whole(name: str, seed: int, low: int, high: int) -> Column:
    """Whole number in [low, high)."""
    return (F.floor(uniform(name, seed) * (high - low)) + low).cast("bigint")


def between(name: str, seed: int, low: float, high: float) -> Column:
    return uniform(name, seed) * (high - low) + low


def pick(name: str, seed: int, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (whole(name, seed, 0, len(values)) + 1).cast("int"))


def some_day(name: str, seed: int, start: dt.date, end: dt.date) -> Column:
    """A day in [start, end)."""
    return F.date_add(F.lit(start), whole(name, seed, 0, (end - start).days).cast("int"))


def _years_before(day: dt.date, years: int) -> dt.date:
    leap = (day.month, day.day) == (2, 29)
    return day.replace(year=day.year - years, day=28 if leap else day.day)


def members(spark: SparkSession, n: int, as_of: dt.date, seed: int = SEED) -> DataFrame:
    return spark.range(1, n + 1).select(
        F.col("id").alias("member_id"),
        F.col("id").alias("person_id"),
        some_day("dob", seed, _years_before(as_of, 80), _years_before(as_of, 18)).alias("dob"),
        pick("gender", seed, GENDERS).alias("gender"),
        pick("member_region", seed, REGIONS).alias("region"),
        some_day("effective", seed, dt.date(2015, 1, 1), dt.date(2023, 12, 31)).alias("effective_date"),
        F.lit(None).cast("date").alias("termination_date"),
    )


def providers(spark: SparkSession, n: int, seed: int = SEED) -> DataFrame:
    return spark.range(1, n + 1).select(
        F.col("id").alias("provider_id"),
        pick("specialty", seed, SPECIALTIES).alias("specialty"),
        (uniform("in_network", seed) < IN_NETWORK_SHARE).alias("in_network"),
        pick("provider_region", seed, REGIONS).alias("region"),
    )


def claims(spark: SparkSession, n: int, n_members: int, n_providers: int, seed: int = SEED) -> DataFrame:
    """Claims with billed >= allowed >= paid; billed is log-normal."""
    money = "decimal(12,2)"
    billed = F.exp(normal("billed", seed) * BILLED_LOG_SIGMA + BILLED_LOG_MEAN).cast(money)
    rows = spark.range(1, n + 1).select(
        F.col("id").alias("claim_id"),
        whole("member", seed, 1, n_members + 1).alias("member_id"),
        whole("provider", seed, 1, n_providers + 1).alias("provider_id"),
        some_day("service", seed, dt.date(2020, 1, 1), dt.date(2024, 12, 31)).alias("service_date"),
        pick("diagnosis", seed, DIAGNOSES).alias("diagnosis_code"),
        pick("procedure", seed, PROCEDURES).alias("procedure_code"),
        billed.alias("billed_amount"),
        between("allowed", seed, *ALLOWED_SHARE).alias("_allowed"),
        between("paid", seed, *PAID_SHARE).alias("_paid"),
        pick("place", seed, PLACES).alias("place_of_service"),
    )
    rows = rows.withColumn("allowed_amount", (F.col("billed_amount") * F.col("_allowed")).cast(money))
    rows = rows.withColumn("paid_amount", (F.col("allowed_amount") * F.col("_paid")).cast(money))
    return rows.drop("_allowed", "_paid")


def write_sample(
    spark: SparkSession,
    folder: str,
    as_of: dt.date,
    n_claims: int = 300_000,
    n_members: int = 50_000,
    n_providers: int = 2_000,
    seed: int = SEED,
) -> None:
    """Three CSV feeds with the model's own column names; claim ids are left to the loader."""
    folder = folder.rstrip("/")
    feeds = {
        "sample_members.csv": members(spark, n_members, as_of, seed),
        "sample_providers.csv": providers(spark, n_providers, seed),
        "sample_claims.csv": claims(spark, n_claims, n_members, n_providers, seed).drop("claim_id"),
    }
    for name, df in feeds.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def people(spark: SparkSession, n: int, names: Sequence[str], seed: int = SEED) -> DataFrame:
    """Names, ages (normal around 30, kept within 18..80) and scores (50..99)."""
    age = (normal("age", seed) * 10 + 30).cast("int")
    return spark.range(n).select(
        pick("name", seed, names).alias("name"),
        F.least(F.greatest(age, F.lit(18)), F.lit(80)).alias("age"),
        whole("score", seed, 50, 100).alias("score"),
    )
