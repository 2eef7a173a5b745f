"""Column expressions, with the edge values that have a defined behaviour."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.functions import exprs
from claimloom.model import AGE_LABELS

AS_OF = dt.date(2024, 1, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "days, age, band",
    [
        (-31, -1, None),
        (-400, -2, None),
        (0, 0, None),
        (364, 0, None),
        (365, 1, "0-18"),
        (18 * 365, 18, "0-18"),
        (19 * 365 - 1, 18, "0-18"),
        (19 * 365, 19, "19-30"),
        (30 * 365, 30, "19-30"),
        (45 * 365, 45, "31-45"),
        (60 * 365, 60, "46-60"),
        (61 * 365, 61, "60+"),
        (200 * 365, 200, "60+"),
        (201 * 365, 201, None),
    ],
)
def test_age_and_band(spark, days, age, band):
    dob = F.lit(AS_OF - dt.timedelta(days=days))
    assert one(spark, exprs.age_years(dob, AS_OF)) == age
    assert one(spark, exprs.age_band(exprs.age_years(dob, AS_OF))) == band


def test_missing_dob_has_no_band(spark):
    dob = F.lit(None).cast("date")
    assert one(spark, exprs.age_years(dob, AS_OF)) is None
    assert one(spark, exprs.age_band(exprs.age_years(dob, AS_OF))) is None


def test_bins_need_matching_edges():
    with pytest.raises(ValueError):
        exprs.bin_column(F.lit(1), [0, 1], ["a", "b"])


@pytest.mark.parametrize("value, even, up", [(0.125, 0.12, 0.13), (0.375, 0.38, 0.38), (0.625, 0.62, 0.63), (77.775, 77.78, 77.78)])
def test_two_kinds_of_rounding(spark, value, even, up):
    assert one(spark, exprs.round_even(F.lit(value))) == even
    assert one(spark, F.round(F.lit(value), 2)) == up


def test_guarded_pct(spark):
    assert one(spark, exprs.guarded_pct(F.lit(Decimal("300")), F.lit(Decimal("400")))) == 75.0
    assert one(spark, exprs.guarded_pct(F.lit(Decimal("1")), F.lit(Decimal("0")))) is None
    assert one(spark, exprs.guarded_pct(F.lit(1.0), F.lit(-4.0))) is None
    assert one(spark, exprs.guarded_pct(F.lit(1.0), F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("value", [True, "True", "true", 1, "1", "yes", " YES\t"])
def test_in_network_labels(spark, value):
    assert one(spark, exprs.network_label(F.lit(value))) == "In-Network"


@pytest.mark.parametrize("value", [False, "False", "false", 0, "0", "no", 1.0, "maybe", None])
def test_out_of_network_labels(spark, value):
    assert one(spark, exprs.network_label(F.lit(value))) == "Out-of-Network"


def test_dob_from_age(spark):
    as_of = dt.date(2024, 6, 15)
    for text, years in [("40", 40), ("40.5", 40.5), ("abc", 0), (None, 0)]:
        exact = dt.datetime(2024, 6, 15) - dt.timedelta(days=years * 365.25)
        assert one(spark, exprs.dob_from_age(F.lit(text).cast("string"), as_of)) == exact.date()


def test_texts(spark):
    assert one(spark, exprs.money_text(F.lit(1234567.5), 2)) == "$1,234,567.50"
    assert one(spark, exprs.pct_text(F.lit(49.95), "% util.")) == "50.0% util."
    assert one(spark, exprs.long_date(F.lit(dt.date(2023, 6, 15)))) == "June 15, 2023"
    assert one(spark, exprs.month_start(F.lit(dt.date(2023, 6, 15)))) == dt.date(2023, 6, 1)
    assert one(spark, exprs.days_after(F.lit(dt.date(2023, 12, 31)), 30)) == dt.date(2024, 1, 30)
    assert one(spark, exprs.cut_text(F.lit("abcdef"), 4)) == "abcd"
    assert one(spark, exprs.cut_text(F.lit(None).cast("string"), 4)) is None
    assert one(spark, exprs.redact_password(F.lit("db://me:pw@host/x"))) == "db://me:***@host/x"
    assert one(spark, exprs.redact_password(F.lit("db://host/x"))) == "db://host/x"
    assert one(spark, exprs.redact_password(F.lit("db://u:p@ss:w@host:1/x?m=a@b:c"))) == "db://u:***@host:1/x?m=a@b:c"
    assert one(spark, exprs.redact_password(F.lit("db://u@host/x"))) == "db://u@host/x"
    assert one(spark, exprs.redact_password(F.lit("no url: a@b"))) == "no url: a@b"
    assert one(spark, exprs.redact_password(F.lit(None).cast("string"))) is None


def test_keys_and_strict_casts(spark):
    for text, key in [("12", 12), ("12.0", 12), ("1.5", None), ("P01", None), (None, None), (" 8 ", 8), ("1e3", 1000), ("-4", -4), (".", None), ("", None), ("9007199254740993", 9007199254740993), ("12345678901234567.0", 12345678901234567), ("12345678901234568.00", 12345678901234568), ("99999999999999999999", None), ("1.", 1), ("+7", 7), (".0", None)]:
        assert one(spark, exprs.to_key(F.lit(text).cast("string"))) == key
    assert one(spark, exprs.strict_cast(F.lit("2023-01-10"), "date", "d")) == dt.date(2023, 1, 10)
    assert one(spark, exprs.strict_cast(F.lit(None).cast("string"), "date", "d")) is None
    with pytest.raises(Exception, match="column 'd'"):
        one(spark, exprs.strict_cast(F.lit("soon"), "date", "d"))


def test_senior_junior(spark):
    people = spark.createDataFrame([(28,), (40,), (None,)], "age int")
    out = people.select(exprs.either(F.col("age") >= 40, "Senior", "Junior").alias("g")).collect()
    assert [r["g"] for r in out] == ["Junior", "Senior", "Junior"]


def test_band_labels_are_ordered():
    assert sorted(AGE_LABELS) == AGE_LABELS
