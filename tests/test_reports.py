"""The five reports on the six-claim fixture, edge rows, and roll-up invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.plans import export, marts, reports
from claimloom.sources.sample_tables import AS_OF as SAMPLE_AS_OF
from claimloom.sources.sample_tables import SampleTables

AS_OF = dt.date(2024, 1, 1)
SMALL = "/root/testdata/sf0.001"

CLAIMS = [
    (1, 1, 10, "2023-01-15", 150, 130, 100, "I10"),
    (2, 1, 10, "2023-02-20", 250, 220, 200, "E11"),
    (3, 2, 20, "2023-01-10", 300, 270, 250, "I10"),
    (4, 2, 20, "2023-03-05", 400, 360, 300, "M54"),
    (5, 3, 10, "2023-02-14", 120, 100, 80, "E11"),
    (6, 3, 20, "2023-03-22", 180, 160, 140, "I10"),
]
CLAIM_TYPE = (
    "claim_id bigint, member_id bigint, provider_id bigint, service_date date, billed_amount decimal(12,2), "
    "allowed_amount decimal(12,2), paid_amount decimal(12,2), diagnosis_code string"
)


def claim_frame(spark, rows):
    def money(v):
        return None if v is None else Decimal(v)

    typed = [
        (c, m, p, d and dt.date.fromisoformat(d), money(b), money(a), money(x), code)
        for c, m, p, d, b, a, x, code in rows
    ]
    return spark.createDataFrame(typed, CLAIM_TYPE)


def member_frame(spark, rows):
    return spark.createDataFrame([(m, d and dt.date.fromisoformat(d), r) for m, d, r in rows], "member_id bigint, dob date, region string")


def provider_frame(spark, rows):
    return spark.createDataFrame(rows, "provider_id bigint, in_network boolean")


@pytest.fixture(scope="module")
def measures(spark):
    members = member_frame(spark, [(1, "1980-06-15", "East"), (2, "1960-03-22", "West"), (3, "1990-09-01", "North")])
    providers = provider_frame(spark, [(10, True), (20, False)])
    joined = reports.joined_claims(claim_frame(spark, CLAIMS), members, providers, AS_OF)
    return reports.claim_measures(joined).cache()


@pytest.fixture(params=["claims", "cube"])
def grain(request, measures):
    """Every report must be the same from claim rows and from the cube."""
    return measures if request.param == "claims" else reports.claim_cube(measures)


def test_kpis(grain, rows):
    assert rows(reports.kpis(grain)) == [
        ("31-45", "East", True, 2, 300.0, 150.0),
        ("31-45", "North", False, 1, 140.0, 140.0),
        ("31-45", "North", True, 1, 80.0, 80.0),
        ("60+", "West", False, 2, 550.0, 275.0),
    ]


def test_monthly(grain, rows):
    day = dt.date
    assert rows(reports.monthly(grain)) == [
        (day(2023, 1, 1), "East", True, 1, 100.0),
        (day(2023, 1, 1), "West", False, 1, 250.0),
        (day(2023, 2, 1), "East", True, 1, 200.0),
        (day(2023, 2, 1), "North", True, 1, 80.0),
        (day(2023, 3, 1), "North", False, 1, 140.0),
        (day(2023, 3, 1), "West", False, 1, 300.0),
    ]


def test_loss_ratio(grain, rows):
    assert rows(reports.loss_ratio(grain)) == [
        ("East", True, 2, 400.0, 350.0, 300.0, 75.0, 87.5),
        ("North", False, 1, 180.0, 160.0, 140.0, 77.78, 88.89),
        ("North", True, 1, 120.0, 100.0, 80.0, 66.67, 83.33),
        ("West", False, 2, 700.0, 630.0, 550.0, 78.57, 90.0),
    ]


def test_network_summary(grain, rows):
    assert rows(reports.network_summary(grain)) == [(False, 3, 690.0, 230.0, 50.0), (True, 3, 380.0, 126.6667, 50.0)]


def test_diagnosis_summary(grain):
    got = [(r[0], r[1], r[2], round(r[3], 4), r[4]) for r in reports.diagnosis_summary(grain).collect()]
    assert got == [("I10", 3, 490.0, 163.3333, 630.0), ("M54", 1, 300.0, 300.0, 400.0), ("E11", 2, 280.0, 140.0, 370.0)]


@pytest.fixture(scope="module")
def edge_measures(spark):
    """Null keys, null amounts, zero billed, unmatched keys, null claim ids and dates."""
    members = member_frame(spark, [(1, None, None), (2, "2023-12-31", "East"), (3, "1990-09-01", "East")])
    providers = provider_frame(spark, [(10, None), (20, True)])
    claims = [
        (1, 1, 10, "2023-01-15", 100, 50, None, None),
        (2, 1, 10, None, 100, 50, None, None),
        (3, 2, 20, "2023-01-15", 0, 0, 10, "A"),
        (None, 2, 20, "2023-01-15", 0, 0, 20, "A"),
        (5, 3, 20, None, None, None, 30, "B"),
        (6, 9, 20, "2023-01-15", 1, 1, 1, "B"),
        (7, 3, 99, "2023-01-15", 1, 1, 1, "B"),
        (8, None, 20, "2023-01-15", 1, 1, 1, "B"),
    ]
    joined = reports.joined_claims(claim_frame(spark, claims), members, providers, AS_OF)
    return reports.claim_measures(joined).cache()


def test_null_groups_are_kept_and_empty_sums_are_zero(edge_measures, rows):
    assert rows(reports.kpis(edge_measures)) == [
        ("31-45", "East", True, 1, 30.0, 30.0),
        (None, "East", True, 1, 30.0, 15.0),
        (None, None, None, 2, 0.0, None),
    ]
    assert rows(reports.loss_ratio(edge_measures)) == [
        ("East", True, 2, 0.0, 0.0, 60.0, None, None),
        (None, None, 2, 200.0, 100.0, 0.0, 0.0, 50.0),
    ]
    assert rows(reports.diagnosis_summary(edge_measures)) == [
        ("A", 1, 30.0, 15.0, 0.0),
        ("B", 1, 30.0, 30.0, 0.0),
        (None, 2, 0.0, None, 200.0),
    ]


def test_monthly_drops_null_keys(edge_measures, rows):
    assert rows(reports.monthly(edge_measures)) == [(dt.date(2023, 1, 1), "East", True, 1, 30.0)]


def test_invariants_on_sample_tables(spark):
    t = SampleTables(spark, SMALL)
    cube = reports.claim_cube(
        reports.claim_measures(reports.joined_claims(t.claims(), t.members(), t.providers(), SAMPLE_AS_OF))
    ).cache()
    out = reports.all_reports(cube)
    total = t.table("lineitem").count()
    for name in ("kpis", "loss_ratio", "network_summary", "diagnosis_summary"):
        assert out[name].agg(F.sum("claims")).first()[0] == total, name
    assert out["loss_ratio"].filter("paid_total > billed_total or loss_ratio_pct not between 0 and 100").count() == 0
    assert out["kpis"].filter("abs(paid_avg - paid_total / claims) > 1e-6").count() == 0
    assert abs(out["network_summary"].agg(F.sum("utilization_pct")).first()[0] - 100) < 0.1
    codes = {r[0] for r in t.table("part").select("p_brand").distinct().collect()}
    assert {r[0] for r in out["diagnosis_summary"].select("diagnosis_code").collect()} <= codes
    single = reports.kpis(reports.claim_measures(reports.joined_claims(t.claims(), t.members(), t.providers(), SAMPLE_AS_OF)))
    assert single.exceptAll(out["kpis"]).count() == 0


def test_marts(spark, rows):
    kpis = spark.createDataFrame(
        [("19-30", "EAST", True, 40, 20000.0), ("31-45", "EAST", False, 47, 23500.0), ("31-45", None, True, 1, 9.0)]
        + [("60+", f"R{i:02d}", True, 1, 100.0) for i in range(12)],
        "age_band string, member_region string, in_network boolean, claims bigint, paid_total double",
    )
    card = marts.kpi_cards(kpis).first()
    assert (card["total_paid"], card["total_claims"]) == (44709.0, 100)
    assert (card["total_paid_text"], card["total_claims_text"], card["paid_avg_text"]) == ("$44,709", "100", "$447.09")
    top = [r["member_region"] for r in marts.top_regions(marts.region_totals(kpis)).collect()]
    assert top == ["EAST"] + [f"R{i:02d}" for i in range(9)]
    paid = rows(marts.region_network_paid(kpis))
    assert paid[:2] == [("In-Network", "EAST", 20000.0), ("In-Network", "R00", 100.0)]
    assert ("Out-of-Network", "EAST", 23500.0) in paid and len(paid) == 11

    monthly = spark.createDataFrame(
        [
            (dt.date(2023, 1, 1), "EAST", True, 30, 15000.0),
            (dt.date(2023, 1, 1), "EAST", False, 10, 5000.0),
            (dt.date(2023, 2, 1), "EAST", True, 47, 23500.0),
            (dt.date(2023, 2, 1), None, True, 1, 1.0),
        ],
        "month date, member_region string, in_network boolean, claims bigint, paid_total double",
    )
    series = [tuple(r) for r in marts.monthly_region(monthly).select("month", "paid_total", "claims").collect()]
    assert series == [(dt.date(2023, 1, 1), 20000.0, 40), (dt.date(2023, 2, 1), 23500.0, 47)]

    loss = spark.createDataFrame(
        [("EAST", True, 1, 100.0, 90.0, 80.0), ("EAST", False, 1, 100.0, 90.0, 70.0), (None, True, 1, 0.0, 0.0, 5.0)],
        "member_region string, in_network boolean, claims bigint, billed_total double, allowed_total double, paid_total double",
    )
    collapsed = marts.region_loss_ratio(loss)
    assert rows(collapsed) == [("EAST", 2, 200.0, 180.0, 150.0, 75.0), (None, 1, 0.0, 0.0, 5.0, None)]
    assert marts.chart_flags(collapsed).first() == (True, True, True)
    assert marts.chart_flags(collapsed.filter("member_region is null")).first() == (False, False, False)
    assert marts.chart_flags(collapsed.filter("false")).first() == (False, False, False)


def test_empty_kpi_cards(spark):
    empty = spark.createDataFrame([], "age_band string, member_region string, in_network boolean, claims bigint, paid_total double")
    card = marts.kpi_cards(empty).first()
    assert (card["total_paid"], card["total_claims"], card["paid_avg"]) == (0.0, 0, 0.0)


def test_export_order(measures):
    ordered = reports.in_report_order("kpis", reports.kpis(measures)).collect()
    assert [tuple(r[:3]) for r in ordered] == [
        ("31-45", "East", True),
        ("31-45", "North", False),
        ("31-45", "North", True),
        ("60+", "West", False),
    ]


def test_report_files_and_sheets(spark, measures, tmp_path):
    folder, target = str(tmp_path / "reports"), str(tmp_path / "sheets")
    assert export.export_reports(spark, folder, target) == ["Summary"]
    export.write_reports(reports.all_reports(measures), folder)
    spark.range(1).select(F.lit("LogisticRegression accuracy: 0.8200")).write.text(f"{folder}/model_metrics.txt")
    names = export.export_reports(spark, folder, target)
    assert names == ["KPIs", "Monthly", "LossRatio", "NetworkUtilization", "DiagnosisSummary", "Model_Metrics"]
    assert export.read_reports(spark, folder)["kpis"].count() == 4
    assert [r["metric"] for r in spark.read.option("header", True).csv(f"{target}/Model_Metrics").collect()] == [
        "LogisticRegression accuracy: 0.8200"
    ]


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_report_contracts(spark, name):
    from claimloom.model import REPORT_COLUMNS
    from claimloom.operators.validate import require_report_columns

    columns = REPORT_COLUMNS[name]
    good = spark.createDataFrame([], ", ".join(f"{c} string" for c in [*columns, "extra"]))
    require_report_columns(name, good)
    with pytest.raises(ValueError, match="report lacks columns"):
        require_report_columns(name, good.drop(columns[0]))


def test_append_column_csv(spark, tmp_path, rows):
    source, target = tmp_path / "in.csv", str(tmp_path / "out")
    source.write_text("name,age\nAlice,25\n\"O\"\"Hara, Bob\",30\n")
    export.append_column_csv(spark, str(source), target, "greeting", F.concat(F.lit("Hello, "), "name", F.lit("!")))
    assert rows(spark.read.option("header", True).option("escape", '"').csv(target)) == [
        ("Alice", "25", "Hello, Alice!"),
        ('O"Hara, Bob', "30", 'Hello, O"Hara, Bob!'),
    ]
