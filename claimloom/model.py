"""Table schemas, canonical defaults, width limits and report contracts."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(12, 2)


def _schema(*fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


MEMBER = _schema(
    ("member_id", LongType()),
    ("person_id", LongType()),
    ("dob", DateType()),
    ("gender", StringType()),
    ("region", StringType()),
    ("effective_date", DateType()),
    ("termination_date", DateType()),
)

PROVIDER = _schema(
    ("provider_id", LongType()),
    ("specialty", StringType()),
    ("in_network", BooleanType()),
    ("region", StringType()),
)

CLAIM = _schema(
    ("claim_id", LongType()),
    ("member_id", LongType()),
    ("provider_id", LongType()),
    ("service_date", DateType()),
    ("diagnosis_code", StringType()),
    ("procedure_code", StringType()),
    ("billed_amount", MONEY),
    ("allowed_amount", MONEY),
    ("paid_amount", MONEY),
    ("place_of_service", StringType()),
)

# role in a feed config -> operational table
ROLE_TABLE = {"members": ("member", MEMBER), "providers": ("provider", PROVIDER), "claims": ("claim", CLAIM)}

# --- Fixed values: defaults for columns a feed does not carry ---------------
ROLE_DEFAULTS: dict[str, dict] = {
    "members": {
        "person_id": None,
        "gender": "U",
        "region": "Unknown",
        "effective_date": "2023-01-01",
        "termination_date": None,
    },
    "providers": {"specialty": "Unknown", "in_network": True, "region": "Unknown"},
    "claims": {
        "billed_amount": 0.0,
        "allowed_amount": 0.0,
        "place_of_service": "Office",
        "procedure_code": "99213",
        "service_date": "2023-01-01",
        "diagnosis_code": "Z00",
    },
}

# --- Fixed values: column widths --------------------------------------------
# Codes are never cut: a longer value is an error. Descriptions are cut.
CODE_WIDTHS = {"diagnosis_code": 8, "procedure_code": 8}
TEXT_WIDTHS = {"place_of_service": 20, "gender": 10, "region": 50, "specialty": 80}

# --- Fixed values: age bands, right-closed bins -----------------------------
AGE_EDGES = [0, 18, 30, 45, 60, 200]
AGE_LABELS = ["0-18", "19-30", "31-45", "46-60", "60+"]

# --- Fixed values: CSV texts read as missing (pandas' documented list) ------
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# --- Fixed values: report columns and the sheet each report is exported to --
REPORT_COLUMNS = {
    "kpis": ["age_band", "member_region", "in_network", "claims", "paid_total", "paid_avg"],
    "monthly": ["month", "member_region", "in_network", "claims", "paid_total"],
    "loss_ratio": [
        "member_region",
        "in_network",
        "claims",
        "billed_total",
        "allowed_total",
        "paid_total",
        "loss_ratio_pct",
        "allowed_ratio_pct",
    ],
    "network_summary": ["in_network", "claims", "paid_total", "paid_avg", "utilization_pct"],
    "diagnosis_summary": ["diagnosis_code", "claims", "paid_total", "paid_avg", "billed_total"],
}
REPORT_TITLES = {
    "kpis": "KPIs",
    "monthly": "Monthly",
    "loss_ratio": "Loss ratio",
    "network_summary": "Network utilization",
    "diagnosis_summary": "Diagnosis summary",
}
SHEETS = {
    "kpis": "KPIs",
    "monthly": "Monthly",
    "loss_ratio": "LossRatio",
    "network_summary": "NetworkUtilization",
    "diagnosis_summary": "DiagnosisSummary",
}
METRICS_SHEET = "Model_Metrics"
EMPTY_SHEET = "Summary"
SUMMARY_TABLES = {
    "summary_kpis": "kpis",
    "summary_monthly": "monthly",
    "summary_loss_ratio": "loss_ratio",
    "summary_network": "network_summary",
}
