"""DuckDB SQL of ``refresh_queries``."""

from __future__ import annotations

from claimloom.oracles import _with

_IDS = "SELECT CASE WHEN l_linenumber <> 6 THEN CAST(l_orderkey AS BIGINT) END AS claim_id, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem"

_COUNTED = "count(DISTINCT claim_id) AS distinct_ids, count(claim_id) AS rows, count(claim_id) - count(DISTINCT claim_id) AS surplus"

_ORPHANS = """
    SELECT CASE WHEN provider_id % 50 <> 0 THEN 'M' || member_id END AS member_id
    FROM claim"""

_MONEY = ("billed_amount", "allowed_amount", "paid_amount")


def _stats(table: str, source: str, columns: list[str]) -> list[str]:
    out = []
    for c in columns:
        total = f"CAST(sum({c}) AS DOUBLE)" if c in _MONEY else "CAST(NULL AS DOUBLE)"
        out.append(f"SELECT '{table}' AS table_name, count(*) AS rows, '{c}' AS column_name, count(*) - count({c}) AS nulls, {total} AS total FROM {source}")
    return out


_MEMBER = ["member_id", "person_id", "dob", "gender", "region"]
_PROVIDER = ["provider_id", "specialty", "in_network", "region"]
_CLAIM = ["member_id", "provider_id", "service_date", *_MONEY]

_REPORT_KEYS = {
    "kpis": ["age_band", "member_region", "in_network"],
    "monthly": ["month", "member_region", "in_network"],
    "loss_ratio": ["member_region", "in_network"],
    "network_summary": ["in_network"],
    "diagnosis_summary": ["diagnosis_code"],
}
_KINDS = {"age_band": "VARCHAR", "member_region": "VARCHAR", "in_network": "BOOLEAN", "month": "DATE", "diagnosis_code": "VARCHAR"}


def _report(name: str) -> str:
    keys = [k if k in _REPORT_KEYS[name] else f"CAST(NULL AS {kind}) AS {k}" for k, kind in _KINDS.items()]
    return f"SELECT '{name}' AS report, {', '.join(keys)}, claims, paid_total FROM {name}"


def _named(phase: str) -> list[str]:
    return [
        f"SELECT 'member' AS table_name, 5 AS columns, count(*) AS rows, '{phase}' AS phase FROM member WHERE region IS NOT NULL",
        f"SELECT 'provider', 4, count(*), '{phase}' FROM supplier",
        f"SELECT 'claim', 2, count(*), '{phase}' FROM lineitem",
    ]


ORACLES: dict[str, str] = {
    "id_surplus": f"WITH ids AS ({_IDS}) SELECT year, {_COUNTED} FROM ids GROUP BY year UNION ALL SELECT NULL, {_COUNTED} FROM ids",
    "repeated_claim_ids": f"WITH ids AS ({_IDS}) SELECT claim_id, count(*) AS rows FROM ids WHERE claim_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "gate_duplicates": f"WITH ids AS ({_IDS}) SELECT count(*) - count(DISTINCT claim_id) AS surplus FROM ids",
    "filtered_orphans": _with(
        ["claim"],
        f"""
        , fact AS ({_ORPHANS}), listed AS (SELECT 'M' || c_custkey AS member_id FROM customer WHERE c_acctbal >= 0)
        SELECT p AS error_percent, member_id, count(*) AS rows
        FROM fact ANTI JOIN listed USING (member_id), (VALUES (30), (5), (1)) v(p) GROUP BY ALL""",
    ),
    "numeric_orphans": _with(
        ["claim"],
        """
        SELECT member_id, count(*) AS rows FROM claim
        ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON member_id = c_custkey GROUP BY 1""",
    ),
    "observed_writes": _with(
        ["claim", "member", "provider"],
        """
        , faulty AS (SELECT * REPLACE (CASE WHEN provider_id % 10 <> 3 THEN provider_id END AS provider_id) FROM claim)
        """
        + " UNION ALL ".join(
            [
                *_stats("member", "member", _MEMBER), *_stats("provider", "provider", _PROVIDER), *_stats("claim", "faulty", _CLAIM),
                *_stats("no_claim", "(SELECT * FROM claim WHERE member_id < 0)", _CLAIM),
            ]
        ),
    ),
    "client_refresh": _with(
        ["claim"],
        """
        , lines AS (
            SELECT l_linestatus, l_quantity, CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                * (1 - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS paid FROM lineitem),
        phases AS (
            SELECT 'before' AS phase, *, CAST(NULL AS BOOLEAN) AS same_files FROM lines
            UNION ALL SELECT 'after', *, l_linestatus = 'F' FROM lines WHERE l_linestatus = 'F' OR l_quantity >= 20)
        SELECT CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'finished' END AS client_id, count(*) AS claims,
            CAST(sum(paid) AS DOUBLE) AS paid_total, same_files, phase
        FROM phases WHERE l_linestatus IN ('O', 'F') GROUP BY ALL""",
    ),
    "quarter_stored": _with(
        ["claim"],
        """
        , kept AS (SELECT *, CAST(year(service_date) AS INTEGER) AS y, CAST(month(service_date) AS INTEGER) AS m FROM claim
            WHERE year(service_date) = 1996 AND quarter(service_date) = 3)
        SELECT y AS year, m AS month_num, count(claim_id) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
            CAST(sum(billed_amount) AS DOUBLE) AS total_billed
        FROM kept GROUP BY GROUPING SETS ((y, m), (y))""",
    ),
    "catalog_tables": _with(
        ["member"],
        " UNION ALL ".join([*_named("refreshed"), *_named("failed refresh"), "SELECT 'provider', NULL, least(count(*), 10), 'preview' FROM supplier"]),
    ),
    "quarantined_feed": _with(
        ["claim"],
        """
        , lines AS (
            SELECT CASE WHEN l_linenumber = 7 THEN 'short' WHEN l_linenumber = 6 THEN 'long'
                WHEN l_linenumber = 5 AND l_partkey % 2 = 0 THEN 'quote' ELSE 'good' END AS kind,
                CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    * (1 - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS paid
            FROM lineitem)
        SELECT kind, count(*) AS lines, CASE WHEN kind = 'good' THEN CAST(sum(paid) AS DOUBLE) END AS paid_total,
            CASE WHEN kind = 'good' THEN count(*) END AS last_claim
        FROM lines GROUP BY kind""",
    ),
    "reports_at_once": _with(list(_REPORT_KEYS), " UNION ALL ".join(map(_report, _REPORT_KEYS))),
    "ordered_report": _with(
        ["claim"],
        """
        , totals AS (
            SELECT provider_id, CAST(date_trunc('month', service_date) AS DATE) AS month, CAST(sum(paid_amount) AS DOUBLE) AS paid_total
            FROM claim GROUP BY ALL)
        SELECT row_number() OVER (ORDER BY paid_total DESC, provider_id, month) - 1 AS place, * FROM totals""",
    ),
    "observed_gate": _with(
        ["claim", "member", "provider"],
        """
        , v AS (
            SELECT (SELECT count(*) FROM member) AS dim_member_count, (SELECT count(*) FROM provider) AS dim_provider_count,
                (SELECT CAST(date_diff('day', min(service_date), CAST(max(service_date) + INTERVAL 12 MONTH AS DATE)) + 1 AS BIGINT) FROM claim) AS dim_date_count,
                (SELECT count(*) FROM claim) AS fact_claims_count,
                (SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem) AS fact_claims_dup_claim_id,
                (SELECT count(*) FROM claim ANTI JOIN member USING (member_id)) AS missing_member_refs,
                (SELECT count(*) FROM claim ANTI JOIN provider USING (provider_id)) AS missing_provider_refs,
                CAST(0 AS BIGINT) AS missing_date_refs, CAST(0 AS BIGINT) AS null_member_pk, CAST(0 AS BIGINT) AS null_provider_pk,
                CAST(0 AS BIGINT) AS null_date_pk),
        w AS (
            SELECT *, concat_ws('; ',
                CASE WHEN fact_claims_dup_claim_id > 0 THEN 'duplicate claim_id in fact_claims' END,
                CASE WHEN missing_member_refs > 0 THEN 'fact_claims contains member_id values not present in dim_member' END,
                CASE WHEN missing_provider_refs > 0 THEN 'fact_claims contains provider_id values not present in dim_provider' END) AS failures
            FROM v)
        SELECT *, CASE WHEN failures = '' THEN 'ok' ELSE 'failed' END AS status FROM w""",
    ),
}
