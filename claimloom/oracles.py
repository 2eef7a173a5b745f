"""The same results as plain SQL for DuckDB over the same tables."""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"

_CTES = {
    "member": """
        SELECT c_custkey AS member_id, c_custkey AS person_id,
               CASE WHEN c_custkey % 50 <> 0
                    THEN DATE '1930-01-01' + CAST(c_custkey * 7919 % 27000 AS INTEGER) END AS dob,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_custkey % 97 <> 0 THEN r_name END AS region
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_member": f"""
        SELECT member_id, dob, gender, region,
               CASE WHEN age > 0 AND age <= 18 THEN '0-18' WHEN age > 18 AND age <= 30 THEN '19-30'
                    WHEN age > 30 AND age <= 45 THEN '31-45' WHEN age > 45 AND age <= 60 THEN '46-60'
                    WHEN age > 60 AND age <= 200 THEN '60+' END AS age_band, age
        FROM (SELECT *, CAST(floor(({AS_OF} - dob) / 365.0) AS BIGINT) AS age FROM member)""",
    "provider": """
        SELECT s_suppkey AS provider_id, n_name AS specialty,
               CASE WHEN s_suppkey % 25 <> 24 THEN s_suppkey % 10 < 7 END AS in_network, r_name AS region
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "claim": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS claim_id,
               o_custkey AS member_id, l_suppkey AS provider_id, CAST(l_shipdate AS DATE) AS service_date,
               p_brand AS diagnosis_code, p_type AS procedure_code,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS billed_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(12,2)) AS allowed_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    * (1 - CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS paid_amount,
               o_orderpriority AS place_of_service
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "joined": """
        SELECT c.*, m.age_band, m.region AS member_region, m.dob, m.age, p.in_network
        FROM claim c JOIN dim_member m ON c.member_id = m.member_id
        JOIN provider p ON c.provider_id = p.provider_id""",
    "kpis": """
        SELECT age_band, member_region, in_network, count(claim_id) AS claims,
               coalesce(CAST(sum(paid_amount) AS DOUBLE), 0) AS paid_total,
               CAST(sum(paid_amount) AS DOUBLE) / count(paid_amount) AS paid_avg
        FROM joined GROUP BY ALL""",
    "monthly": """
        SELECT CAST(date_trunc('month', service_date) AS DATE) AS month, member_region, in_network,
               count(claim_id) AS claims, coalesce(CAST(sum(paid_amount) AS DOUBLE), 0) AS paid_total
        FROM joined
        WHERE service_date IS NOT NULL AND member_region IS NOT NULL AND in_network IS NOT NULL
        GROUP BY ALL""",
    "loss_totals": """
        SELECT member_region, in_network, count(claim_id) AS claims,
               CAST(sum(billed_amount) AS DOUBLE) AS billed_total,
               CAST(sum(allowed_amount) AS DOUBLE) AS allowed_total,
               CAST(sum(paid_amount) AS DOUBLE) AS paid_total
        FROM joined GROUP BY ALL""",
    "loss_ratio": """
        SELECT *, CASE WHEN billed_total > 0 THEN round_even(paid_total / billed_total * 100, 2) END AS loss_ratio_pct,
               CASE WHEN billed_total > 0 THEN round_even(allowed_total / billed_total * 100, 2) END AS allowed_ratio_pct
        FROM loss_totals""",
    "network_summary": """
        SELECT *, round_even(CAST(claims AS DOUBLE) / sum(claims) OVER () * 100, 2) AS utilization_pct
        FROM (SELECT in_network, count(claim_id) AS claims,
                     coalesce(CAST(sum(paid_amount) AS DOUBLE), 0) AS paid_total,
                     CAST(sum(paid_amount) AS DOUBLE) / count(paid_amount) AS paid_avg
              FROM joined GROUP BY ALL)""",
    "diagnosis_summary": """
        SELECT diagnosis_code, count(claim_id) AS claims,
               coalesce(CAST(sum(paid_amount) AS DOUBLE), 0) AS paid_total,
               CAST(sum(paid_amount) AS DOUBLE) / count(paid_amount) AS paid_avg,
               coalesce(CAST(sum(billed_amount) AS DOUBLE), 0) AS billed_total
        FROM joined GROUP BY ALL""",
    "calendar": f"""
        SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_num,
               monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_of_week
        FROM generate_series(DATE '1995-01-01', {AS_OF} + INTERVAL 1 YEAR, INTERVAL 1 DAY) AS s(d)""",
    "region_loss": """
        SELECT *, CASE WHEN billed_total > 0 THEN round_even(paid_total / billed_total * 100, 2) END AS loss_ratio_pct
        FROM (SELECT member_region, CAST(sum(claims) AS BIGINT) AS claims,
                     CAST(sum(CAST(billed_total AS DECIMAL(28,2))) AS DOUBLE) AS billed_total,
                     CAST(sum(CAST(allowed_total AS DECIMAL(28,2))) AS DOUBLE) AS allowed_total,
                     CAST(sum(CAST(paid_total AS DECIMAL(28,2))) AS DOUBLE) AS paid_total
              FROM loss_totals GROUP BY member_region)
        ORDER BY paid_total DESC, member_region NULLS LAST LIMIT 10""",
    "region_top": """
        SELECT member_region, CAST(sum(claims) AS BIGINT) AS claims,
               CAST(sum(CAST(paid_total AS DECIMAL(28,2))) AS DOUBLE) AS paid_total
        FROM kpis WHERE member_region IS NOT NULL GROUP BY ALL
        ORDER BY paid_total DESC, member_region LIMIT 10""",
}

_CTES["feed"] = (
    _CTES["claim"].replace(
        "SELECT concat_ws",
        "SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord,\n"
        "               l_linestatus, l_quantity, concat_ws",
        1,
    )
)
_CTES["first_claim"] = "SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY ord) = 1"
_CTES["cost"] = """
        SELECT member_id, dob, member_region, in_network, sum(paid_amount) AS paid_total
        FROM joined GROUP BY ALL"""
_CTES["threshold"] = "SELECT quantile_cont(CAST(paid_total AS DOUBLE), 0.9) AS t FROM cost"

_NEEDS = {
    "first_claim": ["feed"],
    "cost": ["joined"],
    "threshold": ["cost"],
    "dim_member": ["member"],
    "joined": ["claim", "dim_member", "provider"],
    "kpis": ["joined"],
    "monthly": ["joined"],
    "loss_totals": ["joined"],
    "loss_ratio": ["loss_totals"],
    "network_summary": ["joined"],
    "diagnosis_summary": ["joined"],
    "region_loss": ["loss_totals"],
    "region_top": ["kpis"],
}


def _with(names: list[str], body: str) -> str:
    """``body`` preceded by the named CTEs and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS ({_CTES[n]})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


ORACLES: dict[str, str] = {
    "kpis": _with(["kpis"], "SELECT * FROM kpis"),
    "monthly": _with(["monthly"], "SELECT * FROM monthly"),
    "loss_ratio": _with(["loss_ratio"], "SELECT * FROM loss_ratio"),
    "loss_ratio_zero_billed": _with(
        ["joined"],
        """
        SELECT member_region, in_network, count(claim_id) AS claims, CAST(0 AS DOUBLE) AS billed_total,
               CAST(0 AS DOUBLE) AS allowed_total, CAST(sum(paid_amount) AS DOUBLE) AS paid_total,
               CAST(NULL AS DOUBLE) AS loss_ratio_pct, CAST(NULL AS DOUBLE) AS allowed_ratio_pct
        FROM joined GROUP BY ALL""",
    ),
    "network_summary": _with(["network_summary"], "SELECT * FROM network_summary"),
    "diagnosis_summary": _with(
        ["diagnosis_summary"],
        "SELECT * FROM diagnosis_summary ORDER BY paid_total DESC, diagnosis_code NULLS LAST",
    ),
    "dim_member": _with(["dim_member"], "SELECT member_id, dob, gender, region, age_band FROM dim_member"),
    "dim_provider": _with(["provider"], "SELECT * FROM provider"),
    "dim_date": """
        SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_num,
               monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_of_week
        FROM (SELECT unnest(generate_series(min(CAST(l_shipdate AS DATE)),
                     max(CAST(l_shipdate AS DATE)) + INTERVAL 12 MONTH, INTERVAL 1 DAY)) AS d FROM lineitem)""",
    "service_days": """
        SELECT DISTINCT CAST(l_shipdate AS DATE) AS date_key, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month_num, monthname(l_shipdate) AS month_name,
               CAST(quarter(l_shipdate) AS INTEGER) AS quarter, dayname(l_shipdate) AS day_of_week
        FROM lineitem""",
    "fact_claims": _with(
        ["claim"],
        """
        SELECT claim_id, member_id, provider_id, service_date AS date_key,
               CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(allowed_amount AS DOUBLE) AS allowed_amount,
               CAST(paid_amount AS DOUBLE) AS paid_amount, diagnosis_code, procedure_code, place_of_service
        FROM claim""",
    ),
    "quality_checks": _with(
        ["claim", "member", "provider", "calendar"],
        """
        , v AS (
          SELECT (SELECT count(*) FROM member) AS dim_member_count,
                 (SELECT count(*) FROM provider) AS dim_provider_count,
                 (SELECT count(*) FROM calendar) AS dim_date_count,
                 (SELECT count(*) FROM claim) AS fact_claims_count,
                 (SELECT count(*) - count(DISTINCT claim_id) FROM claim) AS fact_claims_dup_claim_id,
                 (SELECT count(*) FROM claim ANTI JOIN member USING (member_id)) AS missing_member_refs,
                 (SELECT count(*) FROM claim ANTI JOIN provider USING (provider_id)) AS missing_provider_refs,
                 (SELECT count(*) FROM claim ANTI JOIN calendar ON service_date = date_key) AS missing_date_refs,
                 (SELECT count(*) FROM member WHERE member_id IS NULL) AS null_member_pk,
                 (SELECT count(*) FROM provider WHERE provider_id IS NULL) AS null_provider_pk,
                 (SELECT count(*) FROM calendar WHERE date_key IS NULL) AS null_date_pk),
        w AS (
          SELECT *, concat_ws('; ',
            CASE WHEN dim_member_count = 0 THEN 'dim_member is empty' END,
            CASE WHEN dim_date_count = 0 THEN 'dim_date is empty' END,
            CASE WHEN fact_claims_count = 0 THEN 'fact_claims is empty' END,
            CASE WHEN fact_claims_dup_claim_id > 0 THEN 'duplicate claim_id in fact_claims' END,
            CASE WHEN null_member_pk > 0 OR null_provider_pk > 0 THEN 'NULL primary keys found in dimensions' END,
            CASE WHEN null_date_pk > 0 THEN 'NULL primary keys found in dim_date' END,
            CASE WHEN missing_member_refs > 0
                 THEN 'fact_claims contains member_id values not present in dim_member' END,
            CASE WHEN missing_provider_refs > 0
                 THEN 'fact_claims contains provider_id values not present in dim_provider' END,
            CASE WHEN missing_date_refs > 0
                 THEN 'fact_claims contains date_key values not present in dim_date' END) AS failures FROM v)
        SELECT *, CASE WHEN failures = '' THEN 'ok' ELSE 'failed' END AS status FROM w""",
    ),
    "missing_refs": _with(
        ["claim", "calendar"],
        """
        SELECT 'missing_member_refs' AS name, count(*) AS value FROM claim
          ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON member_id = c_custkey
        UNION ALL SELECT 'missing_provider_refs', count(*) FROM claim
          ANTI JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON provider_id = s_suppkey
        UNION ALL SELECT 'missing_date_refs', count(*) FROM claim
          ANTI JOIN (SELECT date_key FROM calendar WHERE year < 2001) ON service_date = date_key""",
    ),
    "duplicate_claims": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS claim_no, count(*) AS rows
        FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "q1_age_region": _with(
        ["claim", "dim_member"],
        """
        SELECT m.age_band, m.region, count(c.claim_id) AS claims, CAST(sum(c.paid_amount) AS DOUBLE) AS total_paid,
               CAST(sum(c.paid_amount) AS DOUBLE) / count(c.paid_amount) AS avg_paid
        FROM claim c JOIN dim_member m USING (member_id) GROUP BY ALL ORDER BY total_paid DESC""",
    ),
    "q2_month_trend": _with(
        ["claim", "calendar"],
        """
        SELECT year, month_num, month_name, count(claim_id) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS total_paid
        FROM claim JOIN calendar ON service_date = date_key GROUP BY ALL ORDER BY year, month_num""",
    ),
    "q3_loss_rank": _with(
        ["loss_ratio"],
        """
        SELECT member_region, in_network, loss_ratio_pct, allowed_ratio_pct, claims
        FROM loss_ratio ORDER BY loss_ratio_pct DESC""",
    ),
    "q4_network_share": _with(
        ["claim", "provider"],
        """
        SELECT in_network, count(claim_id) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
               CAST(round(100.0 * count(claim_id) / sum(count(claim_id)) OVER (), 2) AS DOUBLE) AS pct_of_claims
        FROM claim JOIN provider USING (provider_id) GROUP BY in_network ORDER BY in_network DESC""",
    ),
    "q5_top_diagnosis": _with(
        ["claim"],
        """
        SELECT diagnosis_code, count(*) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
               CAST(sum(paid_amount) AS DOUBLE) / count(paid_amount) AS avg_paid
        FROM claim GROUP BY diagnosis_code ORDER BY total_paid DESC, diagnosis_code LIMIT 10""",
    ),
    "q6_quarter": _with(
        ["claim", "calendar"],
        """
        SELECT year, quarter, count(claim_id) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
               CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
               CAST(round(100.0 * sum(paid_amount) / nullif(sum(billed_amount), 0), 2) AS DOUBLE) AS loss_ratio_pct
        FROM claim JOIN calendar ON service_date = date_key GROUP BY ALL ORDER BY year, quarter""",
    ),
    "top20_diagnosis": _with(
        ["claim"],
        """
        SELECT diagnosis_code, count(*) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS paid_total
        FROM claim GROUP BY 1 ORDER BY paid_total DESC, diagnosis_code LIMIT 20""",
    ),
    "kpi_cards": _with(
        ["kpis"],
        """
        SELECT total_paid, total_claims, total_paid / total_claims AS paid_avg,
               '$' || format('{:,}', CAST(round(total_paid, 0) AS BIGINT)) AS total_paid_text,
               format('{:,}', total_claims) AS total_claims_text,
               '$' || format('{:,.2f}', total_paid / total_claims) AS paid_avg_text
        FROM (SELECT CAST(sum(CAST(paid_total AS DECIMAL(28,2))) AS DOUBLE) AS total_paid,
                     CAST(sum(claims) AS BIGINT) AS total_claims FROM kpis)""",
    ),
    "region_top10": _with(["region_top"], "SELECT * FROM region_top"),
    "region_network_paid": _with(
        ["region_top"],
        """
        SELECT CASE WHEN lower(trim(CAST(in_network AS VARCHAR))) IN ('true', '1', 'yes')
                    THEN 'In-Network' ELSE 'Out-of-Network' END AS network, member_region,
               CAST(sum(CAST(paid_total AS DECIMAL(28,2))) AS DOUBLE) AS paid_total
        FROM kpis WHERE member_region IN (SELECT member_region FROM region_top) GROUP BY ALL""",
    ),
    "monthly_region": _with(
        ["monthly"],
        """
        , series AS (
          SELECT month, member_region, CAST(sum(CAST(paid_total AS DECIMAL(28,2))) AS DOUBLE) AS paid_total,
                 CAST(sum(claims) AS BIGINT) AS claims FROM monthly GROUP BY month, member_region),
        top AS (
          SELECT member_region FROM series GROUP BY 1
          ORDER BY sum(CAST(paid_total AS DECIMAL(28,2))) DESC, member_region LIMIT 10)
        SELECT * FROM series SEMI JOIN top USING (member_region) ORDER BY member_region, month""",
    ),
    "region_loss_ratio": _with(["region_loss"], "SELECT * FROM region_loss"),
    "chart_flags": _with(
        ["region_loss"],
        """
        SELECT coalesce(bool_or(loss_ratio_pct IS NOT NULL), false) AS has_loss_ratio,
               coalesce(bool_or(billed_total > 0), false) AS has_billed,
               coalesce(bool_or(allowed_total > 0), false) AS has_allowed FROM region_loss""",
    ),
    "network_mart": _with(
        ["network_summary"],
        """
        SELECT CASE WHEN lower(trim(CAST(in_network AS VARCHAR))) IN ('true', '1', 'yes')
                    THEN 'In-Network' ELSE 'Out-of-Network' END AS network, claims, paid_total,
               printf('%.1f', round_even(utilization_pct, 1)) || '% util.' AS utilization_text
        FROM network_summary""",
    ),
    "diagnosis_top10": _with(
        ["diagnosis_summary"],
        "SELECT * FROM diagnosis_summary ORDER BY paid_total DESC, diagnosis_code NULLS LAST LIMIT 10",
    ),
    "map_feed": _with(
        ["feed"],
        """
        SELECT diagnosis_code, '99213' AS procedure_code,
               CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END AS gender, place_of_service AS region,
               'Office' AS place_of_service, CAST(0 AS DOUBLE) AS billed_amount, CAST(0 AS DOUBLE) AS allowed_amount,
               count(claim_id) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS paid_total,
               min(service_date) AS first_service
        FROM feed GROUP BY 1, 2, 3, 4""",
    ),
    "derive_members": _with(
        ["first_claim"],
        f"""
        SELECT member_id, member_id AS person_id,
               {AS_OF} - CAST(ceil((CASE WHEN l_quantity < 3 THEN 0 ELSE l_quantity + 17 END) * 365.25) AS INTEGER) AS dob,
               CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END AS gender, place_of_service AS region,
               DATE '2023-01-01' AS effective_date, CAST(NULL AS DATE) AS termination_date
        FROM first_claim""",
    ),
    "derive_providers": """
        SELECT DISTINCT 'P' || l_suppkey AS provider_id, 'Unknown' AS specialty, true AS in_network,
               'Unknown' AS region FROM lineitem""",
    "surrogate_keys": _with(
        ["feed"],
        """
        , firsts AS (
          SELECT provider_id AS code, min(ord) AS first_ord, count(*) AS claims,
                 CAST(sum(paid_amount) AS DOUBLE) AS paid_total FROM feed GROUP BY 1)
        SELECT row_number() OVER (ORDER BY first_ord) AS provider_id, 'P' || code AS provider_code,
               claims, paid_total FROM firsts""",
    ),
    "serial_claim_ids": _with(
        ["feed"],
        """
        SELECT 'P' || provider_id AS provider_id, min(ord) AS first_id, max(ord) AS last_id,
               CAST(sum(ord) AS BIGINT) AS id_sum, count(DISTINCT ord) AS ids FROM feed GROUP BY 1""",
    ),
    "ingest_feed": _with(
        ["first_claim"],
        f"""
        , numbered AS (
          SELECT code, row_number() OVER (ORDER BY first_ord) AS provider_id
          FROM (SELECT provider_id AS code, min(ord) AS first_ord FROM feed GROUP BY 1)),
        derived AS (
          SELECT member_id, CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END AS gender,
                 {AS_OF} - CAST(ceil((CASE WHEN l_quantity < 3 THEN 0 ELSE l_quantity + 17 END) * 365.25) AS INTEGER) AS dob
          FROM first_claim)
        SELECT n.provider_id, true AS in_network, m.gender, count(*) AS claims,
               CAST(sum(paid_amount) AS DOUBLE) AS paid_total, min(ord) AS first_claim, max(ord) AS last_claim,
               min(dob) AS oldest, max(service_date) AS last_service, '99213' AS procedure_code,
               CAST(0 AS DOUBLE) AS billed
        FROM feed f JOIN numbered n ON f.provider_id = n.code JOIN derived m USING (member_id) GROUP BY ALL""",
    ),
    "missing_texts": """
        SELECT l_returnflag, count(*) AS rows, count(CASE WHEN l_returnflag <> 'N' THEN 1 END) AS codes
        FROM lineitem GROUP BY 1""",
    "numeric_keys": """
        SELECT l_returnflag, count(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 END) AS numbers,
               CAST(sum(CASE WHEN l_returnflag IN ('A', 'N') THEN l_suppkey END) AS BIGINT) AS total
        FROM lineitem GROUP BY 1""",
    "network_labels": """
        SELECT CASE l_suppkey % 5 WHEN 0 THEN ' TRUE ' WHEN 1 THEN '1' WHEN 2 THEN 'yes' WHEN 3 THEN '0'
               ELSE 'n/a' END AS spelling,
               CASE WHEN l_suppkey % 5 < 3 THEN 'In-Network' ELSE 'Out-of-Network' END AS network, count(*) AS rows
        FROM lineitem GROUP BY ALL""",
    "fk_orphans": """
        SELECT l_suppkey AS provider_id, count(*) AS claims FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY 1""",
    "overlong_codes": """
        SELECT 'diagnosis_code' AS column_name, count(*) FILTER (length(p_name) > 8) AS too_long,
               min(p_name) FILTER (length(p_name) > 8) AS example
        FROM lineitem JOIN part ON l_partkey = p_partkey
        UNION ALL
        SELECT 'procedure_code', count(*) FILTER (length(p_type) > 8), min(p_type) FILTER (length(p_type) > 8)
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "member_cost": _with(
        ["cost"],
        "SELECT member_id, dob, member_region, in_network, CAST(paid_total AS DOUBLE) AS paid_total FROM cost",
    ),
    "high_cost_threshold": _with(
        ["cost", "threshold"],
        """
        SELECT round(any_value(t), 4) AS threshold, count(*) AS members,
               count(*) FILTER (CAST(paid_total AS DOUBLE) > t) AS above FROM cost, threshold""",
    ),
    "high_cost_labels": _with(
        ["cost", "threshold"],
        """
        SELECT member_id, in_network, CAST(CAST(paid_total AS DOUBLE) > t AS INTEGER) AS high_cost
        FROM cost, threshold""",
    ),
    "class_balance": _with(
        ["cost", "threshold"],
        """
        SELECT CAST(CAST(paid_total AS DOUBLE) > t AS INTEGER) AS high_cost, count(*) AS members
        FROM cost, threshold GROUP BY 1""",
    ),
    "split_balance": _with(
        ["cost", "threshold"],
        """
        , n AS (SELECT CAST(CAST(paid_total AS DOUBLE) > t AS INTEGER) AS high_cost, count(*) AS n
                FROM cost, threshold GROUP BY 1),
        share AS (SELECT *, n * ceil(sum(n) OVER () * 0.2) / sum(n) OVER () AS exact,
                         ceil(sum(n) OVER () * 0.2) AS wanted FROM n),
        sized AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, high_cost)
                         <= wanted - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS tests FROM share)
        SELECT 'test' AS side, high_cost, CAST(tests AS BIGINT) AS members FROM sized
        UNION ALL SELECT 'train', high_cost, CAST(n - tests AS BIGINT) FROM sized""",
    ),
    "profile": _with(
        ["claim"],
        "\n        UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS non_null,
                   {"CAST(NULL AS BIGINT)" if numeric else f"count(DISTINCT {c})"} AS unique_values,
                   {"NULL" if numeric else f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM claim WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"} AS top,
                   {"CAST(NULL AS BIGINT)" if numeric else f"(SELECT max(n) FROM (SELECT count(*) AS n FROM claim WHERE {c} IS NOT NULL GROUP BY {c}))"} AS freq,
                   {f"round(avg(CAST({c} AS DOUBLE)), 4)" if numeric else "CAST(NULL AS DOUBLE)"} AS mean,
                   {f"round(stddev_samp(CAST({c} AS DOUBLE)), 4)" if numeric else "NULL"} AS std,
                   {f"min(CAST({c} AS DOUBLE))" if numeric else "CAST(NULL AS DOUBLE)"} AS min,
                   {f"max(CAST({c} AS DOUBLE))" if numeric else "CAST(NULL AS DOUBLE)"} AS max,
                   {", ".join(
                       (f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 4)" if numeric else "CAST(NULL AS DOUBLE)")
                       + f" AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))}
            FROM claim"""
            for c, numeric in {
                "claim_id": False,
                "member_id": True,
                "provider_id": True,
                "service_date": False,
                "diagnosis_code": False,
                "procedure_code": False,
                "billed_amount": True,
                "allowed_amount": True,
                "paid_amount": True,
                "place_of_service": False,
            }.items()
        ),
    ),
    "lookup_fill": _with(
        ["claim"],
        """
        SELECT place_of_service, CASE WHEN place_of_service IN ('1-URGENT', '2-HIGH') THEN 'hospital'
               WHEN place_of_service = '5-LOW' THEN 'office' ELSE '' END AS care, count(*) AS claims
        FROM claim GROUP BY ALL""",
    ),
    "class_means": _with(
        ["claim", "dim_member"],
        """
        SELECT CASE WHEN age >= 40 THEN 'Senior' ELSE 'Junior' END AS age_group, count(paid_amount) AS n,
               round(avg(CAST(paid_amount AS DOUBLE)), 4) AS mean,
               round(stddev_samp(CAST(paid_amount AS DOUBLE)), 4) AS std,
               min(CAST(paid_amount AS DOUBLE)) AS minimum, max(CAST(paid_amount AS DOUBLE)) AS maximum
        FROM claim JOIN dim_member USING (member_id) GROUP BY 1""",
    ),
    "group_mean": _with(
        ["claim"],
        """
        SELECT diagnosis_code, round(avg(CAST(billed_amount AS DOUBLE)), 4) AS mean_billed
        FROM claim GROUP BY 1""",
    ),
    "frequency": _with(
        ["claim"],
        """
        SELECT place_of_service, count(*) AS rows FROM claim WHERE place_of_service IS NOT NULL
        GROUP BY 1 ORDER BY rows DESC, 1""",
    ),
    "bin_members": _with(
        ["dim_member"],
        """
        SELECT CASE WHEN age > 0 AND age <= 30 THEN 'Young' WHEN age > 30 AND age <= 40 THEN 'Middle'
                    WHEN age > 40 AND age <= 100 THEN 'Old' END AS age_category, age_band,
               count(*) AS members, min(age) AS youngest, max(age) AS oldest
        FROM dim_member GROUP BY ALL""",
    ),
    "date_parts": """
        SELECT service_date, strftime(service_date, '%B %d, %Y') AS written,
               CAST(service_date + INTERVAL 30 DAY AS DATE) AS due,
               CAST(date_trunc('month', service_date) AS DATE) AS month, claims
        FROM (SELECT CAST(l_shipdate AS DATE) AS service_date, count(*) AS claims FROM lineitem GROUP BY 1)""",
    "rounding_kinds": """
        SELECT x, round_even(x, 2) AS half_even, round(x, 2) AS half_up, rows
        FROM (SELECT l_quantity / 8 AS x, count(*) AS rows FROM lineitem GROUP BY 1)""",
    "redacted_urls": """
        SELECT s_suppkey, 'db://' || lower(s_name) || ':***@host/claims' AS url FROM supplier""",
    "synthetic_claims": """
        SELECT count(*) AS claims, count(*) AS ids, CAST(0 AS BIGINT) AS bad_members,
               CAST(0 AS BIGINT) AS bad_providers, CAST(0 AS BIGINT) AS bad_amounts, CAST(0 AS BIGINT) AS bad_dates,
               CAST(15 AS BIGINT) AS diagnoses FROM lineitem""",
}

_STAR_COUNTS = """
    SELECT (SELECT count(*) FROM member) AS dim_member_count,
           (SELECT count(*) FROM provider) AS dim_provider_count,
           (SELECT count(*) FROM calendar) AS dim_date_count,
           (SELECT count(*) FROM claim) AS fact_claims_count"""

_FAULTY = [
    ("dim_member_count", "(SELECT count(*) + 1 FROM listed)"),
    ("dim_provider_count", "(SELECT count(*) FROM provider)"),
    ("dim_date_count", "(SELECT count(*) FROM calendar WHERE year(date_key) < 2001)"),
    ("fact_claims_count", "(SELECT count(*) FROM doubled)"),
    ("fact_claims_dup_claim_id", "(SELECT count(*) - count(DISTINCT claim_id) FROM doubled)"),
    ("missing_member_refs", "(SELECT count(*) FROM doubled WHERE member_id NOT IN (SELECT c_custkey FROM listed))"),
    ("missing_provider_refs", "(SELECT count(*) FROM doubled ANTI JOIN provider USING (provider_id))"),
    ("missing_date_refs", "(SELECT count(*) FROM doubled WHERE service_date NOT IN (SELECT date_key FROM calendar WHERE year(date_key) < 2001))"),
    ("null_member_pk", "CAST(1 AS BIGINT)"),
    ("null_provider_pk", "CAST(0 AS BIGINT)"),
    ("null_date_pk", "CAST(0 AS BIGINT)"),
]

_FAULTS = (
    "duplicate claim_id in fact_claims; NULL primary keys found in dimensions; "
    "fact_claims contains member_id values not present in dim_member; "
    "fact_claims contains date_key values not present in dim_date"
)

_UNLISTED = "SELECT l_suppkey AS k FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"

ORACLES |= {
    "ingest_files": _with(
        ["claim", "member", "provider"],
        """
        SELECT p.specialty, p.in_network, m.gender, m.region AS member_region, count(*) AS claims, count(*) AS ids,
               CAST(sum(paid_amount) AS DOUBLE) AS paid_total, max(service_date) AS last_service, min(dob) AS oldest
        FROM claim JOIN provider p USING (provider_id) JOIN member m USING (member_id) GROUP BY ALL""",
    ),
    "ingest_without_ids": _with(
        ["claim"],
        """
        SELECT count(*) AS claims, CAST(1 AS BIGINT) AS first_member, count(*) AS last_member, count(*) AS claim_members,
               CAST(1 AS BIGINT) AS provider, CAST(0 AS BIGINT) AS moved, CAST(sum(paid_amount) AS DOUBLE) AS paid_total,
               count(*) AS members, count(*) AS with_dob FROM claim""",
    ),
    "reference_errors": f"""
        SELECT CAST(0 AS INTEGER) AS file, CASE WHEN count(*) = 0 THEN '' ELSE count(DISTINCT k) || ' provider_id value(s) of the claims are not among the providers: '
               || (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT DISTINCT k FROM ({_UNLISTED}) ORDER BY k LIMIT 10)) END AS error
        FROM ({_UNLISTED})
        UNION ALL SELECT 1, 'the providers file has no ''provider_id'' column, so claims cannot refer to it; '
               || 'add the column, or drop the file to have providers made from the claims'
        UNION ALL SELECT 2, ''""",
    "cut_texts": _with(
        ["provider"],
        "SELECT provider_id, left(repeat(specialty, 15), 80) AS specialty, in_network, left(repeat(region, 9), 50) AS region FROM provider",
    ),
    "csv_with_column": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_name || '/' || s_suppkey AS label FROM supplier",
    "warehouse_tables": _with(
        ["claim", "member", "provider", "calendar", "kpis", "monthly", "loss_ratio", "network_summary"],
        "\n        UNION ALL ".join(
            [
                """SELECT 'fact_claims' AS table_name, CAST(year(service_date) AS INTEGER) AS year,
                   CAST(month(service_date) AS INTEGER) AS month, count(*) AS rows, CAST(sum(paid_amount) AS DOUBLE) AS paid_total
            FROM claim GROUP BY ALL""",
                *(
                    f"SELECT '{name}', NULL, NULL, count(*), NULL FROM {source}"
                    for name, source in {
                        "dim_member": "member", "dim_provider": "provider", "dim_date": "calendar", "summary_kpis": "kpis",
                        "summary_monthly": "monthly", "summary_loss_ratio": "loss_ratio", "summary_network": "network_summary",
                    }.items()
                ),
            ]
        ),
    ),
    "q1_stored": ORACLES["q1_age_region"],
    "q3_stored": ORACLES["q3_loss_rank"],
    "cube_reports": ORACLES["kpis"],
    "gate_failures": _with(
        ["claim", "provider", "calendar"],
        f"""
        , listed AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0),
        doubled AS (SELECT * FROM claim UNION ALL SELECT * FROM claim WHERE split_part(claim_id, '-', 2) = '1')
        SELECT {", ".join(f"{sql} AS {name}" for name, sql in _FAULTY)}, '{_FAULTS}' AS failures, 'failed' AS status,
               'DW quality checks failed: {_FAULTS}' AS stopped""",
    ),
    "quality_report": _with(
        ["claim", "member", "provider", "calendar"],
        f"""
        , v AS ({_STAR_COUNTS})
        SELECT "check", CAST(value AS VARCHAR) AS value FROM (UNPIVOT v ON COLUMNS(*) INTO NAME "check" VALUE value)
        UNION ALL SELECT unnest(['fact_claims_dup_claim_id', 'missing_member_refs', 'missing_provider_refs', 'missing_date_refs',
                                 'null_member_pk', 'null_provider_pk', 'null_date_pk']), '0'
        UNION ALL SELECT 'status', 'ok'""",
    ),
    "report_files": _with(
        ["kpis", "monthly", "loss_ratio", "network_summary", "claim", "joined"],
        """
        SELECT 'KPIs' AS sheet, count(*) AS rows, CAST(sum(claims) AS BIGINT) AS claims FROM kpis
        UNION ALL SELECT 'Monthly', count(*), CAST(sum(claims) AS BIGINT) FROM monthly
        UNION ALL SELECT 'LossRatio', count(*), CAST(sum(claims) AS BIGINT) FROM loss_ratio
        UNION ALL SELECT 'NetworkUtilization', count(*), CAST(sum(claims) AS BIGINT) FROM network_summary
        UNION ALL SELECT 'DiagnosisSummary', count(DISTINCT diagnosis_code), count(claim_id) FROM joined
        UNION ALL SELECT 'Model_Metrics', 1, NULL
        UNION ALL SELECT 'Summary', 1, NULL""",
    ),
    "classifier_fit": _with(
        ["cost", "threshold"],
        """
        , n AS (SELECT CAST(CAST(paid_total AS DOUBLE) > t AS INTEGER) AS high_cost, count(dob) AS n, count(*) - count(dob) AS lost
                FROM cost, threshold GROUP BY 1),
        share AS (SELECT *, n * ceil(sum(n) OVER () * 0.2) / sum(n) OVER () AS exact, ceil(sum(n) OVER () * 0.2) AS wanted FROM n),
        sized AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, high_cost)
                                                     <= wanted - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS tests FROM share)
        SELECT CAST(sum(n - tests) FILTER (high_cost = 0) AS BIGINT) AS train_0, CAST(sum(n - tests) FILTER (high_cost = 1) AS BIGINT) AS train_1,
               CAST(sum(tests) FILTER (high_cost = 0) AS BIGINT) AS test_0, CAST(sum(tests) FILTER (high_cost = 1) AS BIGINT) AS test_1,
               CAST(sum(lost) AS BIGINT) AS without_age, true AS optimal FROM sized""",
    ),
    "classifier_fallbacks": _with(
        ["cost", "threshold"],
        """
        , n AS (SELECT CAST(paid_total AS DOUBLE) > t AS costly, dob FROM cost, threshold)
        SELECT 'one class' AS case_name, 'LogisticRegression skipped (single target class), baseline accuracy' AS label,
               count(*) FILTER (NOT costly AND dob IS NULL) AS without_age, true AS in_range FROM n
        UNION ALL SELECT 'one row', 'LogisticRegression train accuracy (fallback, no stratified split)',
               count(*) FILTER (NOT costly AND dob IS NULL), true FROM n
        UNION ALL SELECT 'unstratified', 'LogisticRegression accuracy', count(*) FILTER (dob IS NULL), true FROM n""",
    ),
    "nation_top10": _with(
        ["claim", "provider"],
        """
        , k AS (SELECT n_name AS member_region, in_network, sum(paid_amount) AS paid
                FROM claim JOIN customer ON c_custkey = member_id JOIN nation ON n_nationkey = c_nationkey
                JOIN provider USING (provider_id) GROUP BY ALL),
        top AS (SELECT member_region FROM k GROUP BY 1 ORDER BY CAST(sum(paid) AS DOUBLE) DESC, member_region LIMIT 10)
        SELECT CASE WHEN in_network THEN 'In-Network' ELSE 'Out-of-Network' END AS network, member_region,
               CAST(sum(paid) AS DOUBLE) AS paid_total
        FROM k SEMI JOIN top USING (member_region) GROUP BY ALL""",
    ),
    "kept_numbers": """
        SELECT CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS provider_id, count(*) AS claims,
               CASE WHEN provider_id IS NOT NULL THEN true END AS listed FROM lineitem GROUP BY ALL""",
}

from claimloom.config_oracles import ORACLES as _CONFIG  # noqa: E402  (they use the tables above)
from claimloom.refresh_oracles import ORACLES as _REFRESH  # noqa: E402

ORACLES |= _REFRESH | _CONFIG
