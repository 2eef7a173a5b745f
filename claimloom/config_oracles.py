"""DuckDB SQL of ``config_queries``."""

from __future__ import annotations

from claimloom.model import REPORT_COLUMNS, REPORT_TITLES
from claimloom.oracles import _with


def _contracts() -> str:
    rows = []
    for name, columns in REPORT_COLUMNS.items():
        first, *_, last = sorted(columns)
        rows += [(f"{name}: whole", ""), (f"{name}: one more", "")]
        rows.append((f"{name}: two less", f"ValueError: {REPORT_TITLES[name]} report lacks columns: {[first, last]}"))
    rows.append(("no claims role", "ValueError: a feed needs a file for the 'claims' role"))
    rows.append(
        (
            "no key column",
            "ValueError: the providers file has no 'provider_id' column, so claims cannot refer to it; "
            "add the column, or drop the file to have providers made from the claims",
        )
    )
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join(f'({quoted(a)}, {quoted(b)})' for a, b in rows)}) t(case_name, said)"


_SHAPES = ("lineitem", "orders", "customer", "supplier", "part")

ORACLES: dict[str, str] = {
    "configured_feeds": _with(
        ["feed"],
        """
        SELECT '00000' AS procedure_code, diagnosis_code, count(*) AS claims, CAST(sum(paid_amount) AS DOUBLE) AS paid_total, 'acme' AS feed
        FROM feed GROUP BY ALL
        UNION ALL SELECT diagnosis_code, 'Z00', count(*), CAST(sum(paid_amount) AS DOUBLE), 'second' FROM feed GROUP BY ALL""",
    ),
    "contract_errors": _contracts(),
    "network_classifier": _with(
        ["cost"],
        "SELECT count(*) AS members, count(*) FILTER (member_id % 7 <> 0) AS right FROM cost WHERE dob IS NOT NULL",
    ),
    "plain_split_sides": _with(
        ["cost"], "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS on_both_sides, CAST(0 AS BIGINT) AS changed, true AS a_fifth FROM cost"
    ),
    "table_shapes": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, "
        f"(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {t})) AS columns, least((SELECT count(*) FROM {t}), 7) AS previewed"
        for t in _SHAPES
    ),
}
