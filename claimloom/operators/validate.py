"""Checks that stop a load: key columns, references, code widths, uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.exprs import to_key
from claimloom.model import CODE_WIDTHS, REPORT_COLUMNS, REPORT_TITLES
from claimloom.operators.joins import missing_keys


def require_references(claims: DataFrame, dim: DataFrame, key: str, role: str) -> None:
    """Every non-null claim key must exist in a dimension that came as a file."""
    if key not in dim.columns:
        raise ValueError(
            f"the {role} file has no '{key}' column, so claims cannot refer to it; "
            f"add the column, or drop the file to have {role} made from the claims"
        )
    missing = missing_keys(
        claims.select(F.col(key).cast("string")), dim.select(F.col(key).cast("string")), key
    )
    total = missing.count()
    if total:
        first = missing.orderBy(to_key(F.col(key)).asc_nulls_last(), key).limit(10).collect()
        raise ValueError(
            f"{total} {key} value(s) of the claims are not among the {role}: {', '.join(r[0] for r in first)}"
        )


def overlong_codes(df: DataFrame, order=None) -> DataFrame:
    """Per code column: number of values over the width limit and an example."""
    parts = []
    for name, width in CODE_WIDTHS.items():
        if name not in df.columns:
            continue
        code = F.col(name).cast("string")
        bad = F.when(F.length(code) > width, code)
        example = F.min(bad) if order is None else F.min_by(bad, F.when(bad.isNotNull(), order))
        parts.append(
            F.struct(F.lit(name).alias("column_name"), F.count(bad).alias("too_long"), example.alias("example"))
        )
    # Both columns are checked in one scan.
    return df.agg(F.array(*parts).alias("checks")).select(F.inline("checks"))


def require_code_widths(df: DataFrame, role: str, order=None) -> None:
    if not any(c in df.columns for c in CODE_WIDTHS):
        return
    present = [c for c in CODE_WIDTHS if c in df.columns]
    # lengths are numbers, which need no sort; the examples are looked for only if a code is too long
    longest = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in present]).first()
    if all((longest[c] or 0) <= CODE_WIDTHS[c] for c in present):
        return
    for row in overlong_codes(df, order).filter("too_long > 0").orderBy("column_name").collect():
        name = row["column_name"]
        raise ValueError(
            f"{role}: a {name} has at most {CODE_WIDTHS[name]} characters and is never cut, "
            f"but the feed holds {row['example']!r}"
        )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, key: str, table: str) -> None:
    """What a primary key would enforce: no nulls, no repeats."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    bad = per_key.agg(
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeats"),
    ).first()
    if bad["nulls"] or bad["repeats"]:
        raise ValueError(
            f"table '{table}' breaks its key {key}: null key {'found' if bad['nulls'] else 'not found'}, "
            f"{bad['repeats']} repeated keys"
        )


def require_report_columns(name: str, df: DataFrame) -> None:
    missing = sorted(set(REPORT_COLUMNS[name]) - set(df.columns))
    if missing:
        raise ValueError(f"{REPORT_TITLES[name]} report lacks columns: {missing}")
