"""Feed columns to model columns: rename, defaults, trim, missing texts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimloom.functions.exprs import cut_text, strict_cast, to_key
from claimloom.model import NULL_TOKENS, TEXT_WIDTHS

Default = str | int | float | bool | None | Column | Callable[[], Column]


def missing_to_null(columns: Sequence[str]) -> list[Column]:
    """The columns with the usual texts for "missing" read as null."""
    return [F.when(~F.col(f"`{c}`").isin(NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in columns]


def rename_columns(df: DataFrame, column_map: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns that are present; the others pass through."""
    renames = {source: target for source, target in column_map.items() if source in df.columns}
    names = [renames.get(c, c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"more than one source column maps to: {clash}")
    return df.withColumnsRenamed(renames) if renames else df


def add_defaults(df: DataFrame, defaults: Mapping[str, Default]) -> DataFrame:
    """Add a default for each *absent* column; nulls of a present column stay null."""
    added = {}
    for name, value in defaults.items():
        if name in df.columns:
            continue
        if callable(value) and not isinstance(value, Column):
            value = value()
        added[name] = value if isinstance(value, Column) else F.lit(value)
    return df.withColumns(added) if added else df


def apply_mapping(df: DataFrame, column_map: Mapping[str, str], defaults: Mapping[str, Default]) -> DataFrame:
    return add_defaults(rename_columns(df, column_map), defaults)


def trim_to_schema(df: DataFrame, schema: StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keep the table's columns that are present, in table order."""
    return df.select(*[f.name for f in schema.fields if f.name in df.columns], *[c for c in extra if c in df.columns])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the table's types, cut descriptions to width, add absent columns as null."""
    out = []
    for field in schema.fields:
        name, dtype = field.name, field.dataType
        if name not in df.columns:
            column = F.lit(None).cast(dtype)
        elif name == "person_id":
            column = to_key(F.col(name).cast("string"))
        elif dtype.typeName() == "string":
            column = F.col(name).cast("string")
            if name in TEXT_WIDTHS:
                column = cut_text(column, TEXT_WIDTHS[name])
        else:
            column = strict_cast(F.col(name), dtype, name)
        out.append(column.alias(name))
    return df.select(*out)
