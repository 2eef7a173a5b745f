"""Table summaries: previews, profiles, class statistics, frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

from claimloom.functions.exprs import as_double
from claimloom.operators.order_stats import Series, Span, in_units, quantiles, sketch_of

QUARTILES = [0.25, 0.5, 0.75]


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def value_counts(df: DataFrame) -> DataFrame:
    """(column, value, rows) for every column in one scan, combined before the shuffle."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns]
    long = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def _series(df: DataFrame) -> tuple[dict[str, Series], dict[str, int]]:
    """Every numeric column to rank: whole and decimal ones exactly in their units, doubles without NaN."""
    series, units = {}, {}
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (IntegralType, DecimalType)):
            scale = getattr(kind, "scale", 0)
            series[field.name], units[field.name] = Series(in_units(column, scale)), 10**scale
        elif isinstance(kind, NumericType):
            series[field.name] = Series(F.nanvl(column.cast("double"), F.lit(None)), False)
    return series, units


def profile(df: DataFrame, quartiles: bool = True) -> DataFrame:
    """One row per column, as a describe-all would print it.

    Every column has its type and number of non-null values; text-like columns
    their distinct values and the most frequent one, numeric ones mean, std, min
    and max and exact quartiles. Three passes over the input, so pass a stored
    table: one aggregate of all columns, which also sketches the numeric ones;
    one value count over all texts; one exact count around the sketched
    quartiles (more only where millions of values are that close to one).
    """
    spark = df.sparkSession
    fields = {f.name: f.dataType for f in df.schema.fields}
    series, units = _series(df)
    texts = [c for c in fields if c not in series]

    def stats(c: str):
        v = as_double(F.col(f"`{c}`") if c in series else F.lit(None))
        named = {"non_null": F.count(f"`{c}`"), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        return F.struct(*[x.alias(n) for n, x in named.items()])

    asked = [stats(c).alias(f"s{i}") for i, c in enumerate(fields)]
    asked += [sketch_of(series[c]).alias(f"q{i}") for i, c in enumerate(fields) if quartiles and c in series]
    found = df.agg(*asked).first()  # one row, of some 100 KB a numeric column
    places: dict[str, list] = {}
    if quartiles:
        spans = {c: Span(**found[f"q{i}"].asDict()) for i, c in enumerate(fields) if c in series}
        places = quantiles(df, series, spans, QUARTILES, units)
    rows = [(c, t.simpleString(), *found[f"s{i}"], *places.get(c, [None] * len(QUARTILES))) for i, (c, t) in enumerate(fields.items())]
    points = ", ".join(f"p{round(q * 100)} double" for q in QUARTILES)
    kinds = f"column_name string, data_type string, non_null bigint, mean double, std double, min double, max double, {points}"
    out = spark.createDataFrame(rows, kinds)
    if not quartiles:
        out = out.drop(*[f"p{round(q * 100)}" for q in QUARTILES])

    # Ties for the most frequent value go to the smallest.
    first = F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("first")
    common = value_counts(df.select(*[f"`{c}`" for c in texts])) if texts else spark.createDataFrame([], "column_name string, value string, n bigint")
    common = common.groupBy("column_name").agg(F.count("*").alias("unique_values"), first)
    top = common.select("column_name", "unique_values", F.col("first.value").alias("top"), (-F.col("first.minus_n")).alias("freq"))
    return out.join(top, "column_name", "left").select(
        *out.columns[:7], "unique_values", "top", "freq", *out.columns[7:]
    )


def group_mean(df: DataFrame, by: str, value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(by).agg(F.avg(as_double(F.col(value))).alias(out))


def class_means(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per class."""
    v = as_double(F.col(value))
    return df.groupBy(by).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
    )


def moments(df: DataFrame, by: str, value: str) -> DataFrame:
    """Additive statistics of a money column per key: rows, sum, sum of squares (exact decimals), smallest, largest."""
    v = F.col(value)
    return df.groupBy(by).agg(
        F.count(v).alias("n"),
        F.sum(v).alias("total"),
        F.sum((v * v).cast("decimal(28,4)")).alias("squares"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
    )


def means_of_moments(sums: DataFrame, by: str) -> DataFrame:
    """``class_means`` from ``moments``, for classes that only a join of the keys tells."""
    n, total, squares = F.sum("n"), as_double(F.sum("total")), as_double(F.sum("squares"))
    spread = F.greatest(squares - total * total / F.nullif(n, F.lit(0)), F.lit(0.0))
    return sums.groupBy(by).agg(
        n.alias("n"),
        (total / F.nullif(n, F.lit(0))).alias("mean"),
        F.when(n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0)))).alias("std"),
        as_double(F.min("minimum")).alias("minimum"),
        as_double(F.max("maximum")).alias("maximum"),
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.col("rows").desc(), column)
