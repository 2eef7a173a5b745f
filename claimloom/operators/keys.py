"""Keys of a feed: assignment, derived dimensions, surrogate numbers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.exprs import dob_from_age, is_number, to_key
from claimloom.model import ROLE_DEFAULTS
from claimloom.operators.joins import join_dimension, missing_keys
from claimloom.operators.ordinals import ORD, number_by_ordinal
from claimloom.session import stage


def ensure_claim_keys(claims: DataFrame, ordinal: str = ORD) -> DataFrame:
    """Without a member_id number the claims 1..n; without a provider_id use 1."""
    if "member_id" not in claims.columns:
        claims = claims.withColumn("member_id", F.col(ordinal) + 1)
    if "provider_id" not in claims.columns:
        claims = claims.withColumn("provider_id", F.lit(1))
    return claims


def first_per_key(df: DataFrame, key: str, order, columns: list[str]) -> DataFrame:
    """The listed columns of the first row of each key (null is a key too).

    An aggregate, not a window: rows combine before the shuffle, so a key with
    a third of all rows sends one row per task.
    """
    first = F.min_by(F.struct(*columns), order).alias("_row") if columns else F.lit(1).alias("_row")
    rows = df.groupBy(key).agg(first, F.min(order).alias(ORD))
    return rows.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns], ORD)


#: Value sets of a claim's member attributes that are numbered; 15 bits, so that ordinals have 48.
MAX_CLASSES, CLASS_BITS = (1 << 15) - 1, 15


def first_by_class(df: DataFrame, key: str, columns: list[str]) -> DataFrame | None:
    """``first_per_key`` by ``_ord`` where the columns have few different value sets; None where they have many.

    The sets are numbered, so that a key's first row is the least of one number:
    that is a hash aggregate, where texts would have all rows sorted by key.
    """
    values = df.select(*columns).distinct().limit(MAX_CLASSES + 1).collect()
    if len(values) > MAX_CLASSES:
        return None
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in df.select(*columns).dtypes)
    classes = df.sparkSession.createDataFrame([(i, *v) for i, v in enumerate(values)], f"_class bigint, {kinds}")
    named = classes.select("_class", *[F.col(c).alias(f"_of_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    numbered = df.select(key, ORD, *columns).join(F.broadcast(named), same)
    place = F.shiftleft(ORD, CLASS_BITS).bitwiseOR(F.col("_class"))
    firsts = numbered.groupBy(key).agg(F.min(place).alias("_place"))
    firsts = firsts.select(key, F.shiftright("_place", CLASS_BITS).alias(ORD), F.col("_place").bitwiseAND(MAX_CLASSES).alias("_number"))
    return firsts.join(F.broadcast(classes), F.col("_number") == F.col("_class")).select(key, *columns, ORD)


def derive_members(claims: DataFrame, as_of: dt.date, order=ORD, numbered: bool = False, stored: bool = False) -> DataFrame:
    """One member per member_id, from the first claim that names it.

    ``numbered`` says that the claims were numbered for want of ids: each is a
    member's only one, and nothing is grouped. ``stored`` says that claims are
    stored rows with ``_ord``, which may be read twice.
    """
    order = F.col(order) if isinstance(order, str) else order
    known = [c for c in ("age", "gender", "region") if c in claims.columns]
    rows = first_by_class(claims, "member_id", known) if stored and known else None
    if numbered:
        rows = claims.select("member_id", *known, order.alias(ORD))
    elif rows is None:
        rows = first_per_key(claims, "member_id", order, known)
    base = ROLE_DEFAULTS["members"]
    dob = dob_from_age(F.col("age").cast("string"), as_of) if "age" in known else F.lit(None).cast("date")
    return rows.select(
        "member_id",
        F.col("member_id").alias("person_id"),
        dob.alias("dob"),
        (F.col("gender") if "gender" in known else F.lit(base["gender"])).alias("gender"),
        (F.col("region") if "region" in known else F.lit(base["region"])).alias("region"),
        F.lit(base["effective_date"]).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("termination_date"),
        ORD,
    )


def derive_providers(claims: DataFrame, order=ORD) -> DataFrame:
    """One provider per non-null provider_id, with the default attributes."""
    order = F.col(order) if isinstance(order, str) else order
    rows = first_per_key(claims.filter(F.col("provider_id").isNotNull()), "provider_id", order, [])
    base = ROLE_DEFAULTS["providers"]
    return rows.select(
        "provider_id", *[F.lit(base[c]).alias(c) for c in ("specialty", "in_network", "region")], ORD
    )


def number_by_first_appearance(dim: DataFrame, key: str, out: str, order: str = ORD) -> DataFrame:
    """Distinct non-null keys with 1..k in order of first appearance."""
    firsts = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(ORD))
    return number_by_ordinal(stage(firsts, f"{key}_firsts"), ORD, out).select(key, out)


def map_surrogates(
    dim: DataFrame, fact: DataFrame, key: str, order: str = ORD, known: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Make ``key`` a BIGINT on both sides.

    If every non-null dimension key is a number the numbers are kept and a fact
    key that is none becomes null. Otherwise keys are numbered by first
    appearance in the dimension, and a fact key without a number is an error
    (``known`` says that none can occur, the dimension being made from the fact).
    """
    if key not in dim.columns or key not in fact.columns:
        return dim, fact
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = [dict(df.dtypes)[key] for df in (dim, fact)]
    if all(t in whole for t in types):
        return dim, fact

    text = F.col(key).cast("string")
    given = text.isNotNull()
    flags = dim.agg(
        F.coalesce(F.bool_and(F.when(given, is_number(text))), F.lit(True)).alias("numeric"),
        F.coalesce(F.bool_and(F.when(given, to_key(text).isNotNull())), F.lit(True)).alias("whole"),
    ).first()
    if flags["numeric"]:
        if not flags["whole"]:
            raise ValueError(f"key '{key}' holds numbers that are not whole")
        return dim.withColumn(key, to_key(text)), fact.withColumn(key, to_key(text))

    dim, fact = dim.withColumn(key, text), fact.withColumn(key, text)
    numbers = stage(number_by_first_appearance(dim, key, "_number", order), f"{key}_numbers")
    if not known:
        unknown = stage(missing_keys(fact, numbers, key), f"{key}_unknown")
        count = unknown.count()
        if count:
            shown = ", ".join(repr(r[0]) for r in unknown.orderBy(key).limit(5).collect())  # all are counted, five shown
            more = f" (and {count - 5} more)" if count > 5 else ""
            raise ValueError(f"{key} values of the claims without a dimension row: {shown}{more}")

    def rewrite(df: DataFrame) -> DataFrame:
        columns = [F.col("_number").alias(key) if c == key else F.col(c) for c in df.columns]
        return join_dimension(df, numbers, key, "left").select(*columns)

    return rewrite(dim), rewrite(fact)
