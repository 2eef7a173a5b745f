"""Column expressions of the claims model. No UDFs: everything is a Catalyst expression.

Two kinds of rounding occur and must not be mixed up: reports round half to
even (``round_even``), the SQL over the warehouse rounds half away from zero
(plain ``round``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.model import AGE_EDGES, AGE_LABELS

AsOf = dt.date | Column


def _date(as_of: AsOf) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


# ---- dates -------------------------------------------------------------------
def age_years(dob: Column, as_of: AsOf) -> Column:
    """Whole 365-day years, floored (so a birth after ``as_of`` gives -1, not 0)."""
    return F.floor(F.datediff(_date(as_of), dob) / F.lit(365))


def age_band(age: Column) -> Column:
    return bin_column(age, AGE_EDGES, AGE_LABELS)


def dob_from_age(age: Column, as_of: AsOf) -> Column:
    """Birth date from an age text; an unreadable age counts as 0 years."""
    years = F.coalesce(to_number(age), F.lit(0.0))
    return F.date_sub(_date(as_of), F.ceil(years * 365.25).cast("int"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_after(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def long_date(day: Column) -> Column:
    """``January 15, 2023``."""
    return F.date_format(day, "MMMM dd, yyyy")


# ---- conditions and labels ---------------------------------------------------
def bin_column(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge[i], edge[i+1]] -> labels[i]``; null outside."""
    if len(edges) != len(labels) + 1:
        raise ValueError("bin_column needs exactly one more edge than labels")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def either(condition: Column, yes, no) -> Column:
    """Two-way choice; a null condition takes ``no``."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def network_label(value: Column) -> Column:
    text = F.lower(F.btrim(value.cast("string"), F.lit(" \t\r\n\f\v")))
    return either(text.isin("true", "1", "yes"), "In-Network", "Out-of-Network")


def over_threshold(value: Column, threshold: Column) -> Column:
    return (value > threshold).cast("int")


# ---- arithmetic --------------------------------------------------------------
def round_even(value: Column, digits: int = 2) -> Column:
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def as_double(value: Column) -> Column:
    return value.cast("double")


def guarded_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` half-even to 2 digits, null unless ``whole`` is positive."""
    ratio = as_double(part) / F.nullif(as_double(whole), F.lit(0.0)) * 100
    return F.when(whole > 0, round_even(ratio, 2))


def pct_text(value: Column, suffix: str = "%") -> Column:
    """One decimal and a suffix, e.g. ``49.9%``."""
    return F.concat(F.format_string("%.1f", round_even(value, 1)), F.lit(suffix))


def money_text(value: Column, digits: int) -> Column:
    """``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(value, digits))


# ---- coercion ----------------------------------------------------------------
POWER = r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_number(value: Column) -> Column:
    return value.rlike(NUMBER)


def to_number(value: Column) -> Column:
    """Text to DOUBLE, null if it is no number.

    The pattern goes first because a failing cast costs an exception per row.
    """
    return F.when(is_number(value), value.try_cast("double"))


def to_key(value: Column) -> Column:
    """Text to BIGINT; ``12``, ``12.0`` and ``1e3`` are keys, anything else is null.

    A zero fraction is cut off the text, so that no digit of a long key is lost
    in a DOUBLE. Patterns go first because a failing cast costs an exception per
    row; only a text of 19 digits can still fail.
    """
    plain = F.when(value.rlike(r"^\d{1,18}$"), value.cast("bigint"))  # most keys; the other patterns are not tried on them
    text = F.btrim(value, F.lit(" \t\r\n\f\x0b"))
    digits = F.regexp_replace(text, r"\.0*$", "")
    power = F.when(text.rlike(POWER), text.try_cast("double"))
    other = (
        F.when(digits.rlike(r"^[+-]?\d{1,18}$"), digits.cast("bigint"))
        .when(digits.rlike(r"^[+-]?\d+$"), digits.try_cast("bigint"))
        .otherwise(F.when(power == F.floor(power), power.try_cast("bigint")))
    )
    return F.coalesce(plain, other)


def strict_cast(value: Column, dtype, name: str) -> Column:
    """Cast, but fail the job on a value that does not fit, whatever the ANSI setting. A value that fits is cast once."""
    message = F.concat(F.lit(f"column '{name}' holds a value that is not a valid type: "), value.cast("string"))
    return F.coalesce(value.try_cast(dtype), F.when(value.isNotNull(), F.raise_error(message).cast(dtype)))


def cut_text(value: Column, width: int) -> Column:
    return F.substring(value.cast("string"), 1, width)


def redact_password(url: Column) -> Column:
    """Hide the password of a connection text: all between the first colon of the authority and its last ``@``."""
    scheme = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(scheme) + 4, F.length(url))
    authority = F.substring_index(rest, "/", 1)
    host = F.substring_index(authority, "@", -1)
    login = F.substring(authority, F.lit(1), F.length(authority) - F.length(host) - 1)
    hidden = F.concat(scheme, F.lit("://"), F.substring_index(login, ":", 1), F.lit(":***@"), host)
    hidden = F.concat(hidden, F.substring(rest, F.length(authority) + 1, F.length(rest)))
    return F.when(F.contains(authority, F.lit("@")) & F.contains(login, F.lit(":")), hidden).otherwise(url)
