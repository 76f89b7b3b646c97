"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.schema import FAMILY_LABELS, NULL_MARKERS

DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "yyyyMMdd")


def is_finite(c: Column) -> Column:
    return ~(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def finite_or_null(c: Column) -> Column:
    """NaN and infinities become NULL (analysis results)."""
    return F.when(is_finite(c), c)


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and infinities become 0.0 (metrics)."""
    return F.coalesce(finite_or_null(c), F.lit(0.0))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def missing_text_to_null(c: Column) -> Column:
    return F.when(~F.trim(c).isin(*NULL_MARKERS), c)


def to_number(c: Column) -> Column:
    """Numeric value of a text or number, NULL where there is none."""
    return nan_to_null(c.try_cast("double"))


def to_day(c: Column) -> Column:
    """Calendar day of a text, timestamp or date, NULL where it cannot be read or its year is not one of a timestamp in nanoseconds."""
    text = c.cast("string")
    day = F.coalesce(
        c.try_cast("date"),
        *[F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in DATE_FORMATS],
    )
    return F.when(F.year(day).between(1678, 2261), day)


def to_store(c: Column) -> Column:
    """Store number of a text or number ('7', '7.0'), NULL where it is not a whole one."""
    number = to_number(c)
    return F.coalesce(c.try_cast("int"), F.when(number == F.floor(number), number).try_cast("int"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL on a zero divisor (ANSI division would raise)."""
    return F.try_divide(a, b)


def clip_low(c: Column, low: float = 0.0) -> Column:
    """Values under `low` become `low`; NULL stays NULL (`greatest` would skip it)."""
    return F.when(c < low, F.lit(low).cast("double")).otherwise(c)


def family_label(c: Column) -> Column:
    """Display label, or the name itself when none is known."""
    pairs = ", ".join(f"'{name}', '{label}'" for name, label in FAMILY_LABELS.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), c), c)


def safe_key(c: Column) -> Column:
    """Upper case; every run of characters outside A-Z, 0-9 becomes one underscore; none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "_"), "^_|_$", "")


def week_end(c: Column) -> Column:
    """The Sunday that closes the week of a day."""
    return F.date_add(F.date_trunc("week", c).cast("date"), 6)


def week_label(sunday: Column) -> Column:
    """`%Y-W%W` of a Sunday."""
    return F.format_string("%d-W%02d", F.year(sunday), F.floor(F.dayofyear(sunday) / F.lit(7)).cast("int"))


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
