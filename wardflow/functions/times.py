"""Date and time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardflow.functions.numbers import round_even

MICROS_PER_DAY = 86_400_000_000.0


def to_timestamp(col: Column, fmt: str | None = None) -> Column:
    """Timestamp in a text, null when there is none.

    Without a format every ISO form is read; with one, only that form.
    """
    if fmt is None:
        return col.try_cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def to_birth_date(col: Column, fmt: str = "d/M/yyyy") -> Column:
    """Day-first date; one-digit days and months pass, two-digit years do not."""
    return F.try_to_timestamp(col, F.lit(fmt)).cast("date")


def days_between(start: Column, end: Column, digits: int = 1) -> Column:
    """Elapsed days from ``start`` to ``end`` as a rounded double."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return round_even(micros / F.lit(MICROS_PER_DAY), digits)


def whole_years(birth: Column, at: Column, days_per_year: int = 365) -> Column:
    """Whole years of ``days_per_year`` days, rounded towards minus infinity."""
    return F.floor(F.datediff(at, birth) / F.lit(days_per_year)).cast("double")


def shift_days(start: Column, days: Column) -> Column:
    """Timestamp moved by a fractional number of days, to the second."""
    return F.timestamp_add("SECOND", F.rint(days * F.lit(86400.0)).cast("int"), start)
