"""Column-by-column repairs: types, implausible values, inverted dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions.numbers import to_double
from wardflow.functions.text import strip
from wardflow.functions.times import days_between, to_birth_date, to_timestamp


def coerce_types(
    df: DataFrame,
    timestamps: Sequence[str] = (),
    birth_dates: Sequence[str] = (),
    numbers: Sequence[str] = (),
    blank_defaults: Mapping[str, str] | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Read typed values out of texts; what cannot be read becomes null.

    ``blank_defaults`` gives the text that stands for a null or blank cell.
    """
    changes: dict[str, Column] = {}
    for name in timestamps:
        changes[name] = to_timestamp(F.col(name), timestamp_format)
    for name in birth_dates:
        changes[name] = to_birth_date(F.col(name))
    for name in numbers:
        changes[name] = to_double(F.col(name))
    for name, default in (blank_defaults or {}).items():
        changes[name] = F.coalesce(F.nullif(strip(F.col(name)), F.lit("")), F.lit(default))
    return df.withColumns(changes)


def outside(column: str, low: float, high: float) -> Column:
    """Whether a present value lies outside the closed range."""
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def null_outside(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Null the values outside their closed range; rows are kept."""
    return df.withColumns(
        {
            name: F.when(F.col(name).between(low, high), F.col(name))
            for name, (low, high) in bounds.items()
        }
    )


def inverted(start: str, end: str) -> Column:
    """Whether the end is known and comes before the start."""
    return F.coalesce(F.col(end) < F.col(start), F.lit(False))


def null_inverted_end(df: DataFrame, start: str, end: str) -> DataFrame:
    """Null an end that comes before its start."""
    return df.withColumn(end, F.when(~inverted(start, end), F.col(end)))


def datable(start: str, end: str, duration: str) -> Column:
    """Whether a missing duration can be told from two dates."""
    return F.col(duration).isNull() & F.col(start).isNotNull() & F.col(end).isNotNull()


def duration_from_dates(df: DataFrame, start: str, end: str, duration: str) -> DataFrame:
    """Fill a missing duration with the days between the two dates."""
    elapsed = days_between(F.col(start), F.col(end))
    return df.withColumn(duration, F.coalesce(F.col(duration), elapsed))


def fix_chronology(df: DataFrame, start: str, end: str, duration: str) -> DataFrame:
    """Drop inverted ends, then fill durations from the dates that remain."""
    return duration_from_dates(null_inverted_end(df, start, end), start, end, duration)
