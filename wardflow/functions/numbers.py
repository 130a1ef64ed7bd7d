"""Numeric expressions: guarded parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the texts that count as a number. Spark alone would also read
# type suffixes ("1d"), hexadecimal floats and "NaN".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(col: Column) -> Column:
    """Number in a text, null when the text is not one."""
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def round_even(col: Column, digits: int = 0) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour.

    Scaling and ``rint`` stay on primitive doubles, where ``bround`` goes
    through a decimal object for each row. Negative digits round to tens,
    hundreds and so on.
    """
    if digits == 0:
        return F.rint(col)
    if digits < 0:
        return F.rint(col / F.lit(10.0 ** -digits)) * F.lit(10.0 ** -digits)
    return F.rint(col * F.lit(10.0**digits)) / F.lit(10.0**digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
