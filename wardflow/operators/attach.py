"""Bring a small table's columns to every row of a large one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.session import materialise

# A table of at most this many short rows is a few megabytes on each executor,
# and this many numbers in array cells are 32 MB.
BROADCAST_ROWS = 100_000
BROADCAST_CELLS = 4_000_000


def sized_for_broadcast(
    small: DataFrame, max_rows: int | None = None, cells: int = 1, computed: bool = False
) -> DataFrame:
    """Return ``small``, marked for broadcast only when its size is known.

    ``max_rows`` is a bound the caller can prove (say, the size of the label
    list the keys come from). Without one the table is computed once, counted,
    and left to an ordinary join when it is too long; ``computed`` says that
    this was done already. ``cells`` is the length of the array a row carries.
    """
    limit = min(BROADCAST_ROWS, BROADCAST_CELLS // cells)
    if max_rows is None:
        small = small if computed else materialise(small)
        max_rows = small.limit(limit + 1).count()
    return F.broadcast(small) if max_rows <= limit else small


def attach(
    df: DataFrame,
    small: DataFrame,
    keys: list[str],
    max_rows: int | None = None,
    null_safe: bool = False,
    cells: int = 1,
    computed: bool = False,
) -> DataFrame:
    """Left join ``small`` on ``keys``; every row of ``df`` is kept once.

    ``small`` holds one row per key. With ``null_safe`` a null key finds the
    null key's row.
    """
    renamed = small.withColumnsRenamed({key: f"__{key}" for key in keys})
    side = sized_for_broadcast(renamed, max_rows, cells, computed)
    match = [
        F.col(key).eqNullSafe(F.col(f"__{key}"))
        if null_safe
        else F.col(key) == F.col(f"__{key}")
        for key in keys
    ]
    return df.join(side, match, "left").drop(*[f"__{key}" for key in keys])
