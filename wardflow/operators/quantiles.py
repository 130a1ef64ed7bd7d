"""Exact quantiles per group, with linear interpolation.

Rows are first reduced to value counts, with equal values merging before the
shuffle, and the rows are not read again. Durations to one decimal leave a few
hundred counts per group, which are ranked as they are. In a group with many, the
wanted ranks are located first: it is cut into slices whose exact totals tell which one
holds them, that slice is cut again, and so on until it is small enough to be sorted.
Both ways end in the same interpolation, so the value does not depend on which was
taken, and no task sorts more than a set number of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.operators.attach import attach
from wardflow.session import materialise

# Value counts of one group, or of one slice, that a task sorts.
DIRECT_ROWS = 500_000
# Slices a large group is cut into in one round; each holds about 1/256 of its values.
SLICES = 256
# Counts that the cut points of a group are drawn from, for each slice.
DRAWN_PER_SLICE = 20
# Rows that the cut points are drawn from.
CUT_SAMPLE = 500_000


def value_counts_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per key and value in ``__n``, null values included, computed once."""
    return materialise(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")))


def quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    p: float,
    name: str,
    direct_rows: int | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Quantile per key of any numeric column, nulls left out."""
    counts = value_counts_by(df.where(F.col(value).isNotNull()), keys, value)
    return quantile_of_counts(counts, keys, value, p, name, direct_rows, slices)


def quantile_of_counts(
    counts: DataFrame,
    keys: list[str],
    value: str,
    p: float,
    name: str,
    direct_rows: int | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Quantile per key from a computed table of keys, values and ``__n``.

    The result is cheap to run again.
    """
    counts = counts.where(F.col(value).isNotNull())
    # A few values can always be parted, and need not be.
    limit = max(8, DIRECT_ROWS if direct_rows is None else direct_rows)
    if counts.limit(limit + 1).count() <= limit:
        return _direct(counts, keys, value, p, name)
    sizes = counts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__values"), F.sum("__n").alias("__total"))
    large = materialise(sizes.where(F.col("__values") > limit))
    if large.isEmpty():
        return _direct(counts, keys, value, p, name)
    marked = attach(counts, large, keys, null_safe=True, computed=True)
    small = _direct(marked.where(F.col("__total").isNull()), keys, value, p, name)
    rows = marked.where(F.col("__total").isNotNull()).select(
        *keys,
        F.lit("").alias("__path"),
        F.lit(0).cast("bigint").alias("__before"),
        ((F.col("__total") - 1) * F.lit(float(p))).alias("__position"),
        value,
        "__n",
    )
    rows = narrowed(rows, keys, value, limit, slices)
    running = Window.partitionBy(*keys, "__path").orderBy(value)
    placed = rows.select(
        *keys,
        F.col(value).cast("double").alias("__value"),
        "__position",
        (F.col("__before") + F.sum("__n").over(running)).alias("__end"),
        "__n",
    )
    return small.unionByName(materialise(_interpolated(placed, keys, name)))


def _direct(counts: DataFrame, keys: list[str], value: str, p: float, name: str) -> DataFrame:
    up_to, per_key = Window.partitionBy(*keys).orderBy(value), Window.partitionBy(*keys)
    placed = counts.select(
        *keys,
        F.col(value).cast("double").alias("__value"),
        ((F.sum("__n").over(per_key) - 1) * F.lit(float(p))).alias("__position"),
        F.sum("__n").over(up_to).alias("__end"),
        F.col("__n"),
    )
    return _interpolated(placed, keys, name)


def hash_sample(df: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, the same ones each time, chosen by a hash.

    For cut points only: they decide how even the work is, never a result.
    """
    share = min(1.0, rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def slice_of(value: Column, edges: Column, slices: int) -> Column:
    """Number of sorted ``edges`` at or below ``value``, by binary search."""
    steps = []
    step = 1
    while step < slices:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(edges, at + s - 1) <= value, at + s).otherwise(at),
    )


def _sliced(rows: DataFrame, large: DataFrame, spot: list[str], value: str, slices: int) -> DataFrame:
    """``rows`` with the slice each is in; spots that are not ``large`` have one only.

    Cut points are approximate quantiles of a sample of each spot. They decide how even
    the work is, never a result.
    """
    cuts = [i / slices for i in range(1, slices)]
    share = F.lit(float(slices * DRAWN_PER_SLICE)) / F.col("__values")
    drawn = attach(rows, large, spot, null_safe=True, computed=True).where(
        F.pmod(F.xxhash64(*spot, value), F.lit(1 << 30)) < F.least(F.lit(1.0), share) * (1 << 30))
    edges = drawn.groupBy(*spot).agg(
        F.percentile_approx(value, cuts, 10 * slices).alias("__edges"))
    number = F.when(F.col("__edges").isNull(), 0).otherwise(
        slice_of(F.col(value), F.col("__edges"), slices))
    return attach(rows, edges, spot, null_safe=True, cells=slices).withColumn(
        "__slice", number).drop("__edges")


def narrowed(rows: DataFrame, keys: list[str], value: str, limit: int, slices: int) -> DataFrame:
    """What is left of ``rows`` around the wanted ranks, in spots of ``limit`` rows at most.

    A spot is a key and a ``__path`` of slices; ``__before`` is the number of values of the
    key below it. Every round cuts the larger spots and keeps the slices that hold the
    ranks around ``__position``, two for a key at most, so each reads a small part
    of what the one before it read.
    """
    spot = [*keys, "__path"]
    while True:
        sizes = rows.groupBy(*spot).agg(F.count(F.lit(1)).alias("__values"))
        large = materialise(sizes.where(F.col("__values") > limit))
        if large.isEmpty():
            return rows
        sliced = _sliced(rows, large, spot, value, slices)
        # At most ``slices`` rows for a spot.
        totals = sliced.groupBy(*spot, "__slice", "__before", "__position").agg(
            F.sum("__n").alias("__in"))
        end = F.col("__before") + F.sum("__in").over(Window.partitionBy(*spot).orderBy("__slice"))
        low_rank, high_rank = F.floor("__position"), F.ceil("__position")
        ranked = totals.withColumn("__end", end).withColumn("__start", F.col("__end") - F.col("__in"))
        first, last = F.col("__start"), F.col("__end") - 1
        wanted = ranked.where(
            low_rank.between(first, last) | high_rank.between(first, last)
        ).select(*spot, "__slice", "__start")
        kept = attach(sliced, wanted, [*spot, "__slice"], null_safe=True)
        rows = materialise(
            kept.where(F.col("__start").isNotNull()).select(
                *keys,
                F.concat_ws(",", "__path", F.col("__slice").cast("string")).alias("__path"),
                F.col("__start").alias("__before"),
                "__position",
                value,
                "__n",
            )
        )


def _interpolated(placed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The value at ``__position`` among values that end at rank ``__end``."""
    low_rank, high_rank = F.floor("__position"), F.ceil("__position")
    start, end = F.col("__end") - F.col("__n"), F.col("__end") - 1
    at_low = F.max(F.when(low_rank.between(start, end), F.col("__value")))
    at_high = F.max(F.when(high_rank.between(start, end), F.col("__value")))
    fraction = F.max(F.col("__position") - low_rank)
    return placed.groupBy(*keys).agg((at_low + (at_high - at_low) * fraction).alias(name))
