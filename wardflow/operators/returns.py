"""Time since the previous row of the same key, and early returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardflow.functions.times import days_between
from wardflow.operators.attach import attach
from wardflow.operators.quantiles import CUT_SAMPLE, hash_sample, slice_of
from wardflow.session import materialise

# Rows of one key that a single task sorts without trouble. Keys above it are
# cut along time.
HOT_ROWS = 2_000_000
# Lanes that keys are dealt into to see whether any of them can be hot.
LANES = 1 << 16


def hot_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows; counts merge before the shuffle.

    Rows are counted by lane first, which shuffles a bounded table: only keys in a lane with
    more rows than that can be hot, and where there is none keys are not counted at all.
    """
    rows = df.where(F.col(key).isNotNull()).select(key)
    lane = F.pmod(F.xxhash64(key), F.lit(LANES))
    busy = (
        rows.groupBy(lane.alias("__lane")).agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > limit)
        .select("__lane")
    )
    return (
        rows.join(F.broadcast(busy), lane == F.col("__lane"), "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > limit)
    )


def days_since_previous(
    df: DataFrame,
    key: str,
    at: str,
    order: list[str],
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Days since the key's previous row in time, null for its first.

    ``order`` breaks ties in time and should tell rows apart. Rows without a key or
    a time have no previous row and are spread over the tasks. Of a key above
    ``hot_rows`` only the distinct instants are put in order, in slices of time: the
    first row of an instant looks back to the instant before, the others are 0 days
    behind it.
    """
    columns = df.columns
    hot = materialise(hot_keys(df.where(F.col(at).isNotNull()), key, hot_rows))
    if hot.isEmpty():
        return _lagged(df, key, at, order, name)
    marked = attach(df, hot.select(key, F.lit(True).alias("__hot")), [key], computed=True)
    is_hot = F.col("__hot").isNotNull() & F.col(at).isNotNull()
    rest = _lagged(marked.where(~is_hot).select(*columns), key, at, order, name)
    busy = marked.where(is_hot)
    before = _instants(busy, hot, key, at, order, hot_rows).select(
        F.col(key).alias("__key"), F.col(at).alias("__at"), "__first", "__previous")
    first = F.struct(*order) == F.col("__first")
    elapsed = F.when(first, days_between(F.col("__previous"), F.col(at))).otherwise(F.lit(0.0))
    timed = busy.join(
        before, (F.col(key) == F.col("__key")) & (F.col(at) == F.col("__at"))
    ).select(*columns, elapsed.alias(name))
    return rest.unionByName(timed)


def _lagged(df: DataFrame, key: str, at: str, order: list[str], name: str) -> DataFrame:
    """The delay by one window over each key's rows."""
    loose = F.col(key).isNull() | F.col(at).isNull()
    spread = F.when(loose, F.pmod(F.xxhash64(*order), F.lit(1 << 16)))
    lanes = Window.partitionBy(key, "__spread").orderBy(at, *order)
    elapsed = F.when(~loose, days_between(F.col("__previous"), F.col(at)))
    return (
        df.withColumn("__spread", spread)
        .withColumn("__previous", F.lag(at).over(lanes))
        .select(*df.columns, elapsed.alias(name))
    )


def _instants(
    busy: DataFrame, hot: DataFrame, key: str, at: str, order: list[str], hot_rows: int
) -> DataFrame:
    """Distinct instants of hot keys, each one's first row and the instant before it.

    Written out, so that joining rows to them lets AQE split an instant that very
    many rows share.
    """
    slices = max(2, -(-hot.agg(F.max("__rows")).first()[0] // hot_rows))
    cuts = [i / slices for i in range(1, slices)]
    instants = materialise(
        busy.groupBy(key, at).agg(F.min(F.struct(*order)).alias("__first"))
    )
    edges = materialise(
        hash_sample(instants, [key, at], CUT_SAMPLE).groupBy(key).agg(
            F.percentile_approx(at, cuts, 10 * slices).alias("__edges")
        )
    )
    sliced = attach(instants, edges, [key], cells=slices, computed=True).withColumn(
        "__slice",
        F.when(F.col("__edges").isNull(), 0).otherwise(
            slice_of(F.col(at), F.col("__edges"), slices)),
    )
    # At most ``slices`` rows per hot key.
    last = sliced.groupBy(key, "__slice").agg(F.max(at).alias("__last"))
    in_time = Window.partitionBy(key).orderBy("__slice")
    carry = last.select(key, "__slice", F.lag("__last").over(in_time).alias("__carry"))
    lanes = Window.partitionBy(key, "__slice").orderBy(at)
    previous = F.coalesce(F.lag(at).over(lanes), F.col("__carry"))
    return materialise(
        attach(sliced, carry, [key, "__slice"]).select(
            key, at, "__first", previous.alias("__previous"))
    )


def returned_within(delay: str, days: float):
    """Whether a known, already rounded delay is at most ``days``."""
    return F.coalesce(F.col(delay) <= F.lit(days), F.lit(False))


def flag_returns(
    df: DataFrame,
    key: str,
    at: str,
    order: list[str],
    delay: str,
    flag: str,
    days: float = 30,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the delay since the previous row and the early-return flag."""
    return days_since_previous(df, key, at, order, delay, hot_rows).withColumn(
        flag, returned_within(delay, days)
    )
