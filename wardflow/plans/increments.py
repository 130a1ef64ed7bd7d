"""Work that goes on from one load to the next: stable keys, delays, distinct values.

What a load must know of the loads before it is a published table (``sources.versions``),
so a load that dies changes nothing and a named load that is repeated is done once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardflow.operators import returns
from wardflow.operators.profile import distinct_sketches
from wardflow.operators.star import observed_dimension
from wardflow.sources import versions

# Folders that the state of all keys is dealt into; a load rewrites those it has keys of.
BUCKETS = 256


def before_load(spark: SparkSession, path: str, load: str | None) -> dict | None:
    """The newest version that this load did not make."""
    known = versions.current(spark, path)
    if load is None or known is None or known["load"] != load:
        return known
    older = [m for m in versions.manifests(spark, path) if m["load"] != load]
    return older[-1] if older else None


# --- Keys ---------------------------------------------------------------------


def register_keys(
    df: DataFrame, column: str, key: str, registry: str, load: str | None = None
) -> DataFrame:
    """Dimension of all values of ``column`` in this load and all before it.

    The registry is joined first and only ever appended to: a value keeps its key, new
    ones are numbered in their order behind the largest. Null has no key.
    """
    spark = df.sparkSession
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    known = before_load(spark, registry, load)
    if known is None:
        new = observed_dimension(values, column, key)
        kind = new.schema[key].dataType
    else:
        old = versions.read_published(spark, registry, version=known["version"])
        unseen = values.join(
            old.select(F.col(column).alias("__old")), F.col(column) == F.col("__old"), "left_anti")
        kind = old.schema[key].dataType
        last = F.coalesce(old.agg(F.max(key)).scalar(), F.lit(0))
        new = observed_dimension(unseen, column, key).withColumn(key, F.col(key) + last)
    new = new.withColumn(key, F.col(key).cast(kind)).select(key, column)
    return versions.publish(new, registry, how=versions.APPEND, load=load)


# --- Delays -------------------------------------------------------------------


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def delays_of_load(
    df: DataFrame, key: str, at: str, order: list[str], name: str, state: str,
    load: str | None = None, hot_rows: int = returns.HOT_ROWS,
) -> DataFrame:
    """Days since the key's previous row, in this load or any before it.

    ``state`` holds the last row of every key. It enters the load as rows of its own,
    which are dropped behind the delays, and is replaced where the load has keys. Loads must
    follow one another in time: a row before its key's last one raises. The result reads
    the state as it was before the load, so take it before old versions are removed.
    """
    spark = df.sparkSession
    bucket = "__bucket"
    rows = df.withColumn("__old", F.lit(False))
    timed = df.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    last = F.max(F.struct(at, *order))
    newest = timed.groupBy(key).agg(last.alias("__last"))
    known = before_load(spark, state, load)
    if known is not None:
        # At most BUCKETS numbers.
        touched = [r[0] for r in timed.select(bucket_of(key)).distinct().collect()]
        old = versions.read_published(spark, state, touched, known["version"])
        newest = newest.unionByName(old.select(key, "__last")).groupBy(key).agg(
            F.max("__last").alias("__last"))
        rows = rows.unionByName(
            old.select(key, "__last.*", F.lit(True).alias("__old")), allowMissingColumns=True)
    found = returns.days_since_previous(rows, key, at, order, name, hot_rows)
    late = F.raise_error(F.concat(
        F.lit("a row precedes the last load of its key "), F.col(key).cast("string")))
    new = F.when(~F.col("__old"), F.lit(True)).otherwise(
        F.when(F.col(name).isNotNull(), late.cast("boolean")).otherwise(F.lit(False)))
    result = found.where(new).select(*df.columns, name)
    versions.publish(
        newest.withColumn(bucket, bucket_of(key)), state, bucket, versions.PARTITIONS, load)
    return result


# --- Distinct values ----------------------------------------------------------


def add_sketches(df: DataFrame, order: str | None, sketches: str, load: str | None = None) -> DataFrame:
    """Append the sketches of this load's columns to those of the loads before it."""
    return versions.publish(distinct_sketches(df, order), sketches, how=versions.APPEND, load=load)
