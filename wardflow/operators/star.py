"""Star schema: dimensions, facts, referential check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardflow.functions.text import lookup
from wardflow.operators.attach import BROADCAST_ROWS, attach
from wardflow.session import materialise, short_table

UNKNOWN_DATE_KEY = 0


def date_key(at: Column) -> Column:
    """Calendar day as a yyyymmdd integer; 0 stands for no date."""
    return F.coalesce(
        F.year(at) * 10000 + F.month(at) * 100 + F.dayofmonth(at), F.lit(UNKNOWN_DATE_KEY)
    )


def date_dimension(
    df: DataFrame,
    at: str,
    months: Mapping[int, str],
    days: Mapping[int, str],
    seasons: Mapping[int, str],
) -> DataFrame:
    """One row per calendar day that occurs, with its labels."""
    day = F.col("jour")
    weekday = F.weekday(day)
    return (
        df.select(F.to_date(at).alias("jour"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_id"),
            day,
            F.year(day).alias("annee"),
            F.quarter(day).alias("trimestre"),
            F.month(day).alias("mois"),
            lookup(F.month(day), months).alias("libelle_mois"),
            lookup(weekday, days).alias("libelle_jour"),
            (weekday >= 5).alias("week_end"),
            lookup(F.month(day), seasons).alias("saison"),
        )
    )


def list_dimension(
    spark: SparkSession,
    labels: Sequence[str],
    key: str,
    name: str,
    attributes: Mapping[str, tuple[Mapping, str]] | None = None,
) -> DataFrame:
    """Dimension of a reference list: key 1, 2, … in list order.

    ``attributes`` maps a column name to (label -> value, value type).
    """
    attributes = attributes or {}
    unique = list(dict.fromkeys(labels))
    rows = [
        (i, label, *[values.get(label) for values, _ in attributes.values()])
        for i, label in enumerate(unique, start=1)
    ]
    kinds = {column: kind for column, (_, kind) in attributes.items()}
    return short_table(spark, rows, {key: "int", name: "string"} | kinds)


def observed_dimension(df: DataFrame, column: str, key: str) -> DataFrame:
    """Dimension of the values that occur, numbered in their order from 1.

    Values are sorted in ranges, and a range's numbers begin behind the rows of the
    ranges before it, so no task has more than a range. Only the range sizes, one
    row each, are summed up in one place.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = materialise(
        values.repartitionByRange(column)
        .sortWithinPartitions(column)
        .select(
            F.spark_partition_id().alias("__range"),
            # The lower 33 bits number the rows of a range.
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__place"),
            column,
        )
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    numbered = F.col("__start") + F.col("__place") + 1
    return attach(ranged, starts, ["__range"]).select(numbered.alias(key), column)


def with_dimension_key(
    fact: DataFrame,
    dimension: DataFrame,
    natural: str,
    key: str,
    max_rows: int | None = None,
) -> DataFrame:
    """Swap a natural key for the dimension's key."""
    columns = [key if c == natural else c for c in fact.columns]
    side = dimension.select(natural, key)
    return attach(fact, side, [natural], max_rows=max_rows).select(*columns)


def orphans(fact: DataFrame, foreign: str, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with their row counts.

    A null key has no dimension row either and is listed as null.

    Facts are counted per key before the join, so a hot key is one row. An
    anti join would be moved below the counting.
    """
    used = fact.groupBy(F.col(foreign).alias("cle")).agg(F.count(F.lit(1)).alias("lignes"))
    known = dimension.select(F.col(key).alias("__key"))
    return (
        used.join(known, F.col("cle") == F.col("__key"), "left")
        .where(F.col("__key").isNull())
        .drop("__key")
    )


def orphans_by_words(fact: DataFrame, foreign: str, dimension: DataFrame, key: str) -> DataFrame:
    """As :func:`orphans`, for whole-number keys, shuffling orphans only.

    The dimension's keys are kept as the bits of numbers, 64 neighbouring keys in one row.
    These rows are counted and then broadcast, so a fact's key is looked up exactly where
    it is read, and sound facts go no further. Dimensions with too many such rows
    take the way of :func:`orphans`.
    """
    keys = F.col(key).cast("bigint")
    words = materialise(
        dimension.where(F.col(key).isNotNull())
        .groupBy(F.shiftright(keys, 6).alias("__word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(cast(`{key}` as bigint) & 63 as int))")).alias("__bits"))
    )
    if words.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return orphans(fact, foreign, dimension, key)
    cle = F.col("cle").cast("bigint")
    place = cle.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    known = F.coalesce(F.getbit(F.col("__bits"), place) == 1, F.lit(False))
    return (
        fact.select(F.col(foreign).alias("cle"))
        .join(F.broadcast(words), F.shiftright(cle, 6) == F.col("__word"), "left")
        .where(~known)
        .groupBy("cle").agg(F.count(F.lit(1)).alias("lignes"))
    )


def orphan_report(
    fact: DataFrame, links: Mapping[str, tuple[DataFrame, str]], find=orphans
) -> DataFrame:
    """Orphaned keys and rows per foreign key; all zero when sound.

    Rows with a null key are orphaned, but null is not counted as a key. ``find`` is
    :func:`orphans` or :func:`orphans_by_words`.
    """
    reports = [
        find(fact, foreign, dimension, key).agg(
            F.lit(foreign).alias("cle_etrangere"),
            F.count("cle").alias("cles_orphelines"),
            F.coalesce(F.sum("lignes"), F.lit(0)).alias("lignes_orphelines"),
        )
        for foreign, (dimension, key) in links.items()
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
