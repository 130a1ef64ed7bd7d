"""Table and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardflow.functions.numbers import ratio, round_even
from wardflow.operators.attach import attach
from wardflow.operators.dedup import digest

# Names of the profile's columns (fixed values).
TYPE, PRESENT, MISSING, MISSING_RATE, DISTINCT, EXAMPLE = (
    "type", "valeurs_non_nulles", "valeurs_manquantes", "taux_manquant_%",
    "valeurs_distinctes", "exemple",
)


def _content(df: DataFrame, order: str | None) -> list[T.StructField]:
    return [field for field in df.schema.fields if field.name != order]


def _text(field: T.StructField) -> Column:
    """Cell as text; minus zero and zero are one value."""
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(field.dataType)
    return value.cast("string")


def column_profile(df: DataFrame, order: str, approx: bool = False) -> DataFrame:
    """Per column: type, present and missing cells, distinct values, example.

    The example is the first present value in ``order``. One scan gives it and the
    counts of cells; another turns cells into (column, value) pairs, long values as
    digests, which merge before the shuffle, so a column with few values costs next to
    nothing. With ``approx`` distinct values are estimated and no value is shuffled.
    """
    fields = _content(df, order)
    counts = _one_pass(df, order, fields, approx)
    if approx:
        return _described(counts, fields)
    cells = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("__col"), _short(_text(field)).alias("__value"))
                    for i, field in enumerate(fields)
                ]
            )
        ),
    )
    values = cells.where(F.col("__value").isNotNull()).distinct().groupBy("__col").agg(
        F.count(F.lit(1)).alias("__values"))
    found = attach(counts, values, ["__col"], max_rows=len(fields))
    return _described(
        found.withColumn(DISTINCT, F.coalesce(F.col("__values"), F.lit(0))), fields)


def _short(text: Column) -> Column:
    """A text as it is, or its digest where that is shorter."""
    return F.when(F.length(text) > 64, F.sha2(text, 256)).otherwise(text)


def _one_pass(df: DataFrame, order: str, fields, approx: bool) -> DataFrame:
    """One row per column, out of one aggregation without keys."""
    rows = []
    for i, field in enumerate(fields):
        cell = F.col(field.name)
        first = F.min_by(_text(field), F.when(cell.isNotNull(), F.col(order)))
        parts = [
            F.lit(i).alias("__col"),
            first.alias(EXAMPLE),
            F.count(cell).alias(PRESENT),
            F.count_if(cell.isNull()).alias(MISSING),
        ]
        if approx:
            parts.append(F.approx_count_distinct(_text(field)).alias(DISTINCT))
        rows.append(F.struct(*parts))
    return df.agg(F.array(*rows).alias("__all")).select(F.inline("__all"))


def _described(per_column: DataFrame, fields) -> DataFrame:
    names = F.array(*[F.lit(field.name) for field in fields])
    types = F.array(*[F.lit(field.dataType.simpleString()) for field in fields])
    rows = F.col(PRESENT) + F.col(MISSING)
    return per_column.select(
        F.get(names, F.col("__col")).alias("colonne"),
        F.get(types, F.col("__col")).alias(TYPE),
        PRESENT,
        MISSING,
        round_even(F.col(MISSING) / rows * 100, 2).alias(MISSING_RATE),
        DISTINCT,
        EXAMPLE,
    )


def audit_summary(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row: size, strict duplicates, repeated keys, missing cells.

    A raw file is read once, and its rows are shuffled as two digests and two counts.
    """
    names = [field.name for field in _content(df, order)]
    gaps = sum((F.col(name).isNull().cast("int") for name in names), F.lit(0))
    distinct_rows = df.groupBy(digest(df, key).alias("__key"), digest(df, *names).alias("__whole")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(gaps).alias("__gaps"))
    per_key = distinct_rows.groupBy("__key").agg(
        F.sum("__n").alias("__n"),
        F.sum(F.col("__n") - 1).alias("__copies"),
        F.sum("__gaps").alias("__gaps"),
    )
    rows = F.coalesce(F.sum("__n"), F.lit(0))
    missing = F.coalesce(F.sum("__gaps"), F.lit(0))
    return per_key.agg(
        rows.alias("lignes"),
        F.lit(len(names)).alias("colonnes"),
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("doublons_stricts"),
        (rows - F.count(F.lit(1))).alias(f"{key}_dupliques"),
        missing.alias("cellules_manquantes"),
        round_even(ratio(missing, rows * len(names)) * 100, 2).alias("taux_manquant_global_%"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("effectif"))
        .orderBy(F.desc("effectif"), column)
    )


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, null excluded."""
    return df.agg(F.count_distinct(column).alias("valeurs_distinctes"))


def head(df: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows in file order, without the order column."""
    return df.orderBy(order).limit(n).drop(order)


# 2 ** 12 places: a relative standard error of 1.63 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, order: str | None = None) -> DataFrame:
    """Per column a HyperLogLog sketch of its present values, for :func:`united_distinct`.

    Sketches are a few kilobytes, whatever the table's size, and are merged like sums:
    one scan, and nothing but sketches is shuffled.
    """
    fields = _content(df, order)
    sketches = F.array(*[
        F.struct(
            F.lit(field.name).alias("colonne"),
            F.hll_sketch_agg(_text(field), F.lit(SKETCH_BITS)).alias("esquisse"))
        for field in fields
    ])
    return df.agg(sketches.alias("__all")).select(F.inline("__all"))


def united_distinct(sketches: DataFrame) -> DataFrame:
    """Estimated distinct values per column of all tables that ``sketches`` are of."""
    return sketches.groupBy("colonne").agg(
        F.hll_sketch_estimate(F.hll_union_agg("esquisse")).alias(DISTINCT))


def dataset_summary(df: DataFrame, distinct: list[str], at: str) -> DataFrame:
    """One row: rows, first and last date, distinct values of some columns.

    Each distinct count reads its own column; in one aggregation every row would be
    repeated for each of them.
    """
    found = df.agg(
        F.count(F.lit(1)).alias("lignes"), F.min(at).alias("debut"), F.max(at).alias("fin"))
    return found.withColumns(
        {f"{c}_distincts": distinct_count(df, c).scalar() for c in distinct})
