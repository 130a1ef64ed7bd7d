"""Fill missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.functions.times import whole_years
from wardflow.operators.attach import attach
from wardflow.operators.quantiles import quantile_of_counts, value_counts_by
from wardflow.session import materialise


def group_medians(
    df: DataFrame, key: str, value: str, direct_rows: int | None = None
) -> DataFrame:
    """Fill value per key: its exact median, or the overall median.

    The overall median is taken over the column as the group medians leave it.
    It serves keys whose values are all missing and the null key, which is no
    group, and is looked for only when there are such rows. Everything comes
    from one table of value counts, so the rows are read once.
    """
    counts = value_counts_by(df, [key], value)
    present = counts.where(F.col(value).isNotNull())
    grouped = present.where(F.col(key).isNotNull())
    medians = materialise(
        quantile_of_counts(grouped, [key], value, 0.5, "__fill", direct_rows)
    )
    # One row per key with missing values.
    gaps = counts.where(F.col(value).isNull()).select(key, "__n")
    gaps = materialise(attach(gaps, medians, [key], computed=True))
    left_over = gaps.where(F.col("__fill").isNull())
    if left_over.isEmpty():
        return medians
    fills = gaps.where(F.col("__fill").isNotNull()).select("__fill", "__n")
    filled = (
        present.select(F.col(value).alias("__fill"), "__n")
        .unionByName(fills)
        .groupBy(F.lit(0).alias("__all"), "__fill")
        .agg(F.sum("__n").alias("__n"))
    )
    overall = quantile_of_counts(
        materialise(filled), ["__all"], "__fill", 0.5, "__overall", direct_rows
    )
    return medians.unionByName(
        left_over.select(key, overall.select("__overall").scalar().alias("__fill"))
    )


def impute_group_median(
    df: DataFrame,
    key: str,
    value: str,
    flag: str | None = None,
    direct_rows: int | None = None,
) -> DataFrame:
    """Fill a missing value with its group's median.

    ``flag`` names a column that marks the filled rows. The medians are computed
    and counted before they are broadcast.
    """
    medians = group_medians(df, key, value, direct_rows)
    columns = df.columns
    filled = attach(df, medians, [key], null_safe=True, computed=True)
    if flag:
        filled = filled.withColumn(flag, F.col(value).isNull())
        columns = [*columns, flag]
    return filled.withColumn(value, F.coalesce(value, "__fill")).select(*columns)


def age_from_birth(df: DataFrame, age: str, birth: str, at: str) -> DataFrame:
    """Fill a missing age with the whole years between birth and ``at``."""
    return df.withColumn(age, F.coalesce(F.col(age), whole_years(F.col(birth), F.col(at))))
