"""Derived columns: bands, seasons, groups, unit cost, long stays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions.numbers import ratio, round_even
from wardflow.functions.text import lookup
from wardflow.operators.attach import attach
from wardflow.operators.quantiles import quantile


def band(value: Column, bands: Sequence[tuple], top: float, default: str) -> Column:
    """Label of the band holding ``value``; the default outside every band.

    A band runs from its own lowest value up to the next band's, so fractions
    between two bands belong to the lower one; ``top`` closes the last.
    """
    uppers = [low for _, _, low, _ in bands[1:]] + [top]
    label = F.when(value < bands[0][2], default)
    for (_, name, _, _), upper in zip(bands, uppers):
        label = label.when(value < upper, name)
    return label.otherwise(default)


def add_band(df: DataFrame, value: str, bands, top: float, default: str, name: str) -> DataFrame:
    return df.withColumn(name, band(F.col(value), bands, top, default))


def add_month_season(
    df: DataFrame, at: str, seasons: Mapping[int, str], month: str, season: str
) -> DataFrame:
    """Month number of a date and the season it falls in."""
    return df.withColumn(month, F.month(at)).withColumn(season, lookup(F.col(month), seasons))


def members_to_group(groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Turn group -> members into member -> group."""
    return {member: group for group, members in groups.items() for member in members}


def add_group(
    df: DataFrame, label: str, groups: Mapping[str, Sequence[str]], default: str, name: str
) -> DataFrame:
    """Group an official label belongs to."""
    return df.withColumn(
        name, F.coalesce(lookup(F.col(label), members_to_group(groups)), F.lit(default))
    )


def add_unit_cost(df: DataFrame, cost: str, units: str, name: str) -> DataFrame:
    """Cost per unit, without decimals; null when there are no units."""
    return df.withColumn(name, round_even(ratio(F.col(cost), F.col(units))))


def add_long_flag(
    df: DataFrame,
    key: str,
    value: str,
    name: str,
    p: float = 0.9,
    direct_rows: int | None = None,
) -> DataFrame:
    """Whether a value is strictly above its group's quantile."""
    thresholds = quantile(
        df.where(F.col(key).isNotNull()), [key], value, p, "__threshold", direct_rows
    )
    columns = df.columns
    return attach(df, thresholds, [key], computed=True).select(
        *columns,
        F.coalesce(F.col(value) > F.col("__threshold"), F.lit(False)).alias(name),
    )
