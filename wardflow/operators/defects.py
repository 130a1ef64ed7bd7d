"""Put known defects into a clean table, to test the cleaning on it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions.draws import chosen
from wardflow.functions.numbers import round_even
from wardflow.functions.times import shift_days
from wardflow.operators.attach import attach
from wardflow.session import short_table


@dataclass(frozen=True)
class Defect:
    """Overwrite ``column`` by ``value`` on a share ``rate`` of the rows."""

    column: str
    value: Column
    rate: float
    seed: int


def inject(df: DataFrame, key: str, defects: list[Defect]) -> DataFrame:
    """Apply defects in turn; the rows hit depend on key and seed only."""
    for defect in defects:
        hit = chosen(F.col(key), defect.seed, defect.rate)
        df = df.withColumn(
            defect.column, F.when(hit, defect.value).otherwise(F.col(defect.column))
        )
    return df


def inject_duplicates(df: DataFrame, key: str, rate: float, seed: int) -> DataFrame:
    """Append a second copy of a share of the rows."""
    return df.unionByName(df.where(chosen(F.col(key), seed, rate)))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Put rows in an order that has nothing to do with the key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)


def null_when(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Null a column where the condition holds."""
    return df.withColumn(column, F.when(~F.coalesce(condition, F.lit(False)), F.col(column)))


def add_shifted(df: DataFrame, start: str, days: str, name: str) -> DataFrame:
    """Start plus a fractional number of days."""
    return df.withColumn(name, shift_days(F.col(start), F.col(days)))


def add_expected_cost(
    df: DataFrame, unit: str, days: str, tariff: Mapping[str, tuple[float, float]], name: str
) -> DataFrame:
    """Flat fee plus daily rate times days, rounded to hundreds."""
    rows = [(key, float(flat), float(rate)) for key, (flat, rate) in tariff.items()]
    table = short_table(
        df.sparkSession, rows, {unit: "string", "__flat": "double", "__rate": "double"}
    )
    columns = df.columns
    cost = round_even(F.col("__flat") + F.col("__rate") * F.col(days), -2)
    return attach(df, table, [unit], max_rows=len(rows)).select(*columns, cost.alias(name))
