"""Free text to official labels."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions.text import MAX_INLINE_KEYS, is_normal, lookup_label, normalise
from wardflow.operators.attach import attach
from wardflow.session import short_table


@dataclass(frozen=True)
class LabelRule:
    """How one column is brought to its reference list."""

    column: str
    labels: Mapping[str, str]
    default: str


def unmatched(rule: LabelRule) -> Column:
    """Whether a raw cell matches no label of its list."""
    return lookup_label(F.col(rule.column), rule.labels).isNull()


def normalise_labels(df: DataFrame, rules: list[LabelRule]) -> DataFrame:
    """Replace each ruled column by its official label or the default.

    Run once per table: an official label with accents is not itself a key of
    its list, and a second run would turn it into the default.
    """
    short = [rule for rule in rules if len(rule.labels) <= MAX_INLINE_KEYS]
    df = df.withColumns(
        {
            rule.column: F.coalesce(
                lookup_label(F.col(rule.column), rule.labels), F.lit(rule.default)
            )
            for rule in short
        }
    )
    for rule in rules:
        if len(rule.labels) > MAX_INLINE_KEYS:
            df = _join_labels(df, rule)
    return df


def _join_labels(df: DataFrame, rule: LabelRule) -> DataFrame:
    pairs = [(key, label) for key, label in rule.labels.items() if is_normal(key)]
    table = short_table(df.sparkSession, pairs, {"__text": "string", "__label": "string"})
    columns = df.columns
    return (
        attach(
            df.withColumn("__text", normalise(F.col(rule.column))),
            table,
            ["__text"],
            max_rows=len(pairs),
        )
        .withColumn(rule.column, F.coalesce("__label", F.lit(rule.default)))
        .select(*columns)
    )


def spelling_variants(df: DataFrame, column: str) -> DataFrame:
    """Raw spellings that share a normal form, with their row counts."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("graphie"))
        .agg(F.count(F.lit(1)).alias("lignes"))
        .select(normalise(F.col("graphie")).alias("libelle"), "graphie", "lignes")
    )


def variants_of(df: DataFrame, column: str, label: str) -> DataFrame:
    """Distinct raw spellings of one label."""
    return (
        df.where(normalise(F.col(column)) == F.lit(label))
        .select(F.col(column).alias("graphie"))
        .distinct()
    )


def variant_counts(df: DataFrame, column: str) -> DataFrame:
    """Per normal form: number of raw spellings and of rows."""
    return (
        spelling_variants(df, column)
        .groupBy("libelle")
        .agg(F.count(F.lit(1)).alias("graphies"), F.sum("lignes").alias("lignes"))
    )


def recode(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """Replace the listed values of one column, leave the others."""
    return df.replace(dict(values), subset=[column])
