"""Quality rules, evaluated together in one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.operators.dedup import repeated
from wardflow.session import short_table

REPORT_COLUMNS = {
    "regle": "string", "violations": "bigint", "statut": "string", "criticite": "string",
    "message": "string",
}

# Wording of the report.
OK, FAILED, WARNED = "OK", "ÉCHEC", "AVERTISSEMENT"
BLOCKING, INFORMATIVE = "bloquante", "informative"


@dataclass(frozen=True)
class Rule:
    """A named check.

    ``violations`` is an aggregate giving the number of faults or, for checks
    that group rows, a function from the table to a table of that one number.
    """

    name: str
    violations: Column | Callable[[DataFrame], DataFrame]
    message: str
    blocking: bool = False


def repeats(key: str) -> Callable[[DataFrame], DataFrame]:
    """Rows beyond the first of each key."""
    return lambda df: repeated(df, [key])


def column_left(df: DataFrame, columns: Sequence[str]) -> Column:
    """One when any of the columns is in the table; a check of the schema."""
    found = F.lit(int(any(c in df.columns for c in columns)))
    return F.coalesce(F.max(found), found)


def out_of_range(column: str, low: float, high: float) -> Column:
    return F.count_if(~F.col(column).between(low, high))


def not_positive(column: str) -> Column:
    """Missing values are faults too."""
    return F.count_if(F.col(column).isNull() | (F.col(column) <= 0))


def before(end: str, start: str) -> Column:
    return F.count_if(F.col(end) < F.col(start))


def not_listed(column: str, allowed: Sequence[str]) -> Column:
    """Missing values are faults too."""
    return F.count_if(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def equal_to(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


@dataclass(frozen=True)
class MoreValuesThan:
    """Distinct values in excess of the reference list's length."""

    column: str
    allowed: int

    def __call__(self, df: DataFrame) -> DataFrame:
        excess = F.greatest(F.count_distinct(self.column) - F.lit(self.allowed), F.lit(0))
        return df.agg(excess.alias("excess"))


def _value_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One map: place of each column, number of its distinct values.

    All columns share one scan and one grouping of (column, value) pairs.
    """
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("__col"), F.col(c).cast("string").alias("__value"))
        for i, c in enumerate(columns)
    ])))
    numbers = (
        cells.where(F.col("__value").isNotNull()).distinct()
        .groupBy("__col").agg(F.count(F.lit(1)).alias("__n"))
    )
    return numbers.agg(F.map_from_entries(F.collect_list(F.struct("__col", "__n"))))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: faults, status, criticality, message.

    All plain counts come out of one aggregation that shuffles nothing but its
    totals. A check that groups rows is counted apart, on its own column: in
    the same aggregation every other count would be shuffled along with it.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[
            F.coalesce(rule.violations, F.lit(0)).cast("bigint").alias(f"__r{i}")
            for i, rule in enumerate(rules)
            if not callable(rule.violations)
        ],
    )
    listed = [rule.violations for rule in rules if isinstance(rule.violations, MoreValuesThan)]
    if listed:
        columns = list(dict.fromkeys(check.column for check in listed))
        counts = counts.withColumn("__values", _value_numbers(df, columns).scalar())
    for i, rule in enumerate(rules):
        if isinstance(rule.violations, MoreValuesThan):
            found = F.try_element_at("__values", F.lit(columns.index(rule.violations.column)))
            excess = F.coalesce(found, F.lit(0)) - F.lit(rule.violations.allowed)
            counts = counts.withColumn(f"__r{i}", F.greatest(excess, F.lit(0)).cast("bigint"))
        elif callable(rule.violations):
            counts = counts.withColumn(f"__r{i}", rule.violations(df).scalar())
    rows = []
    for i, rule in enumerate(rules):
        faults = F.col(f"__r{i}")
        clean = faults == 0
        rows.append(
            F.struct(
                F.lit(rule.name).alias("regle"),
                faults.alias("violations"),
                F.when(clean, OK)
                .otherwise(FAILED if rule.blocking else WARNED)
                .alias("statut"),
                F.lit(BLOCKING if rule.blocking else INFORMATIVE).alias("criticite"),
                F.when(clean, "")
                .otherwise(F.replace(F.lit(rule.message), F.lit("{n}"), faults.cast("string")))
                .alias("message"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame, blocking: bool = True) -> DataFrame:
    """Run the report once; raise when a blocking rule failed.

    The report has one row per rule, so it is brought to the driver.
    """
    rows = report.collect()
    failed = [row for row in rows if row.statut == FAILED]
    if failed and blocking:
        details = "\n".join(f"  - {row.regle}: {row.message}" for row in failed)
        raise ValueError(f"{len(failed)} blocking quality rule(s) failed:\n{details}")
    return short_table(report.sparkSession, rows, REPORT_COLUMNS)


def refusals(report: DataFrame) -> DataFrame:
    """The blocking rules for which a load is refused, with their faults."""
    return report.where(F.col("statut") == FAILED).select("regle", "violations", "message")


def passed(report: DataFrame) -> DataFrame:
    """Number of rules met, out of how many."""
    return report.agg(
        F.count_if(F.col("statut") == OK).alias("regles_satisfaites"),
        F.count(F.lit(1)).alias("regles"),
    )


def domain_rules(domains: Mapping[str, Sequence[str]]) -> list[Rule]:
    """Informative rules: values outside a column's code list."""
    return [
        Rule(
            f"Domaine de {column}",
            not_listed(column, allowed),
            "{n} valeurs hors liste.",
        )
        for column, allowed in domains.items()
    ]


def modality_rules(sizes: Mapping[str, int]) -> list[Rule]:
    """Informative rules: more distinct values than the reference list has."""
    return [
        Rule(
            f"Modalités de {column}",
            MoreValuesThan(column, size),
            "{n} modalités de trop.",
        )
        for column, size in sizes.items()
    ]
