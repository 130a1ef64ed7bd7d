"""Summary tables: occupancy, burden, seasonality, crossings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wardflow.functions.numbers import ratio, round_even
from wardflow.operators.attach import attach
from wardflow.operators.quantiles import quantile_of_counts
from wardflow.session import materialise, short_table


def bed_days(df: DataFrame, unit: str, start: str, end: str) -> DataFrame:
    """Bed-days per unit and calendar month.

    A stay occupies each day from entry up to the day before exit, one day at
    least. It is cut into the months it crosses rather than into its days, so
    a row gives a few rows at most; sums merge before the shuffle.
    """
    first = F.to_date(start)
    last = F.greatest(first, F.date_sub(F.to_date(end), 1))
    stays = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        F.col(unit), first.alias("__first"), last.alias("__last")
    )
    months = F.sequence(
        F.trunc("__first", "month"), F.trunc("__last", "month"), F.expr("interval 1 month")
    )
    days = (
        F.datediff(
            F.least(F.col("__last"), F.last_day("mois_debut")),
            F.greatest(F.col("__first"), F.col("mois_debut")),
        )
        + 1
    )
    return (
        stays.select(unit, "__first", "__last", F.explode(months).alias("mois_debut"))
        .groupBy(unit, "mois_debut")
        .agg(F.sum(days).alias("journees_lit"))
    )


def _every_month(monthly: DataFrame, key: str, value: str) -> DataFrame:
    """Fill the months between a key's first and last ``mois_debut`` with zero.

    A key has one row per calendar month, so its months fit an array.
    """
    months = F.sequence("__first", "__last", F.expr("interval 1 month"))
    return (
        monthly.groupBy(key)
        .agg(
            F.min("mois_debut").alias("__first"),
            F.max("mois_debut").alias("__last"),
            F.map_from_entries(F.collect_list(F.struct("mois_debut", value))).alias("__known"),
        )
        .select(key, "__known", F.explode(months).alias("mois_debut"))
        .select(
            key,
            "mois_debut",
            F.coalesce(F.try_element_at("__known", F.col("mois_debut")), F.lit(0)).alias(value),
        )
    )


def occupancy(
    df: DataFrame, unit: str, start: str, end: str, beds: Mapping[str, int]
) -> DataFrame:
    """Occupancy rate per unit and month: bed-days over available bed-days.

    Every month from a unit's first to its last is there, empty ones with zero. Stays
    without an exit are in no month, as their days are not known.
    """
    capacity = short_table(df.sparkSession, list(beds.items()), {unit: "string", "lits": "int"})
    used = _every_month(bed_days(df, unit, start, end), unit, "journees_lit")
    used = attach(used, capacity, [unit], max_rows=len(beds))
    available = F.col("lits") * F.dayofmonth(F.last_day("mois_debut"))
    return used.select(
        unit,
        F.year("mois_debut").alias("annee"),
        F.month("mois_debut").alias("mois"),
        "journees_lit",
        "lits",
        round_even(ratio(F.col("journees_lit"), available) * 100, 2).alias("taux_occupation"),
    )


def daily_census(df: DataFrame, unit: str, start: str, end: str) -> DataFrame:
    """Most and fewest beds in use on a day, per unit and month, and the bed-days.

    A stay adds one on its first day and takes it away behind its last (see
    :func:`bed_days`); such changes are summed up per unit and day, and their running sum
    holds until the next change. Stays are never turned into days, and a unit has one row
    per day with a change at most, so its running sum fits a task however many stays it
    has. Every day counts, of every month from a unit's first to its last.
    """
    first = F.to_date(start)
    last = F.greatest(first, F.date_sub(F.to_date(end), 1))
    stays = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        F.col(unit), first.alias("__first"), F.date_add(last, 1).alias("__after"))
    changes = F.array(
        F.struct(F.col("__first").alias("__day"), F.lit(1).alias("__change")),
        F.struct(F.col("__after").alias("__day"), F.lit(-1).alias("__change")),
    )
    events = stays.select(unit, F.inline(changes)).groupBy(unit, "__day").agg(
        F.sum("__change").alias("__change"))
    # Days without a stay at both ends belong to their months, too.
    ends = events.groupBy(unit).agg(
        F.trunc(F.min("__day"), "month").alias("__low"),
        F.add_months(F.trunc(F.date_sub(F.max("__day"), 1), "month"), 1).alias("__high"),
    ).select(unit, F.explode(F.array("__low", "__high")).alias("__day"), F.lit(0).cast("bigint").alias("__change"))
    in_time = Window.partitionBy(unit).orderBy("__day")
    spans = (
        events.unionByName(ends).groupBy(unit, "__day").agg(F.sum("__change").alias("__change"))
        .select(
            unit, "__day", F.sum("__change").over(in_time).alias("__beds"),
            F.date_sub(F.lead("__day").over(in_time), 1).alias("__until"))
        .where(F.col("__until").isNotNull())
    )
    months = F.sequence(
        F.trunc("__day", "month"), F.trunc("__until", "month"), F.expr("interval 1 month"))
    days = F.datediff(
        F.least(F.col("__until"), F.last_day("mois_debut")),
        F.greatest(F.col("__day"), F.col("mois_debut"))) + 1
    return (
        spans.select(unit, "__day", "__until", "__beds", F.explode(months).alias("mois_debut"))
        .groupBy(unit, "mois_debut")
        .agg(
            F.max("__beds").alias("lits_max"), F.min("__beds").alias("lits_min"),
            F.sum(F.col("__beds") * days).alias("journees_lit"))
        .select(
            unit, F.year("mois_debut").alias("annee"), F.month("mois_debut").alias("mois"),
            "lits_max", "lits_min", "journees_lit")
    )


def burden(
    df: DataFrame,
    label: str,
    duration: str,
    cost: str,
    outcome: str,
    death: str,
    direct_rows: int | None = None,
) -> DataFrame:
    """Per label: stays, share, deaths, lethality, durations, total cost.

    One table per label and duration, read from the rows in a single pass,
    gives every figure.
    """
    by_duration = materialise(
        df.groupBy(label, duration).agg(
            F.count(F.lit(1)).alias("__n"),
            F.count_if(F.col(outcome) == death).alias("__deaths"),
            F.sum(cost).alias("__cost"),
        )
    )
    known = F.when(F.col(duration).isNotNull(), F.col("__n"))
    groups = by_duration.groupBy(label).agg(
        F.sum("__n").alias("sejours"),
        F.sum("__deaths").alias("deces"),
        ratio(F.sum(F.col(duration) * known), F.sum(known)).alias("__mean"),
        F.sum("__cost").alias("__cost"),
    )
    medians = quantile_of_counts(
        by_duration.select(label, duration, "__n"), [label], duration, 0.5, "__median",
        direct_rows,
    )
    everything = by_duration.agg(F.sum("__n")).scalar()
    return attach(groups, medians, [label], null_safe=True, computed=True).select(
        label,
        "sejours",
        round_even(ratio(F.col("sejours"), everything) * 100, 2).alias("part_pct"),
        "deces",
        round_even(ratio(F.col("deces"), F.col("sejours")) * 100, 2).alias("letalite_pct"),
        round_even(F.col("__mean"), 2).alias("duree_moyenne"),
        round_even(F.col("__median"), 2).alias("duree_mediane"),
        round_even(F.col("__cost")).alias("cout_total"),
    )


def seasonality(df: DataFrame, at: str, label: str) -> DataFrame:
    """Monthly counts per label, against its mean month and a year earlier.

    Every month from a label's first to its last counts, empty ones as zero.
    """
    monthly = (
        df.where(F.col(at).isNotNull())
        .groupBy(label, F.trunc(at, "month").alias("mois_debut"))
        .agg(F.count(F.lit(1)).alias("sejours"))
    )
    full = _every_month(monthly, label, "sejours")
    months = F.year("mois_debut") * 12 + F.month("mois_debut")
    # A few hundred rows per label from here on.
    per_label = Window.partitionBy(label)
    year_before = per_label.orderBy(months).rangeBetween(-12, -12)
    earlier = F.first("sejours").over(year_before)
    return full.select(
        label,
        F.year("mois_debut").alias("annee"),
        F.month("mois_debut").alias("mois"),
        "sejours",
        round_even(F.col("sejours") / F.avg("sejours").over(per_label), 3).alias(
            "indice_saisonnier"
        ),
        earlier.alias("sejours_an_passe"),
        round_even(ratio(F.col("sejours") - earlier, earlier) * 100, 2).alias("evolution_pct"),
    )


def crossing(
    df: DataFrame, row: str, column: str, values: Sequence[str], other: str = "autres"
) -> DataFrame:
    """Counts of ``row`` values against the listed ``column`` values.

    ``other`` counts all that is not listed, nulls among it, so the columns of a row
    add up to its rows.
    """
    is_listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == v).alias(v) for v in values],
        F.count_if(~is_listed).alias(other),
    )


def crossing_totals(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts per pair with both margins and the grand total.

    ``niveau`` is 0 for a pair, 1 for a row total, 2 for a column total, 3 for
    the grand total. Pairs are counted first, so the cube works on them alone.
    """
    pairs = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("__n"))
    return pairs.cube(row, column).agg(
        F.grouping_id().cast("int").alias("niveau"), F.sum("__n").alias("sejours")
    )
