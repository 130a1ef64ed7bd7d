"""The admission run, from raw rows to checked and loaded tables.

Each of the three tables below is written once and read by the next step, so
the statistics a step needs never recompute the shuffles before it, and a lost
executor costs one step's tasks at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wardflow import reference as ref
from wardflow.operators import dedup, impute, labels, privacy, quality, returns, values
from wardflow.plans import admissions
from wardflow.plans.journal import Journal
from wardflow.plans.ledger import Ledger, fingerprint
from wardflow.session import work_path
from wardflow.sources.csvfile import ORDER
from wardflow.sources.tables import load_checked, load_partitions

DURATION, AGE = "duree_sejour_j", "age"


@dataclass
class Run:
    """What a run leaves behind."""

    prepared: DataFrame
    journal: DataFrame
    audit: DataFrame
    report: DataFrame


OUT = {c: f"out_{c}" for c in ref.BOUNDS}


def _steps(journal: Journal, source: str) -> None:
    """The steps of the journal, in order."""
    journal.step("read", "read", "read", lambda m: {"source": source})
    journal.step(
        "duplicates",
        "read",
        "staged",
        lambda m: {"exact": m["read"] - m["distinct"], "keys": m["distinct"] - m["staged"]},
    )
    journal.step("labels", "staged", "staged")
    journal.step("types", "staged", "staged")
    journal.step(
        "outliers",
        "staged",
        "staged",
        lambda m: [{"column": c, "n": m[name]} for c, name in OUT.items() if m[name]],
    )
    journal.step("dates", "staged", "staged")
    journal.step("imputation", "staged", "filled")


def _stage(raw: DataFrame, order: str, journal: Journal) -> DataFrame:
    """Duplicates out, labels and types in, implausible values nulled.

    Each repair leaves a mark, and one observation at the end, where the rows
    are written, counts them all.
    """
    df = dedup.deduplicate_counted(raw, ["id_admission"], order, "__read", "__distinct")
    df = df.drop(order)
    columns = [c for c in raw.columns if c != order]

    diagnosis = next(rule for rule in admissions.LABEL_RULES if rule.column == "pathologie")
    df = df.withColumn("__unmatched", labels.unmatched(diagnosis))
    df = df.transform(admissions.normaliser_textes)
    df = df.transform(admissions.corriger_types)
    df = df.withColumns(
        {f"__{name}": values.outside(c, *ref.BOUNDS[c]) for c, name in OUT.items()}
    ).transform(admissions.traiter_aberrations)

    start, end, duration = admissions.STAY
    df = df.withColumn("__inverted", values.inverted(start, end))
    df = values.null_inverted_end(df, start, end)
    df = df.withColumn("__dated", values.datable(start, end, duration))
    df = values.duration_from_dates(df, start, end, duration)

    marks = ["unmatched", *OUT.values(), "inverted", "dated"]
    return journal.watch(
        df,
        read=F.coalesce(F.sum("__read"), F.lit(0)),
        distinct=F.coalesce(F.sum("__distinct"), F.lit(0)),
        staged=F.count(F.lit(1)),
        **{mark: F.count_if(F.col(f"__{mark}")) for mark in marks},
    ).select(*columns)


def _impute(staged: DataFrame, journal: Journal) -> DataFrame:
    """Durations and ages filled; both fills counted on the way."""
    filled = impute.impute_group_median(
        staged, "pathologie", DURATION, flag="duree_imputee"
    )
    columns = filled.columns
    dated = F.col(AGE).isNull() & F.col(ref.BIRTH_DATE).isNotNull()
    filled = impute.age_from_birth(
        filled.withColumn("__aged", dated), AGE, ref.BIRTH_DATE, "date_entree"
    )
    return journal.watch(
        filled,
        filled=F.count(F.lit(1)),
        imputed=F.count_if(F.col("duree_imputee")),
        aged=F.count_if(F.col("__aged")),
    ).select(*columns)


def run(
    raw: DataFrame,
    salt: str | None = None,
    order: str = ORDER,
    folder: str | None = None,
    source: str = "",
    missing_text: str | None = None,
    hot_rows: int = returns.HOT_ROWS,
    resume: bool = False,
) -> Run:
    """Clean, pseudonymise, check, enrich and report on raw admissions.

    ``folder`` must be reachable by every executor; by default it is a new one
    in the cluster's shared folder. With ``resume`` a run goes on from the last step that
    one with the same input files and parameters has finished in the same folder, see
    ``plans.ledger``. The report is evaluated, not enforced: see :func:`load`.
    """
    spark = raw.sparkSession
    salt = admissions.sel_requis(salt)
    folder = folder or work_path(spark, "run")
    journal = Journal(ref.JOURNAL)
    _steps(journal, source)
    run_id = fingerprint(raw, salt=salt, order=order, missing=missing_text) if resume else None
    ledger = Ledger(spark, folder, run_id, journal)

    def clean() -> DataFrame:
        masked = admissions.masquer(_impute(staged, journal), salt, missing_text)
        admissions.verifier_absence_donnees_personnelles(masked)
        return masked

    def prepare() -> DataFrame:
        enriched = admissions.enrichir(cleaned, lignes_chaudes=hot_rows)
        return enriched.select(*ref.PREPARED_COLUMNS)

    staged = ledger.step("staged", lambda: _stage(raw, order, journal))
    cleaned = ledger.step("cleaned", clean)

    entries = journal.table(spark)
    audit = privacy.treatment_audit(
        staged,
        ref.PATIENT_ID,
        ref.DIRECT_IDENTIFIERS,
        ref.BIRTH_DATE,
        journal.measures()["filled"],
    )
    prepared = ledger.step("prepared", prepare)
    report = quality.enforce(admissions.rapport_qualite(prepared), blocking=False)
    return Run(prepared, entries, audit, report)


def load(result: Run, folder: str, blocking: bool = True) -> DataFrame:
    """Load the prepared table, by year, and its audit, if the rules allow.

    The table is published as a new version, read by ``versions.read_published``; a load
    that dies leaves the one before. The audit keeps earlier executions, and a
    repeated load of one execution writes it once.
    """
    admissions.verifier_absence_donnees_personnelles(result.prepared)
    dated = result.prepared.withColumn(
        "annee", F.coalesce(F.year("date_entree"), F.lit(0))
    )
    loaded = load_checked(dated, result.report, f"{folder}/admissions", "annee", blocking)
    load_partitions(result.audit, f"{folder}/audit", "execution_id")
    return loaded
