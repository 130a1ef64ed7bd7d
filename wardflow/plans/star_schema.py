"""Star schema of the prepared admissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow import reference as ref
from wardflow.operators.enrich import members_to_group
from wardflow.operators.star import (
    date_dimension, date_key, list_dimension, orphan_report, with_dimension_key,
)

MEASURES = [
    "age", "duree_sejour_j", "duree_imputee", "temperature_entree_c",
    "cout_hospitalisation_fcfa", "cout_journalier_fcfa", "sejour_prolonge",
    "delai_readmission_j", "est_readmission_30j",
]
# Dimension key -> natural column in the prepared table.
LINKS = {
    "service_id": "service",
    "pathologie_id": "pathologie",
    "commune_id": "commune_residence",
    "tranche_id": "tranche_age",
    "assurance_id": "assurance",
    "issue_id": "issue",
}


def _labels(mapping: dict, default: str) -> list[str]:
    return [*dict.fromkeys(mapping.values()), default]


def list_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The dimensions that come from reference lists, by key column."""
    ranks = {label: rank for rank, label, _, _ in ref.AGE_BANDS}
    diagnoses = _labels(ref.DIAGNOSIS_LABELS, ref.UNKNOWN_F)
    groups = members_to_group(ref.DIAGNOSIS_GROUPS)
    return {
        "service_id": list_dimension(
            spark, _labels(ref.SERVICE_LABELS, ref.UNKNOWN_M), "service_id", "service",
            {"lits": (ref.SERVICE_BEDS, "int")},
        ),
        "pathologie_id": list_dimension(
            spark, diagnoses, "pathologie_id", "pathologie",
            {
                "categorie_pathologie": (
                    {label: groups.get(label, ref.OTHER_GROUP) for label in diagnoses},
                    "string",
                )
            },
        ),
        "commune_id": list_dimension(
            spark, _labels(ref.TOWN_LABELS, ref.UNKNOWN_F), "commune_id", "commune_residence"
        ),
        "tranche_id": list_dimension(
            spark, [*ranks, ref.AGE_UNKNOWN], "tranche_id", "tranche_age",
            {"ordre": (ranks, "int")},
        ),
        "assurance_id": list_dimension(
            spark, _labels(ref.INSURANCE_LABELS, ref.UNKNOWN_F), "assurance_id", "assurance"
        ),
        "issue_id": list_dimension(
            spark, [*ref.OUTCOMES, ref.UNKNOWN_F], "issue_id", "issue",
            {"libelle_issue": (ref.OUTCOME_NAMES, "string")},
        ),
    }


def dates(prepared: DataFrame) -> DataFrame:
    """Calendar of the entry and exit days that occur."""
    days = prepared.select(F.explode(F.array("date_entree", "date_sortie")).alias("jour_vu"))
    return date_dimension(
        days, "jour_vu", ref.MONTH_NAMES, ref.DAY_NAMES, ref.SEASON_BY_MONTH
    )


def facts(prepared: DataFrame) -> DataFrame:
    """One row per admission: dimension keys, pseudonym, measures.

    Every list dimension is as long as its list, so each is a broadcast and
    the admissions are never shuffled. Outcomes outside the list fall under
    the unknown member, as the other columns already do.
    """
    known = F.when(F.col("issue").isin(*ref.OUTCOMES), F.col("issue"))
    table = prepared.withColumn("issue", F.coalesce(known, F.lit(ref.UNKNOWN_F))).select(
        "id_admission",
        "id_patient_pseudo",
        date_key(F.col("date_entree")).alias("entree_id"),
        date_key(F.col("date_sortie")).alias("sortie_id"),
        *LINKS.values(),
        *MEASURES,
    )
    dimensions = list_dimensions(prepared.sparkSession)
    for key, natural in LINKS.items():
        # The longest list is the diagnoses'.
        table = with_dimension_key(
            table, dimensions[key], natural, key, max_rows=len(ref.DIAGNOSIS_LABELS) + 1
        )
    return table


def check_links(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orphaned keys of every dimension link; 0 stands for no date."""
    dimensions = list_dimensions(fact.sparkSession)
    links = {key: (dimensions[key], key) for key in LINKS}
    no_date = calendar.select("date_id").unionByName(
        fact.sparkSession.range(1).select(F.lit(0).alias("date_id"))
    )
    links |= {key: (no_date, "date_id") for key in ("entree_id", "sortie_id")}
    return orphan_report(fact, links)
