"""Hospital admissions: the operators bound to the hospital tables.

Function names are those users of the pandas pipeline know. ``ordre`` is the
column that gives file order; :func:`extraire` adds it as ``_seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow import reference as ref
from wardflow.operators import dedup, enrich, impute, labels, privacy, profile, quality, returns
from wardflow.operators import values
from wardflow.session import work_path
from wardflow.sources.csvfile import ORDER, read_raw_csv
from wardflow.sources.tables import hand_off

TIMESTAMPS = ["date_entree", "date_sortie"]
NUMBERS = ["age", "cout_hospitalisation_fcfa", "duree_sejour_j", "temperature_entree_c"]
STAY = ("date_entree", "date_sortie", "duree_sejour_j")
PERSONAL = [*ref.DIRECT_IDENTIFIERS, ref.PATIENT_ID, ref.BIRTH_DATE]
AGE_TOP = 121

LABEL_RULES = [
    labels.LabelRule("sexe", ref.SEX_LABELS, ref.UNKNOWN_M),
    labels.LabelRule("pathologie", ref.DIAGNOSIS_LABELS, ref.UNKNOWN_F),
    labels.LabelRule("service", ref.SERVICE_LABELS, ref.UNKNOWN_M),
    labels.LabelRule("commune_residence", ref.TOWN_LABELS, ref.UNKNOWN_F),
    labels.LabelRule("assurance", ref.INSURANCE_LABELS, ref.UNKNOWN_F),
]
# After normalisation a label is in its list or is the default.
DIAGNOSES = len(set(ref.DIAGNOSIS_LABELS.values())) + 1
SERVICES = len(set(ref.SERVICE_LABELS.values())) + 1


def extraire(
    spark: SparkSession, chemin: str, multi_ligne: bool = False, invalides: str = "raise"
) -> DataFrame:
    """Raw CSV, every cell a text, with file order in ``_seq``.

    See :func:`read_raw_csv` for line breaks inside cells and for bad records.
    """
    return read_raw_csv(
        spark, chemin, ref.RAW_COLUMNS, multi_line=multi_ligne, bad_records=invalides)


def auditer(df: DataFrame, ordre: str = ORDER, approx: bool = False) -> DataFrame:
    return profile.column_profile(df, ordre, approx)


def resumer_audit(df: DataFrame, ordre: str | None = ORDER) -> DataFrame:
    return profile.audit_summary(df, "id_admission", ordre)


def dedoublonner(df: DataFrame, ordre: str = ORDER) -> DataFrame:
    return dedup.deduplicate(df, ["id_admission"], ordre)


def normaliser_textes(df: DataFrame) -> DataFrame:
    return labels.normalise_labels(df, LABEL_RULES)


def corriger_types(df: DataFrame, format_horodatage: str | None = None) -> DataFrame:
    return values.coerce_types(
        df,
        timestamps=TIMESTAMPS,
        birth_dates=[ref.BIRTH_DATE],
        numbers=NUMBERS,
        blank_defaults={"id_medecin": ref.DOCTOR_UNKNOWN},
        timestamp_format=format_horodatage,
    )


def traiter_aberrations(df: DataFrame) -> DataFrame:
    return values.null_outside(df, ref.BOUNDS)


def corriger_incoherences(df: DataFrame) -> DataFrame:
    return values.fix_chronology(df, *STAY)


def imputer(df: DataFrame) -> DataFrame:
    """Durations by diagnosis median, ages by birth date."""
    filled = impute.impute_group_median(
        df, "pathologie", "duree_sejour_j", flag="duree_imputee"
    )
    return impute.age_from_birth(filled, "age", ref.BIRTH_DATE, "date_entree")


def preparer(df: DataFrame, ordre: str = ORDER) -> DataFrame:
    """The cleaning steps up to imputation, as one plan; file order is dropped."""
    return (
        dedoublonner(df, ordre)
        .drop(ordre)
        .transform(normaliser_textes)
        .transform(corriger_types)
        .transform(traiter_aberrations)
        .transform(corriger_incoherences)
    )


def nettoyer(df: DataFrame, ordre: str = ORDER, chemin: str | None = None) -> DataFrame:
    """The six cleaning steps in their order.

    Imputation reads its rows twice, for the medians and to fill them in, so
    they are written first: to ``chemin``, or to a new path in the shared
    folder. The two wide shuffles of the duplicates then run once, and the
    medians read two columns.
    """
    chemin = chemin or work_path(df.sparkSession, "staged")
    return imputer(hand_off(preparer(df, ordre), chemin))


def sel_requis(sel: str | None = None) -> str:
    return privacy.required_salt(sel, ref.SALT_VARIABLE)


def pseudonymiser(
    df: DataFrame, sel: str | None = None, texte_absent: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Pseudonymised table and treatment audit. Counts the rows."""
    sel = sel_requis(sel)
    audit = privacy.treatment_audit(
        df, ref.PATIENT_ID, ref.DIRECT_IDENTIFIERS, ref.BIRTH_DATE, df.count()
    )
    return masquer(df, sel, texte_absent), audit


def masquer(df: DataFrame, sel: str, texte_absent: str | None = None) -> DataFrame:
    """Pseudonymised table alone; runs nothing."""
    return privacy.pseudonymise(
        df,
        sel,
        ref.PATIENT_ID,
        ref.DIRECT_IDENTIFIERS,
        ref.BIRTH_DATE,
        missing_text=texte_absent,
    )


def verifier_absence_donnees_personnelles(df: DataFrame) -> bool:
    return privacy.check_no_personal_columns(df, PERSONAL)


def enrichir(
    df: DataFrame, trier: bool = False, lignes_chaudes: int = returns.HOT_ROWS
) -> DataFrame:
    """The derived columns; ``trier`` adds the global sort by admission, then its number.

    Return delays deal all rows out by patient, so what is computed from a row alone
    follows them and is not shuffled.
    """
    columns = df.columns
    df = enrich.add_long_flag(df, "service", "duree_sejour_j", "sejour_prolonge")
    df = returns.flag_returns(
        df,
        "id_patient_pseudo",
        "date_entree",
        ["id_admission"],
        "delai_readmission_j",
        "est_readmission_30j",
        hot_rows=lignes_chaudes,
    )
    df = enrich.add_band(df, "age", ref.AGE_BANDS, AGE_TOP, ref.AGE_UNKNOWN, "tranche_age")
    df = enrich.add_month_season(df, "date_entree", ref.SEASON_BY_MONTH, "mois", "saison")
    df = enrich.add_group(
        df, "pathologie", ref.DIAGNOSIS_GROUPS, ref.OTHER_GROUP, "categorie_pathologie"
    )
    df = enrich.add_unit_cost(
        df, "cout_hospitalisation_fcfa", "duree_sejour_j", "cout_journalier_fcfa"
    )
    df = df.select(
        *columns, "tranche_age", "mois", "saison", "categorie_pathologie", "cout_journalier_fcfa",
        "sejour_prolonge", "delai_readmission_j", "est_readmission_30j",
    )
    ends = [df[c].asc_nulls_last() for c in ("date_entree", "id_admission")]
    return df.orderBy(*ends) if trier else df


def regles(df: DataFrame) -> list[quality.Rule]:
    """The eight rules: six blocking, two informative."""
    blocking = {
        "unique": quality.repeats("id_admission"),
        "personal": quality.column_left(df, ref.DIRECT_IDENTIFIERS),
        "age": quality.out_of_range("age", *ref.BOUNDS["age"]),
        "duration": quality.not_positive("duree_sejour_j"),
        "dates": quality.before("date_sortie", "date_entree"),
        "outcome": quality.not_listed("issue", ref.OUTCOMES),
    }
    informative = {
        "diagnosis": quality.equal_to("pathologie", ref.UNKNOWN_F),
        "temperature": quality.missing("temperature_entree_c"),
    }
    return [
        quality.Rule(name, check, message, blocking=rule in blocking)
        for rule, check in (blocking | informative).items()
        for name, message in [ref.RULES[rule]]
    ]


def rapport_qualite(df: DataFrame) -> DataFrame:
    """The report as a plan; nothing is run or raised."""
    return quality.quality_report(df, regles(df))


def controler_qualite(df: DataFrame, bloquant: bool = True) -> DataFrame:
    """Run the report; raise when a blocking rule failed and ``bloquant``."""
    return quality.enforce(rapport_qualite(df), bloquant)


def regles_domaines() -> list[quality.Rule]:
    """Code lists of the columns that are passed through, and list lengths."""
    return quality.domain_rules(
        {
            "mode_admission": ref.ADMISSION_MODES,
            "gravite": ref.SEVERITIES,
            "assurance": [*ref.INSURANCES, ref.UNKNOWN_F],
        }
    ) + quality.modality_rules(
        {
            "sexe": len(set(ref.SEX_LABELS.values())) + 1,
            "pathologie": DIAGNOSES,
            "service": SERVICES,
            "commune_residence": len(set(ref.TOWN_LABELS.values())) + 1,
            "assurance": len(set(ref.INSURANCE_LABELS.values())) + 1,
        }
    )
