"""One query per operator, run over whole tables.

Every function takes a session and a folder of Parquet tables. Those that
write go to a new path in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow import reference as ref
from wardflow.functions.text import fold_accents
from wardflow.operators import (
    dedup, defects, enrich, impute, labels, marts, privacy, profile, quality, quantiles,
    returns, star, values,
)
from wardflow.plans import admissions, increments, pipeline, star_schema
from wardflow.session import configure, work_path
from wardflow.sources.csvfile import read_raw_csv, write_csv
from wardflow.sources import versions
from wardflow.sources.tables import hand_off, positions, read_tables
from wardflow.workload import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Salt of the registered queries, so that SQL can repeat the pseudonyms.
SALT = "sel"
MOMENT = datetime(2025, 1, 2, 3, 4, 5)
SEQ = "seq"
KEYS = ["id_admission"]


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(configure(spark), folder))

    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_tables(spark, folder, name)[name]


def stays(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "orders", "customer")
    return spark.sql(views.on_spark(views.STAYS), **tables)


def raw_admissions(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "orders", "customer")
    return spark.sql(views.on_spark(views.ADMISSIONS), **tables)


def typed(spark: SparkSession, folder: str) -> DataFrame:
    return admissions.corriger_types(raw_admissions(spark, folder))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return admissions.nettoyer(raw_admissions(spark, folder), SEQ)


def masked(spark: SparkSession, folder: str) -> DataFrame:
    return admissions.masquer(cleaned(spark, folder), SALT)


# Integer columns that may be missing, in the results below.
MAYBE_MISSING = ("annee_naissance", "mois", "lits", "sejours_an_passe")


def portable(df: DataFrame) -> DataFrame:
    """Dates as text, integers that may be missing as doubles.

    These are the types that clients show differently; all others are kept.
    """
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.col(c).cast("string") for c in df.columns if kinds[c] == "date"}
        | {c: F.col(c).cast("double") for c in MAYBE_MISSING if c in kinds}
    )


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned and enriched rows, handed over as Parquet between the steps."""
    rows = hand_off(masked(spark, folder), work_path(spark, "cleaned"))
    return admissions.enrichir(rows).select(*ref.PREPARED_COLUMNS)


# --- Returns ------------------------------------------------------------------


def event_returns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return returns.flag_returns(
        events, "user_id", "ts", ["event_id"], "delai_j", "est_retour_1j", days=1
    )


@query
def event_return_delay(spark, folder):
    return event_returns(spark, folder).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("evenements"),
        F.count_if("est_retour_1j").alias("retours_1j"),
        F.max("delai_j").alias("delai_max_j"),
    )


@query
def event_return_rows(spark, folder):
    return event_returns(spark, folder).select("event_id", "delai_j", "est_retour_1j")


@query
def event_return_rows_sliced(spark, folder):
    """As above, with every busy user cut along time."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return returns.flag_returns(
        events, "user_id", "ts", ["event_id"], "delai_j", "est_retour_1j", days=1, hot_rows=8
    ).select("event_id", "delai_j", "est_retour_1j")


@query
def event_return_rows_two_loads(spark, folder):
    """Events loaded in two halves of time give the delays of one load."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(seconds).alias("a"), F.max(seconds).alias("b"))
    middle = ends.select(F.floor((F.col("a") + F.col("b")) / 2)).scalar()
    state = work_path(spark, "state")
    parts = [
        increments.delays_of_load(
            events.where(half), "user_id", "ts", ["event_id"], "delai_j", state, load)
        for load, half in (("1", seconds < middle), ("2", seconds >= middle))
    ]
    flag = returns.returned_within("delai_j", 1).alias("est_retour_1j")
    return parts[0].unionByName(parts[1]).select("event_id", "delai_j", flag)


@query
def stay_readmission(spark, folder):
    rows = stays(spark, folder).select(SEQ, "o_custkey", "e")
    return returns.flag_returns(
        rows, "o_custkey", "e", [SEQ], "delai_readmission_j", "est_readmission_30j"
    ).select(SEQ, "delai_readmission_j", "est_readmission_30j")


# --- Duplicates ---------------------------------------------------------------


@query
def dedup_exact(spark, folder):
    return dedup.drop_exact_duplicates(stays(spark, folder), SEQ)


@query
def dedup_keep_last(spark, folder):
    return dedup.deduplicate(stays(spark, folder), ["k"], SEQ)


@query
def dedup_admissions(spark, folder):
    return admissions.dedoublonner(raw_admissions(spark, folder), SEQ)


@query
def dedup_documents(spark, folder):
    documents = table(spark, folder, "documents")
    return dedup.keep_last(documents, ["text"], "doc_id", by_digest=True).drop("text")


@query
def duplicate_counts(spark, folder):
    return dedup.duplicate_counts(raw_admissions(spark, folder), KEYS, SEQ)


@query
def duplicate_counts_documents(spark, folder):
    documents = table(spark, folder, "documents")
    return dedup.duplicate_counts(documents, ["text"], "doc_id")


# --- Labels -------------------------------------------------------------------


@query
def normalise_labels(spark, folder):
    return admissions.normaliser_textes(raw_admissions(spark, folder)).select(
        SEQ, "sexe", "pathologie", "service", "commune_residence", "assurance"
    )


@query
def normalise_segments(spark, folder):
    rule = labels.LabelRule("pathologie", views.SEGMENT_LABELS, ref.UNKNOWN_F)
    return labels.normalise_labels(stays(spark, folder), [rule]).select(SEQ, "pathologie")


@query
def normalise_long_list(spark, folder):
    """A list too long for an expression is joined; the case of the names varies."""
    names = F.when(F.col("c_custkey") % 2 == 0, F.upper("c_name")).otherwise(F.concat(F.lit(" "), "c_name"))
    rows = table(spark, folder, "customer").select("c_custkey", names.alias("client"))
    listed = {f"customer#{i:09d}": f"Client {i}" for i in range(0, 3000, 3)}
    return labels.normalise_labels(rows, [labels.LabelRule("client", listed, ref.UNKNOWN_M)])


@query
def unmatched_labels(spark, folder):
    """Raw cells that match no label of their list, per column."""
    return raw_admissions(spark, folder).agg(
        *[F.count_if(labels.unmatched(rule)).alias(rule.column)
          for rule in admissions.LABEL_RULES]
    )


@query
def spelling_variants(spark, folder):
    return labels.spelling_variants(raw_admissions(spark, folder), "pathologie")


@query
def spellings_of_label(spark, folder):
    return labels.variants_of(raw_admissions(spark, folder), "pathologie", "paludisme simple")


@query
def variant_counts(spark, folder):
    return labels.variant_counts(raw_admissions(spark, folder), "commune_residence")


@query
def recode_values(spark, folder):
    rows = stays(spark, folder).select(SEQ, "service")
    return labels.recode(rows, "service", {"1-URGENT": "Urgent", "5-LOW": "Low"})


@query
def fold_label_accents(spark, folder):
    rows = admissions.normaliser_textes(raw_admissions(spark, folder))
    return rows.select(SEQ, fold_accents(F.col("pathologie")).alias("pathologie"))


# --- Types and values ---------------------------------------------------------


@query
def coerce_types(spark, folder):
    return typed(spark, folder).select(
        SEQ, "date_entree", "date_sortie", "date_naissance", "age",
        "cout_hospitalisation_fcfa", "duree_sejour_j", "temperature_entree_c", "id_medecin",
    )


@query
def coerce_types_strict(spark, folder):
    """Timestamps read in one fixed form."""
    rows = admissions.corriger_types(raw_admissions(spark, folder), "yyyy-MM-dd HH:mm:ss")
    return rows.select(SEQ, "date_entree", "date_sortie")


@query
def null_outliers(spark, folder):
    return admissions.traiter_aberrations(typed(spark, folder)).select(SEQ, *ref.BOUNDS)


@query
def outlier_counts(spark, folder):
    return typed(spark, folder).agg(
        *[F.count_if(values.outside(c, *ref.BOUNDS[c])).alias(c) for c in ref.BOUNDS]
    )


@query
def null_line_outliers(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    return values.null_outside(
        lines, {"l_extendedprice": (1000, 50_000), "l_quantity": (2, 49)}
    )


@query
def fix_chronology(spark, folder):
    rows = stays(spark, folder).select(SEQ, "e", "s", "duree")
    return values.fix_chronology(rows, "e", "s", "duree")


@query
def fix_shipping_chronology(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "l_shipdate",
        F.lit(None).cast("double").alias("delai_j"),
    )
    return values.fix_chronology(rows, "o_orderdate", "l_shipdate", "delai_j")


@query
def impute_durations(spark, folder):
    rows = (
        admissions.dedoublonner(raw_admissions(spark, folder), SEQ)
        .transform(admissions.normaliser_textes)
        .transform(admissions.corriger_types)
        .transform(admissions.traiter_aberrations)
        .transform(admissions.corriger_incoherences)
    )
    return admissions.imputer(rows).select(SEQ, "duree_sejour_j", "duree_imputee", "age")


@query
def impute_segment_medians(spark, folder):
    """Medians over raw spellings, whose number is not known beforehand."""
    rows = stays(spark, folder).select(SEQ, "pathologie", "duree")
    return impute.impute_group_median(rows, "pathologie", "duree", flag="duree_imputee")


@query
def impute_line_prices(spark, folder):
    """Medians of a continuous column; the missing cells are the dear lines."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice"
    )
    rows = values.null_outside(lines, {"l_extendedprice": (0, 90_000)})
    return impute.impute_group_median(
        rows, "l_returnflag", "l_extendedprice", flag="prix_impute", direct_rows=1000
    )


@query
def clean_admissions(spark, folder):
    return cleaned(spark, folder)


# --- Privacy ------------------------------------------------------------------


@query
def pseudonymise_admissions(spark, folder):
    rows = admissions.masquer(typed(spark, folder), SALT)
    admissions.verifier_absence_donnees_personnelles(rows)
    return rows.select(SEQ, "id_patient_pseudo", "annee_naissance", "age", "sexe")


@query
def pseudonymise_customers(spark, folder):
    rows = table(spark, folder, "customer")
    result = privacy.add_pseudonym(rows, "c_custkey", "client_pseudo", SALT).drop("c_name")
    privacy.check_no_personal_columns(result, ["c_custkey", "c_name"])
    return result


@query
def pseudonymise_missing_as_text(spark, folder):
    """A missing identifier hashed as the text pandas makes of it."""
    rows = admissions.masquer(typed(spark, folder), SALT, texte_absent="nan")
    return rows.select(SEQ, "id_patient_pseudo")


@query
def treatment_audit(spark, folder):
    rows = raw_admissions(spark, folder)
    return privacy.treatment_audit(
        rows, ref.PATIENT_ID, ref.DIRECT_IDENTIFIERS, ref.BIRTH_DATE, rows.count(), MOMENT
    )


# --- Derived columns ----------------------------------------------------------


@query
def age_bands(spark, folder):
    rows = typed(spark, folder).select(SEQ, "age")
    return enrich.add_band(
        rows, "age", ref.AGE_BANDS, admissions.AGE_TOP, ref.AGE_UNKNOWN, "tranche_age"
    )


@query
def month_season(spark, folder):
    rows = typed(spark, folder).select(SEQ, "date_entree")
    return enrich.add_month_season(
        rows, "date_entree", ref.SEASON_BY_MONTH, "mois", "saison"
    )


@query
def diagnosis_groups(spark, folder):
    rows = admissions.normaliser_textes(raw_admissions(spark, folder))
    return enrich.add_group(
        rows.select(SEQ, "pathologie"), "pathologie", ref.DIAGNOSIS_GROUPS,
        ref.OTHER_GROUP, "categorie_pathologie",
    )


@query
def unit_cost(spark, folder):
    rows = stays(spark, folder).select(SEQ, "cout", "duree")
    return enrich.add_unit_cost(rows, "cout", "duree", "cout_journalier")


@query
def long_stay_p90(spark, folder):
    rows = stays(spark, folder).select(SEQ, "service", "duree")
    return enrich.add_long_flag(rows, "service", "duree", "sejour_prolonge")


@query
def long_lines_p90(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM").alias("mois_envoi"),
    )
    return enrich.add_long_flag(lines, "mois_envoi", "l_quantity", "prolonge").drop("l_quantity")


@query
def price_quantiles(spark, folder):
    lines = table(spark, folder, "lineitem")
    return quantiles.quantile(lines, ["l_returnflag"], "l_extendedprice", 0.9, "p90")


@query
def price_quantiles_cut(spark, folder):
    """The same values when the groups are cut into slices."""
    lines = table(spark, folder, "lineitem")
    return quantiles.quantile(
        lines, ["l_returnflag"], "l_extendedprice", 0.9, "p90", direct_rows=1000
    )


@query
def enrich_admissions(spark, folder):
    return prepared(spark, folder)


# --- Quality ------------------------------------------------------------------


@query
def quality_report(spark, folder):
    return admissions.rapport_qualite(prepared(spark, folder))


@query
def quality_report_raw(spark, folder):
    """The rules over rows that were typed but not repaired."""
    return admissions.rapport_qualite(typed(spark, folder))


@query
def quality_tally(spark, folder):
    return quality.passed(admissions.rapport_qualite(typed(spark, folder)))


@query
def gate_refusals(spark, folder):
    """The rules for which rows that were not repaired are not loaded."""
    return quality.refusals(admissions.rapport_qualite(typed(spark, folder)))


@query
def domain_report(spark, folder):
    return quality.quality_report(cleaned(spark, folder), admissions.regles_domaines())


# --- Profiles -----------------------------------------------------------------


@query
def column_profile(spark, folder):
    return admissions.auditer(raw_admissions(spark, folder), SEQ)


@query
def column_profile_orders(spark, folder):
    return profile.column_profile(
        table(spark, folder, "orders").drop("o_totalprice"), "o_orderkey"
    )


@query
def column_profile_approx(spark, folder):
    """Estimated distinct values, next to the exact ones: three deviations of 5 %."""
    raw = raw_admissions(spark, folder)
    exact = admissions.auditer(raw, SEQ).select("colonne", F.col(profile.DISTINCT).alias("exact"))
    rough = admissions.auditer(raw, SEQ, approx=True).join(exact, "colonne")
    near = F.abs(F.col(profile.DISTINCT) - F.col("exact")) <= 0.15 * F.col("exact") + 1
    return rough.withColumn("estimation_proche", near).drop("exact", profile.DISTINCT)


@query
def distinct_of_two_loads(spark, folder):
    """Sketches of two loads, united: near the exact numbers of all rows, in three deviations."""
    orders = table(spark, folder, "orders")
    even = F.col("o_orderkey") % 2 == 0
    store = work_path(spark, "sketches")
    for load, rows in (("even", orders.where(even)), ("odd", orders.where(~even))):
        increments.add_sketches(rows, "o_orderkey", store, load)
    found = profile.united_distinct(versions.read_published(spark, store))
    exact = profile.column_profile(orders, "o_orderkey").select(
        "colonne", F.col(profile.DISTINCT).alias("exact"))
    near = F.abs(F.col(profile.DISTINCT) - F.col("exact")) <= (
        3 * profile.SKETCH_ERROR * F.col("exact") + 1)
    return found.join(exact, "colonne").select("colonne", near.alias("estimation_proche"))


@query
def audit_summary(spark, folder):
    return admissions.resumer_audit(raw_admissions(spark, folder), SEQ)


@query
def value_counts(spark, folder):
    return profile.value_counts(raw_admissions(spark, folder), "sexe")


@query
def distinct_count(spark, folder):
    return profile.distinct_count(raw_admissions(spark, folder), "pathologie")


@query
def head_preview(spark, folder):
    return profile.head(raw_admissions(spark, folder), SEQ, 3)


@query
def dataset_summary(spark, folder):
    rows = stays(spark, folder)
    return profile.dataset_summary(rows, ["o_custkey", "service", "pathologie"], "e")


@query
def cleaning_journal(spark, folder):
    run = pipeline.run(raw_admissions(spark, folder), SALT, order=SEQ, source="admissions.csv")
    return run.journal


@query
def resumed_journal(spark, folder):
    """The journal of a run that finds all its steps done."""
    raw, place = raw_admissions(spark, folder), work_path(spark, "run")
    for _ in range(2):
        run = pipeline.run(raw, SALT, SEQ, place, "admissions.csv", resume=True)
    return run.journal


# --- Star schema and summaries ------------------------------------------------


@query
def dim_date(spark, folder):
    return star_schema.dates(cleaned(spark, folder))


@query
def dim_service(spark, folder):
    """Services with their beds and the stays that refer to them."""
    used = cleaned(spark, folder).groupBy("service").agg(F.count(F.lit(1)).alias("sejours"))
    return star_schema.list_dimensions(spark)["service_id"].join(used, "service", "left")


@query
def dim_diagnosis(spark, folder):
    used = cleaned(spark, folder).groupBy("pathologie").agg(F.count(F.lit(1)).alias("sejours"))
    return star_schema.list_dimensions(spark)["pathologie_id"].join(used, "pathologie", "left")


@query
def dim_priority(spark, folder):
    return star.observed_dimension(
        table(spark, folder, "orders"), "o_orderpriority", "priorite_id"
    )


@query
def fact_admissions(spark, folder):
    return star_schema.facts(prepared(spark, folder))


@query
def fact_orders(spark, folder):
    tables = read_tables(spark, folder, "orders", "customer")
    orders = tables["orders"]
    priorities = star.observed_dimension(orders, "o_orderpriority", "priorite_id")
    fact = orders.join(
        tables["customer"].select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
        "left",
    ).select(
        "o_orderkey", "o_custkey", "c_nationkey",
        star.date_key(F.col("o_orderdate")).alias("date_id"), "o_orderpriority",
        "o_totalprice",
    )
    return star.with_dimension_key(fact, priorities, "o_orderpriority", "priorite_id")


@query
def orphan_check(spark, folder):
    rows = prepared(spark, folder)
    fact = hand_off(star_schema.facts(rows), work_path(spark, "facts"))
    return star_schema.check_links(fact, star_schema.dates(rows))


@query
def orphan_check_found(spark, folder):
    """A link with orphans: some lines' order keys are changed, all orders are there."""
    tables = read_tables(spark, folder, "lineitem", "orders")
    lines = tables["lineitem"].withColumn("l_orderkey", F.expr(views.LOST_ORDER))
    return star.orphan_report(lines, {"l_orderkey": (tables["orders"], "o_orderkey")})


@query
def orphan_check_by_words(spark, folder):
    """As above, with the orders' keys as bits that are looked up where lines are read."""
    tables = read_tables(spark, folder, "lineitem", "orders")
    lines = tables["lineitem"].withColumn("l_orderkey", F.expr(views.LOST_ORDER))
    return star.orphan_report(
        lines, {"l_orderkey": (tables["orders"], "o_orderkey")}, star.orphans_by_words)


@query
def dim_order(spark, folder):
    """A dimension of many values, numbered in their order."""
    return star.observed_dimension(table(spark, folder, "orders"), "o_orderkey", "commande_id")


@query
def dim_customer_two_loads(spark, folder):
    """Keys of a first load, of orders of even months, stay in a second load of all orders."""
    orders = table(spark, folder, "orders")
    registry = work_path(spark, "registry")
    first = orders.where(F.month("o_orderdate") % 2 == 0)
    for load, rows in (("1", first), ("2", orders), ("2", orders)):
        keys = increments.register_keys(rows, "o_custkey", "client_id", registry, load)
    return keys


@query
def orphan_check_orders(spark, folder):
    names = ["lineitem", "orders", "customer", "part", "supplier"]
    tables = read_tables(spark, folder, *names)
    lines = star.orphan_report(
        tables["lineitem"],
        {
            "l_orderkey": (tables["orders"], "o_orderkey"),
            "l_partkey": (tables["part"], "p_partkey"),
            "l_suppkey": (tables["supplier"], "s_suppkey"),
        },
    )
    return lines.unionByName(
        star.orphan_report(
            tables["orders"], {"o_custkey": (tables["customer"], "c_custkey")}
        )
    )


def _closed(rows: DataFrame) -> DataFrame:
    """Stays with an exit: the date known, or entry plus duration."""
    rows = defects.add_shifted(rows, "date_entree", "duree_sejour_j", "__exit")
    return rows.withColumn("date_sortie", F.coalesce("date_sortie", "__exit")).drop("__exit")


@query
def occupancy_by_month(spark, folder):
    return marts.occupancy(
        _closed(cleaned(spark, folder)), "service", "date_entree", "date_sortie",
        ref.SERVICE_BEDS,
    )


@query
def census_by_month(spark, folder):
    return marts.daily_census(
        _closed(cleaned(spark, folder)), "service", "date_entree", "date_sortie")


@query
def burden_by_diagnosis(spark, folder):
    return marts.burden(
        cleaned(spark, folder), "pathologie", "duree_sejour_j",
        "cout_hospitalisation_fcfa", "issue", ref.DEATH,
    )


@query
def seasonality_index(spark, folder):
    rows = enrich.add_group(
        cleaned(spark, folder), "pathologie", ref.DIAGNOSIS_GROUPS, ref.OTHER_GROUP,
        "categorie_pathologie",
    )
    return marts.seasonality(rows, "date_entree", "categorie_pathologie")


def _banded(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.add_band(
        cleaned(spark, folder), "age", ref.AGE_BANDS, admissions.AGE_TOP,
        ref.AGE_UNKNOWN, "tranche_age",
    )


@query
def diagnosis_by_age(spark, folder):
    bands = [label for _, label, _, _ in ref.AGE_BANDS] + [ref.AGE_UNKNOWN]
    return marts.crossing(_banded(spark, folder), "pathologie", "tranche_age", bands)


@query
def diagnosis_age_totals(spark, folder):
    return marts.crossing_totals(_banded(spark, folder), "pathologie", "tranche_age")


# --- Defects ------------------------------------------------------------------


@query
def inject_defects(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    return defects.inject(
        rows,
        "o_orderkey",
        [
            defects.Defect("o_totalprice", F.lit(-1.0), 0.014, 13),
            defects.Defect("o_orderstatus", F.lit(None).cast("string"), 0.031, 2),
            defects.Defect("o_orderpriority", F.lower("o_orderpriority"), 0.06, 6),
        ],
    )


@query
def inject_duplicates(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return defects.inject_duplicates(rows, "o_orderkey", 0.02, 16)


@query
def shuffle_orders(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return defects.shuffle_rows(rows, "o_orderkey", 17)


@query
def null_exit_on_death(spark, folder):
    rows = stays(spark, folder).select(SEQ, "issue", "s")
    return defects.null_when(rows, "s", F.col("issue") == "F")


@query
def shift_exit(spark, folder):
    rows = stays(spark, folder).select(SEQ, "e", "duree")
    return defects.add_shifted(rows, "e", "duree", "s")


@query
def expected_cost(spark, folder):
    rows = cleaned(spark, folder).select("id_admission", "service", "duree_sejour_j")
    return defects.add_expected_cost(
        rows, "service", "duree_sejour_j", ref.SERVICE_TARIFF, "cout_attendu"
    )


# --- Sources, sinks and whole runs --------------------------------------------


def _as_csv(spark: SparkSession, folder: str) -> str:
    """The raw admissions as CSV files in row order; returns their path.

    Orders are sorted before they become admissions, which have three times as many columns.
    """
    path = work_path(spark, "admissions-csv")
    tables = read_tables(spark, folder, "orders", "customer")
    rows = spark.sql(views.on_spark(views.ADMISSION_COPIES), **tables).orderBy(SEQ)
    write_csv(spark.sql(views.ADMISSIONS_OF, rows=rows.drop(SEQ)).drop(SEQ), path)
    return path


@query
def csv_roundtrip(spark, folder):
    return admissions.extraire(spark, _as_csv(spark, folder)).drop("_seq")


@query
def csv_header_roundtrip(spark, folder):
    """A table whose columns are learnt from the header."""
    path = work_path(spark, "customer-csv")
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_csv(rows, path)
    return read_raw_csv(spark, path).drop("_seq")


@query
def csv_long_text_roundtrip(spark, folder):
    """Texts with line breaks and quotes, through files and back."""
    path = work_path(spark, "documents-csv")
    write_csv(table(spark, folder, "documents").select("doc_id", "text"), path)
    rows = read_raw_csv(spark, path, ["doc_id", "text"], null_tokens=(), multi_line=True)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("md5"))


@query
def csv_long_text_order(spark, folder):
    """File order of records with line breaks: the last one of each source."""
    path = work_path(spark, "documents-csv")
    rows = table(spark, folder, "documents").select("doc_id", "source", "text")
    write_csv(rows.orderBy("doc_id"), path)
    back = read_raw_csv(spark, path, rows.columns, null_tokens=(), multi_line=True)
    last = dedup.keep_last(back, ["source"], "_seq")
    return last.select(
        "source", F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("md5"))


@query
def csv_file_order(spark, folder):
    """Duplicates of a file resolved by file order alone."""
    raw = admissions.extraire(spark, _as_csv(spark, folder))
    return admissions.dedoublonner(raw).drop("_seq")


@query
def parquet_hand_off(spark, folder):
    return hand_off(typed(spark, folder), work_path(spark, "typed")).select(
        SEQ, "id_admission", "date_entree", "duree_sejour_j", "age"
    )


@query
def full_run_from_csv(spark, folder):
    raw = admissions.extraire(spark, _as_csv(spark, folder))
    return pipeline.run(raw, SALT).prepared


@query
def full_run(spark, folder):
    return pipeline.run(raw_admissions(spark, folder), SALT, order=SEQ).prepared


@query
def sorted_admissions(spark, folder):
    """The global sort; each row's place in the written files shows it."""
    rows = hand_off(masked(spark, folder), work_path(spark, "cleaned"))
    ordered = admissions.enrichir(rows, trier=True).select("id_admission", "date_entree")
    return positions(hand_off(ordered, work_path(spark, "sorted")), "position")


@query
def warehouse_load_gated(spark, folder):
    """A load through the blocking gate: all admissions, outcomes and durations mended."""
    days = F.col("duree_sejour_j").try_cast("double")
    raw = raw_admissions(spark, folder).withColumns({
        "issue": F.lit(ref.OUTCOMES[0]),
        "duree_sejour_j": F.when(days > 0.1, F.col("duree_sejour_j")).otherwise("1.5"),
    })
    result = pipeline.run(raw, SALT, order=SEQ)
    return pipeline.load(result, work_path(spark, "warehouse")).groupBy("annee").agg(
        F.count(F.lit(1)).alias("sejours"))


@query
def event_returns_by_day(spark, folder):
    """Ties abound when times are days; every key is cut."""
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("jour"))
    return returns.days_since_previous(
        events, "user_id", "jour", ["event_id"], "delai_j", hot_rows=20
    ).drop("jour")


@query
def warehouse_load(spark, folder):
    """A checked load, repeated: the second run replaces the first."""
    target = work_path(spark, "warehouse")
    result = pipeline.run(raw_admissions(spark, folder), SALT, order=SEQ)
    pipeline.load(result, target, blocking=False)
    return pipeline.load(result, target, blocking=False).groupBy("annee").agg(
        F.count(F.lit(1)).alias("sejours"),
        F.count_distinct("id_patient_pseudo").alias("patients"),
    )
