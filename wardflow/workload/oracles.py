"""The SQL each registered query must equal, for DuckDB.

Written from the definitions, not from the Spark plans: plain window functions
and one-day-per-row expansions where the library salts, slices or counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from wardflow import reference as ref
from wardflow.plans import admissions
from wardflow.workload import views

SALT = "sel"
RAW = ", ".join(ref.RAW_COLUMNS)
STAYS = f"with v as ({views.on_duckdb(views.STAYS)})"
# Unicode white space and the four separators U+001C to U+001F.
SPACES = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
NUMBER = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(texts) -> str:
    return ", ".join(quoted(text) for text in texts)


def squeezed(col: str) -> str:
    return f"trim(regexp_replace({col}, '{SPACES}', ' ', 'g'))"


def norm(col: str) -> str:
    return f"lower({squeezed(col)})"


def choose(value: str, mapping: Mapping, default: str = "null") -> str:
    def literal(x):
        return quoted(x) if isinstance(x, str) else str(x)

    arms = " ".join(f"when {literal(k)} then {literal(v)}" for k, v in mapping.items())
    return f"case {value} {arms} else {default} end"


def label(col: str, mapping: Mapping, default: str) -> str:
    return choose(norm(col), mapping, quoted(default))


def number(col: str) -> str:
    return (
        f"case when regexp_full_match({col}, '{NUMBER}') "
        f"then try_cast(trim({col}) as double) end"
    )


def days(start: str, end: str) -> str:
    micros = f"date_diff('microsecond', {start}, {end})"
    return f"round_even({micros} / 86400000000.0::double * 10, 0) / 10"


def rate(part: str, whole: str, digits: int = 2) -> str:
    scale = f"{10**digits}.0::double"
    return (
        f"round_even(({part})::double / nullif(({whole})::double, 0) * 100 * {scale}, 0) / {scale}"
    )


def flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


TYPED = [
    "id_admission", "id_patient", "nom_patient", "prenom_patient",
    "case when regexp_full_match(date_naissance, '\\d{1,2}/\\d{1,2}/\\d{4}') "
    "then try_strptime(date_naissance, '%d/%m/%Y')::date end as date_naissance",
    f"{number('age')} as age",
    "sexe", "telephone", "commune_residence", "assurance", "mode_admission",
    "try_cast(date_entree as timestamp) as date_entree",
    "try_cast(date_sortie as timestamp) as date_sortie",
    f"{number('duree_sejour_j')} as duree_sejour_j",
    "service", "pathologie", "gravite",
    f"coalesce(nullif({squeezed('id_medecin')}, ''), '{ref.DOCTOR_UNKNOWN}') as id_medecin",
    f"{number('temperature_entree_c')} as temperature_entree_c",
    f"{number('cout_hospitalisation_fcfa')} as cout_hospitalisation_fcfa",
    "issue", "seq",
]
LABELS = {rule.column: label(rule.column, rule.labels, rule.default)
          for rule in admissions.LABEL_RULES}
BOUNDED = ", ".join(
    f"case when {c} between {low} and {high} then {c} end as {c}"
    for c, (low, high) in ref.BOUNDS.items()
)
OUT = {c: f"count(*) filter (where {c} < {low} or {c} > {high})"
       for c, (low, high) in ref.BOUNDS.items()}
EXIT = "case when date_sortie < date_entree then null else date_sortie end"
AGE_EDGES = [low for _, _, low, _ in ref.AGE_BANDS] + [admissions.AGE_TOP]
BAND = (
    "case "
    + " ".join(
        f"when age >= {low} and age < {high} then {quoted(name)}"
        for (_, name, low, _), high in zip(ref.AGE_BANDS, AGE_EDGES[1:])
    )
    + f" else {quoted(ref.AGE_UNKNOWN)} end"
)
GROUP = choose(
    "pathologie",
    {m: g for g, members in ref.DIAGNOSIS_GROUPS.items() for m in members},
    quoted(ref.OTHER_GROUP),
)
PSEUDONYM = f"substr(sha256('{SALT}' || id_patient), 1, 16)"


def _replaced(columns: list[str], **new: str) -> str:
    return ", ".join(f"{new[c]} as {c}" if c in new else c for c in columns)


_SEQ_COLUMNS = [*ref.RAW_COLUMNS, "seq"]
# Each stage reads the one before.
STAGES = {
    "raw": views.on_duckdb(views.ADMISSIONS),
    "uniq": f"select {RAW}, min(seq) as seq from raw group by {RAW}",
    "kept": "select * from uniq qualify row_number() over "
            "(partition by id_admission order by seq desc) = 1",
    "labelled": f"select {_replaced(_SEQ_COLUMNS, **LABELS)} from kept",
    "typed": f"select {', '.join(TYPED)} from labelled",
    "bounded": f"select * replace ({BOUNDED}) from typed",
    "ordered": f"select * replace ({EXIT} as date_sortie) from bounded",
    "dated": "select * replace (coalesce(duree_sejour_j, case when date_sortie is not null "
             f"then {days('date_entree', 'date_sortie')} end) as duree_sejour_j) from ordered",
    "medians": "select pathologie as p, median(duree_sejour_j) as med from dated "
               "where pathologie is not null group by pathologie",
    "halfway": "select dated.*, duree_sejour_j is null as duree_imputee, "
               "coalesce(duree_sejour_j, med) as filled from dated left join medians "
               "on pathologie = p",
    "cleaned": "select * exclude (filled) replace ("
               "coalesce(filled, (select median(filled) from halfway)) as duree_sejour_j, "
               "coalesce(age, floor(date_diff('day', date_naissance, date_entree::date) "
               "/ 365.0)::double) as age) from halfway",
    "masked": f"select *, {PSEUDONYM} as id_patient_pseudo, "
              "year(date_naissance)::int as annee_naissance from cleaned",
    "thresholds": "select service as sv, quantile_cont(duree_sejour_j, 0.9) as p90 "
                  "from masked group by service",
    "lagged": f"select *, {BAND} as tranche_age, month(date_entree)::int as mois, "
              f"{choose('month(date_entree)', ref.SEASON_BY_MONTH)} as saison, "
              f"{GROUP} as categorie_pathologie, "
              "round_even(cout_hospitalisation_fcfa / nullif(duree_sejour_j, 0), 0) "
              "as cout_journalier_fcfa, "
              f"{flag('duree_sejour_j > p90')} as sejour_prolonge, "
              "case when id_patient_pseudo is not null then lag(date_entree) over "
              "(partition by id_patient_pseudo order by date_entree nulls last, id_admission) "
              "end as precedent from masked left join thresholds on service = sv",
    "delayed": f"select *, {days('precedent', 'date_entree')} as delai_readmission_j "
               "from lagged",
    "prepared": "select *, "
                f"{flag('delai_readmission_j <= 30')} as est_readmission_30j from delayed",
}


def upto(stage: str, **others: str) -> str:
    """WITH clause of all stages up to one, and further named ones."""
    parts = []
    for name, text in STAGES.items():
        parts.append(f"{name} as ({text})")
        if name == stage:
            break
    parts += [f"{name} as ({text})" for name, text in others.items()]
    return "with " + ",\n".join(parts)


# Raw rows typed without the steps before.
RAW_TYPED = (
    f"with raw as ({STAGES['raw']}), typed as (select {', '.join(TYPED)} from raw)"
)
RAW_ONLY = f"with raw as ({STAGES['raw']})"
CLEAN_COLUMNS = ", ".join([*ref.RAW_COLUMNS, "duree_imputee"])
PREPARED = ", ".join(ref.PREPARED_COLUMNS)


def report(rules: list[tuple[str, str, bool, str]], source: str) -> str:
    """Rows of (name, count, blocking, message) rules over one source."""
    rows = []
    for name, count, blocking, message in rules:
        kind, bad = ("bloquante", "ÉCHEC") if blocking else ("informative", "AVERTISSEMENT")
        rows.append(
            f"select {quoted(name)} as regle, n as violations, "
            f"case when n = 0 then 'OK' else '{bad}' end as statut, "
            f"'{kind}' as criticite, case when n = 0 then '' else "
            f"replace({quoted(message)}, '{{n}}', n::varchar) end as message "
            f"from (select ({count})::bigint as n from {source})"
        )
    return "\nunion all\n".join(rows)


def admission_rules(personal_left: bool) -> list[tuple[str, str, bool, str]]:
    return [
        ("R1 — Unicité de id_admission",
         "count(*) - count(distinct id_admission) - max((id_admission is null)::int)", True,
         "{n} identifiants d'admission dupliqués : la clé primaire de la table de faits "
         "serait invalide."),
        ("R2 — Absence de données personnelles", f"max({int(personal_left)})", True,
         "Des colonnes identifiantes subsistent : chargement interdit par la loi 2019-992."),
        ("R3 — Âge dans une plage plausible",
         "count(*) filter (where age < 0 or age > 110)", True,
         "{n} âges hors de l'intervalle [0 ; 110]."),
        ("R4 — Durée de séjour strictement positive",
         "count(*) filter (where duree_sejour_j is null or duree_sejour_j <= 0)", True,
         "{n} durées de séjour nulles, négatives ou manquantes."),
        ("R5 — Cohérence chronologique entrée/sortie",
         "count(*) filter (where date_sortie < date_entree)", True,
         "{n} dates de sortie antérieures à la date d'entrée."),
        ("R6 — Issue conforme au référentiel",
         f"count(*) filter (where issue is null or issue not in ({listed(ref.OUTCOMES)}))",
         True, "{n} valeurs d'issue hors référentiel."),
        ("R7 — Pathologie rattachée au référentiel",
         f"count(*) filter (where pathologie = '{ref.UNKNOWN_F}')", False,
         "{n} admissions sans pathologie identifiée : elles seront exclues des analyses "
         "par diagnostic."),
        ("R8 — Complétude de la température",
         "count(*) filter (where temperature_entree_c is null)", False,
         "{n} températures non relevées ({n} dossiers incomplets)."),
    ]


def domain_rules() -> list[tuple[str, str, bool, str]]:
    domains = {
        "mode_admission": ref.ADMISSION_MODES,
        "gravite": ref.SEVERITIES,
        "assurance": [*ref.INSURANCES, ref.UNKNOWN_F],
    }
    sizes = {"sexe": 3, "pathologie": 32, "service": 9, "commune_residence": 14, "assurance": 5}
    return [
        (f"Domaine de {c}",
         f"count(*) filter (where {c} is null or {c} not in ({listed(allowed)}))", False,
         "{n} valeurs hors liste.")
        for c, allowed in domains.items()
    ] + [
        (f"Modalités de {c}", f"greatest(count(distinct {c}) - {size}, 0)", False,
         "{n} modalités de trop.")
        for c, size in sizes.items()
    ]


def profile_of(columns: dict[str, str], source: str, order: str) -> str:
    """Column profile: column name -> type name."""
    return "\nunion all\n".join(
        f"select '{c}' as colonne, '{kind}' as type, count({c}) as valeurs_non_nulles, "
        f"count(*) - count({c}) as valeurs_manquantes, "
        f'{rate(f"count(*) - count({c})", "count(*)")} as "taux_manquant_%", '
        f"count(distinct {c}) as valeurs_distinctes, "
        f"arg_min({c}, {order}) filter (where {c} is not null)::varchar as exemple "
        f"from {source}"
        for c, kind in columns.items()
    )


def dimension(labels: list[str], key: str, name: str) -> str:
    rows = ", ".join(f"({i}, {quoted(x)})" for i, x in enumerate(labels, start=1))
    return f"select * from (values {rows}) as t({key}, {name})"


def members(mapping: Mapping, default: str) -> list[str]:
    return [*dict.fromkeys(mapping.values()), default]


DIMENSIONS = {
    "service": ("service_id", members(ref.SERVICE_LABELS, ref.UNKNOWN_M)),
    "pathologie": ("pathologie_id", members(ref.DIAGNOSIS_LABELS, ref.UNKNOWN_F)),
    "commune_residence": ("commune_id", members(ref.TOWN_LABELS, ref.UNKNOWN_F)),
    "tranche_age": ("tranche_id", [b[1] for b in ref.AGE_BANDS] + [ref.AGE_UNKNOWN]),
    "assurance": ("assurance_id", members(ref.INSURANCE_LABELS, ref.UNKNOWN_F)),
    "issue": ("issue_id", [*ref.OUTCOMES, ref.UNKNOWN_F]),
}


def day_key(col: str) -> str:
    return f"coalesce(strftime({col}, '%Y%m%d')::int, 0)"


def draw(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}::varchar), 1, 8))::bigint % 10000"


def journal() -> str:
    outliers = " || ', ' || ".join(f"'{c}: ' || {c}" for c in ref.BOUNDS)
    steps = [
        ("Extraction du fichier source", "n_raw", "n_raw", "'admissions.csv'"),
        ("Suppression des doublons", "n_raw", "n_kept",
         "(n_raw - n_uniq) || ' doublons stricts, ' || (n_uniq - n_kept) "
         "|| ' id_admission dupliqués'"),
        ("Normalisation des libellés", "n_kept", "n_kept",
         "unmatched || ' pathologies hors référentiel'"),
        ("Conversion des types", "n_kept", "n_kept", "'dates, numériques, identifiants'"),
        ("Neutralisation des valeurs aberrantes", "n_kept", "n_kept", outliers),
        ("Correction des incohérences", "n_kept", "n_kept",
         "inverted || ' chronologies inversées, ' || dated || ' durées reconstituées'"),
        ("Imputation", "n_kept", "n_kept",
         "imputed || ' durées (médiane par pathologie), ' || aged "
         "|| ' âges recalculés depuis la date de naissance'"),
    ]
    facts = (
        "select (select count(*) from raw) as n_raw, (select count(*) from uniq) as n_uniq, "
        "(select count(*) from kept) as n_kept, "
        f"(select count(*) from labelled where pathologie = '{ref.UNKNOWN_F}') as unmatched, "
        + ", ".join(f"(select {count} from typed) as {c}" for c, count in OUT.items())
        + ", (select count(*) from bounded where date_sortie < date_entree) as inverted, "
        "(select count(*) from ordered where duree_sejour_j is null and date_sortie is not null "
        "and date_entree is not null) as dated, "
        "(select count(*) from halfway where duree_imputee) as imputed, "
        "(select count(*) from halfway where age is null and date_naissance is not null) as aged"
    )
    return upto("cleaned", facts=facts) + "\n" + "\nunion all\n".join(
        f"select {i}::int as ordre, {quoted(name)} as etape, {before}::bigint as lignes_avant, "
        f"{after}::bigint as lignes_apres, ({after} - {before})::bigint as delta, "
        f"{detail} as detail from facts"
        for i, (name, before, after, detail) in enumerate(steps, start=1)
    )


def returns_of(source: str, row: str, key: str, at: str) -> str:
    """Rows with their delay since the key's previous row."""
    return (
        f"select {row}, {key}, {days('p', at)} as d from (select *, lag({at}) over "
        f"(partition by {key} order by {at}, {row}) as p from {source})"
    )


def orphaned(fact: str, foreign: str, dim: str, key: str) -> str:
    return (
        f"select '{foreign}' as cle_etrangere, count(distinct {foreign}) as cles_orphelines, "
        f"count(*) as lignes_orphelines from {fact} "
        f"where {foreign} not in (select {key} from {dim})"
    )


EVENTS = returns_of("events", "event_id", "user_id", "ts")
EVENT_ROWS = (
    f"select event_id, d as delai_j, {flag('d <= 1')} as est_retour_1j from ({EVENTS})"
)
CALENDAR = (
    "select distinct unnest([date_entree::date, date_sortie::date]) as jour from cleaned"
)
FACT = (
    "select id_admission, id_patient_pseudo, "
    f"{day_key('date_entree')} as entree_id, {day_key('date_sortie')} as sortie_id, "
    + ", ".join(f"{key}" for key, _ in DIMENSIONS.values())
    + ", age, duree_sejour_j, duree_imputee, temperature_entree_c, cout_hospitalisation_fcfa, "
    "cout_journalier_fcfa, sejour_prolonge, delai_readmission_j, est_readmission_30j from "
    f"(select * replace (case when issue in ({listed(ref.OUTCOMES)}) then issue "
    f"else '{ref.UNKNOWN_F}' end as issue) from prepared) "
    + " ".join(
        f"left join ({dimension(labels, key, name)}) using ({name})"
        for name, (key, labels) in DIMENSIONS.items()
    )
)
SECONDS = "round_even(duree_sejour_j * 86400, 0)::bigint"
BED_DAYS = (
    "select service, unnest(generate_series(date_entree::date::timestamp, "
    "greatest(date_entree::date, fin::date - 1)::timestamp, interval 1 day)) as jour "
    "from (select service, date_entree, coalesce(date_sortie, "
    f"date_entree + {SECONDS} * interval 1 second) as fin from cleaned) "
    "where date_entree is not null and fin is not null"
)
BEDS = ", ".join(f"({quoted(s)}, {n})" for s, n in ref.SERVICE_BEDS.items())
TARIFF = ", ".join(
    f"({quoted(s)}, {flat}::double, {daily}::double)"
    for s, (flat, daily) in ref.SERVICE_TARIFF.items()
)
MONTHLY = (
    f"select {GROUP} as categorie_pathologie, year(date_entree)::int as annee, "
    "month(date_entree)::int as mois, count(*) as sejours from cleaned "
    "where date_entree is not null group by all"
)
BANDS = [name for _, name, _, _ in ref.AGE_BANDS] + [ref.AGE_UNKNOWN]
RAW_PREPARED = f"{upto('prepared')} select {PREPARED} from prepared"

def portable(sql: str, dates: list[str] = (), integers: list[str] = ()) -> str:
    """Dates as text, integers that may be missing as doubles."""
    changes = [f"{c}::varchar as {c}" for c in dates]
    changes += [f"{c}::double as {c}" for c in integers]
    return f"select * replace ({', '.join(changes)}) from ({sql})"


ORACLES: dict[str, str] = {
    "event_return_delay": f"select user_id, count(*) as evenements, "
        f"count(*) filter (where d <= 1) as retours_1j, max(d) as delai_max_j "
        f"from ({EVENTS}) group by user_id",
    "event_return_rows": EVENT_ROWS,
    "event_return_rows_sliced": EVENT_ROWS,
    "stay_readmission": f"{STAYS} select seq, d as delai_readmission_j, "
        f"{flag('d <= 30')} as est_readmission_30j from "
        f"({returns_of('v', 'seq', 'o_custkey', 'e')})",
    "dedup_exact": f"{STAYS} select min(seq) as seq, * exclude (seq) from v "
        "group by all",
    "dedup_keep_last": f"{STAYS}, u as (select min(seq) as seq, * exclude (seq) from v "
        "group by all) select * from u qualify row_number() over "
        "(partition by k order by seq desc) = 1",
    "dedup_admissions": f"{upto('kept')} select * from kept",
    "dedup_documents": "select * exclude (text) from documents qualify row_number() over "
        "(partition by text order by doc_id desc) = 1",
    "duplicate_counts": f"{upto('uniq')} select (select count(*) from raw) as lignes, "
        "(select count(*) from raw) - (select count(*) from uniq) as doublons_stricts, "
        "(select sum(n - 1)::bigint from (select count(*) as n from raw group by id_admission))"
        " as cles_dupliquees",
    "duplicate_counts_documents": "select count(*) as lignes, count(*) - count(distinct "
        "(text, lang, source, n_chars)) as doublons_stricts, "
        "count(*) - count(distinct text) as cles_dupliquees from documents",
    "normalise_labels": f"{RAW_ONLY} select seq, "
        + ", ".join(f"{text} as {c}" for c, text in LABELS.items()) + " from raw",
    "normalise_segments": f"{STAYS} select seq, "
        f"{label('pathologie', views.SEGMENT_LABELS, ref.UNKNOWN_F)} as pathologie from v",
    "unmatched_labels": f"{RAW_ONLY} select "
        + ", ".join(
            f"count(*) filter (where coalesce({norm(r.column)}, '') not in "
            f"({listed(r.labels)})) as {r.column}" for r in admissions.LABEL_RULES
        ) + " from raw",
    "spelling_variants": f"{RAW_ONLY} select {norm('pathologie')} as libelle, "
        "pathologie as graphie, count(*) as lignes from raw where pathologie is not null "
        "group by pathologie",
    "spellings_of_label": f"{RAW_ONLY} select distinct pathologie as graphie from raw "
        f"where {norm('pathologie')} = 'paludisme simple'",
    "variant_counts": f"{RAW_ONLY} select {norm('commune_residence')} as libelle, "
        "count(distinct commune_residence) as graphies, count(*) as lignes from raw "
        "where commune_residence is not null group by 1",
    "recode_values": f"{STAYS} select seq, case service when '1-URGENT' then 'Urgent' "
        "when '5-LOW' then 'Low' else service end as service from v",
    "fold_label_accents": f"{RAW_ONLY} select seq, regexp_replace("
        f"strip_accents({LABELS['pathologie']}), '[^\\x00-\\x7F]', '', 'g') as pathologie from raw",
    "coerce_types": f"{RAW_TYPED} select seq, date_entree, date_sortie, date_naissance, age, "
        "cout_hospitalisation_fcfa, duree_sejour_j, temperature_entree_c, id_medecin from typed",
    "coerce_types_strict": f"{RAW_ONLY} select seq, "
        "try_strptime(date_entree, '%Y-%m-%d %H:%M:%S') as date_entree, "
        "try_strptime(date_sortie, '%Y-%m-%d %H:%M:%S') as date_sortie from raw",
    "null_outliers": f"{RAW_TYPED} select seq, {BOUNDED} from typed",
    "outlier_counts": f"{RAW_TYPED} select "
        + ", ".join(f"{count} as {c}" for c, count in OUT.items()) + " from typed",
    "null_line_outliers": "select l_orderkey, l_linenumber, "
        "case when l_extendedprice between 1000 and 50000 then l_extendedprice end "
        "as l_extendedprice, case when l_quantity between 2 and 49 then l_quantity end "
        "as l_quantity from lineitem",
    "fix_chronology": f"{STAYS}, o as (select seq, e, case when s < e then null else s end as s,"
        f" duree from v) select seq, e, s, coalesce(duree, {days('e', 's')}) as duree from o",
    "fix_shipping_chronology": "select l_orderkey, l_linenumber, l_partkey, o_orderdate, "
        f"l_shipdate, {days('o_orderdate', 'l_shipdate')} as delai_j from (select l_orderkey, "
        "l_linenumber, l_partkey, o_orderdate, case when l_shipdate < o_orderdate then null "
        "else l_shipdate end as l_shipdate from lineitem join orders on l_orderkey = o_orderkey)",
    "impute_durations": f"{upto('cleaned')} select seq, duree_sejour_j, duree_imputee, age "
        "from cleaned",
    "impute_segment_medians": f"{STAYS}, h as (select seq, pathologie, duree is null as "
        "duree_imputee, coalesce(duree, median(duree) over (partition by pathologie)) as f "
        "from v) select seq, pathologie, coalesce(f, (select median(f) from h)) as duree, "
        "duree_imputee from h",
    "impute_line_prices": "with h as (select l_orderkey, l_linenumber, l_partkey, l_returnflag,"
        " case when l_extendedprice between 0 and 90000 then l_extendedprice end as p "
        "from lineitem), g as (select *, median(p) over (partition by l_returnflag) as m "
        "from h) select l_orderkey, l_linenumber, l_partkey, l_returnflag, "
        "coalesce(p, m, (select median(coalesce(p, m)) from g)) as l_extendedprice, "
        "p is null as prix_impute from g",
    "clean_admissions": f"{upto('cleaned')} select {CLEAN_COLUMNS} from cleaned",
    "pseudonymise_admissions": f"{RAW_TYPED} select seq, {PSEUDONYM} as id_patient_pseudo, "
        "year(date_naissance)::int as annee_naissance, age, sexe from typed",
    "pseudonymise_customers": "select c_nationkey, c_acctbal, c_mktsegment, "
        f"substr(sha256('{SALT}' || c_custkey::varchar), 1, 16) as client_pseudo from customer",
    "pseudonymise_missing_as_text": f"{RAW_ONLY} select seq, substr(sha256('{SALT}' || "
        "coalesce(id_patient, 'nan')), 1, 16) as id_patient_pseudo from raw",
    "treatment_audit": f"{RAW_ONLY} select colonne, operation, justification, "
        "'2025-01-02T03:04:05' as horodatage, (select count(*) from raw) as "
        "nb_lignes_traitees, substr(md5('2025-01-02T03:04:05'), 1, 8) as execution_id from "
        "(values ('id_patient', 'Hachage SHA-256 salé', "
        "'Chaînage des séjours conservé sans identifiant direct'), "
        "('nom_patient', 'Suppression', 'Aucune valeur analytique (minimisation)'), "
        "('prenom_patient', 'Suppression', 'Aucune valeur analytique (minimisation)'), "
        "('telephone', 'Suppression', 'Aucune valeur analytique (minimisation)'), "
        "('date_naissance', 'Généralisation (année seule)', "
        "'Quasi-identifiant : date exacte réidentifiante')) "
        "as t(colonne, operation, justification)",
    "age_bands": f"{RAW_TYPED} select seq, age, {BAND} as tranche_age from typed",
    "month_season": f"{RAW_TYPED} select seq, date_entree, month(date_entree)::int as mois, "
        f"{choose('month(date_entree)', ref.SEASON_BY_MONTH)} as saison from typed",
    "diagnosis_groups": f"{RAW_ONLY} select seq, pathologie, {GROUP} as categorie_pathologie "
        f"from (select seq, {LABELS['pathologie']} as pathologie from raw)",
    "unit_cost": f"{STAYS} select seq, cout, duree, "
        "round_even(cout / nullif(duree, 0), 0) as cout_journalier from v",
    "long_stay_p90": f"{STAYS} select seq, service, duree, {flag('duree > q')} as "
        "sejour_prolonge from v join (select service as s2, quantile_cont(duree, 0.9) as q "
        "from v group by service) on service = s2",
    "long_lines_p90": "select l_orderkey, l_linenumber, l_partkey, "
        "strftime(l_shipdate, '%Y-%m') as mois_envoi, l_quantity > quantile_cont(l_quantity, 0.9) "
        "over (partition by strftime(l_shipdate, '%Y-%m')) as prolonge from lineitem",
    **dict.fromkeys(
        ("price_quantiles", "price_quantiles_cut"),
        "select l_returnflag, quantile_cont(l_extendedprice, 0.9) as p90 from lineitem "
        "group by l_returnflag",
    ),
    "enrich_admissions": RAW_PREPARED,
    "quality_report": f"{upto('prepared')} {report(admission_rules(False), 'prepared')}",
    "quality_report_raw": f"{RAW_TYPED} {report(admission_rules(True), 'typed')}",
    "quality_tally": f"{RAW_TYPED} select count(*) filter (where statut = 'OK') as "
        "regles_satisfaites, count(*) as regles from "
        f"({report(admission_rules(True), 'typed')})",
    "domain_report": f"{upto('cleaned')} {report(domain_rules(), 'cleaned')}",
    "column_profile": f"{RAW_ONLY} "
        + profile_of({c: "string" for c in ref.RAW_COLUMNS}, "raw", "seq"),
    "column_profile_approx": f"{RAW_ONLY} select * exclude (valeurs_distinctes), "
        "true as estimation_proche from ("
        + profile_of({c: "string" for c in ref.RAW_COLUMNS}, "raw", "seq") + ")",
    "column_profile_orders": profile_of(
        {"o_custkey": "bigint", "o_orderstatus": "string", "o_orderdate": "timestamp_ntz",
         "o_orderpriority": "string"}, "orders", "o_orderkey"),
    "audit_summary": f"{upto('uniq')} select n as lignes, 21 as colonnes, "
        "n - (select count(*) from uniq) as doublons_stricts, "
        "d as id_admission_dupliques, gaps as cellules_manquantes, "
        f'{rate("gaps", "n * 21")} as "taux_manquant_global_%" from (select count(*) as n, '
        "count(*) - count(distinct id_admission) - max((id_admission is null)::int) as d, ("
        + " + ".join(f"count(*) - count({c})" for c in ref.RAW_COLUMNS)
        + ") as gaps from raw)",
    "value_counts": f"{RAW_ONLY} select sexe, count(*) as effectif from raw group by sexe",
    "distinct_count": f"{RAW_ONLY} select count(distinct pathologie) as valeurs_distinctes "
        "from raw",
    "head_preview": f"{RAW_ONLY} select {RAW} from raw order by seq limit 3",
    "dataset_summary": f"{STAYS} select count(*) as lignes, min(e) as debut, max(e) as fin, "
        "count(distinct o_custkey) as o_custkey_distincts, "
        "count(distinct service) as service_distincts, "
        "count(distinct pathologie) as pathologie_distincts from v",
    "cleaning_journal": journal(),
    "dim_date": f"{upto('cleaned', days=CALENDAR)} select {day_key('jour')} as date_id, jour, "
        "year(jour)::int as annee, quarter(jour)::int as trimestre, month(jour)::int as mois, "
        f"{choose('month(jour)', ref.MONTH_NAMES)} as libelle_mois, "
        f"{choose('isodow(jour) - 1', ref.DAY_NAMES)} as libelle_jour, "
        "isodow(jour) >= 6 as week_end, "
        f"{choose('month(jour)', ref.SEASON_BY_MONTH)} as saison from days "
        "where jour is not null",
    "dim_service": f"{upto('cleaned')} select service, service_id, "
        f"{choose('service', ref.SERVICE_BEDS)}::int as lits, sejours from "
        f"({dimension(DIMENSIONS['service'][1], 'service_id', 'service')}) left join "
        "(select service, count(*) as sejours from cleaned group by service) using (service)",
    "dim_diagnosis": f"{upto('cleaned')} select pathologie, pathologie_id, "
        f"{GROUP} as categorie_pathologie, sejours from "
        f"({dimension(DIMENSIONS['pathologie'][1], 'pathologie_id', 'pathologie')}) left join "
        "(select pathologie, count(*) as sejours from cleaned group by pathologie) "
        "using (pathologie)",
    "dim_priority": "select row_number() over (order by o_orderpriority) as priorite_id, "
        "o_orderpriority from (select distinct o_orderpriority from orders)",
    "fact_admissions": f"{upto('prepared')} {FACT}",
    "fact_orders": "select o_orderkey, o_custkey, c_nationkey, "
        f"{day_key('o_orderdate')} as date_id, "
        "dense_rank() over (order by o_orderpriority) as priorite_id, o_totalprice "
        "from orders left join customer on o_custkey = c_custkey",
    "orphan_check": f"{upto('prepared', fact=FACT)} "
        + "\nunion all\n".join(
            f"select '{key}' as cle_etrangere, count(distinct {key}) as cles_orphelines, "
            f"count(*) as lignes_orphelines from fact where {key} is null or {key} not between "
            f"1 and {len(labels)}" for key, labels in DIMENSIONS.values()
        )
        + "".join(
            f"\nunion all\nselect '{key}_id', count(distinct {key}_id), count(*) from fact "
            f"where {key}_id is null" for key in ("entree", "sortie")
        ),
    "orphan_check_orders": "\nunion all\n".join([
        orphaned("lineitem", "l_orderkey", "orders", "o_orderkey"),
        orphaned("lineitem", "l_partkey", "part", "p_partkey"),
        orphaned("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        orphaned("orders", "o_custkey", "customer", "c_custkey"),
    ]),
    "orphan_check_found": orphaned(
        f"(select * replace ({views.LOST_ORDER} as l_orderkey) from lineitem)", "l_orderkey",
        "orders", "o_orderkey"),
    "dim_customer_two_loads": "with a as (select distinct o_custkey from orders where "
        "month(o_orderdate) % 2 = 0), b as (select distinct o_custkey from orders where "
        "o_custkey not in (select o_custkey from a)) "
        "select row_number() over (order by o_custkey) as client_id, o_custkey from a union all "
        "select (select count(*) from a) + row_number() over (order by o_custkey), o_custkey from b",
    "event_return_rows_two_loads": EVENT_ROWS,
    "normalise_long_list": "select c_custkey, case when c_custkey % 3 = 0 and c_custkey < 3000 "
        f"then 'Client ' || c_custkey else {quoted(ref.UNKNOWN_M)} end as client from customer",
    "gate_refusals": "select regle, violations, message from "
        f"({RAW_TYPED} {report(admission_rules(True), 'typed')}) where statut = 'ÉCHEC'",
    "distinct_of_two_loads": "select colonne, n > 0 as estimation_proche from (select count(*) as n "
        "from orders), (select unnest(['o_custkey', 'o_orderstatus', "
        "'o_totalprice', 'o_orderdate', 'o_orderpriority']) as colonne)",
    "csv_long_text_order": "select source, doc_id, md5(text) as md5 from documents qualify "
        "row_number() over (partition by source order by doc_id desc) = 1",
    "census_by_month": f"{upto('cleaned', bd=BED_DAYS)}, n as (select service, jour::date as jour, "
        "count(*) as lits from bd group by 1, 2), "
        "span as (select service, unnest(generate_series(date_trunc('month', min(jour))::timestamp, "
        "last_day(max(jour))::timestamp, interval 1 day))::date as jour from n group by service) "
        "select s.service, year(s.jour)::int as annee, month(s.jour)::int as mois, "
        "max(coalesce(lits, 0)) as lits_max, min(coalesce(lits, 0)) as lits_min, "
        "sum(coalesce(lits, 0))::bigint as journees_lit from span s left join n on "
        "s.service is not distinct from n.service and s.jour = n.jour group by 1, 2, 3",
    "dim_order": "select row_number() over (order by o_orderkey) as commande_id, o_orderkey "
        "from (select distinct o_orderkey from orders)",
    "csv_long_text_roundtrip": "select doc_id, md5(text) as md5 from documents",
    "sorted_admissions": f"{upto('cleaned')} select id_admission, date_entree, row_number() over "
        "(order by date_entree nulls last, id_admission nulls last) as position from cleaned",
    "warehouse_load_gated": f"{upto('prepared')} select coalesce(year(date_entree), 0)::int as "
        "annee, count(*) as sejours from prepared group by 1",
    "event_returns_by_day": "select event_id, user_id, d as delai_j from ("
        + returns_of("(select event_id, user_id, date_trunc('day', ts)::timestamp as jour "
                     "from events)", "event_id", "user_id", "jour") + ")",
    "occupancy_by_month": f"{upto('cleaned', bd=BED_DAYS)}, used as (select service, "
        "date_trunc('month', jour)::date as m, count(*) as n from bd group by 1, 2), "
        "every as (select service, unnest(generate_series(min(m)::timestamp, "
        "max(m)::timestamp, interval 1 month))::date as m from used group by service) "
        "select service, year(m)::int as annee, month(m)::int as mois, journees_lit, "
        f"lits::int as lits, {rate('journees_lit', 'lits * day(last_day(m))')} as "
        "taux_occupation from (select e.service, e.m, coalesce(n, 0) as journees_lit from "
        "every e left join used u on e.service is not distinct from u.service and e.m = u.m) "
        f"left join (values {BEDS}) as t(service, lits) using (service)",
    "burden_by_diagnosis": f"{upto('cleaned')} select pathologie, count(*) as sejours, "
        f"{rate('count(*)', '(select count(*) from cleaned)')} as part_pct, "
        f"count(*) filter (where issue = '{ref.DEATH}') as deces, "
        + rate(f"count(*) filter (where issue = '{ref.DEATH}')", "count(*)")
        + " as letalite_pct, "
        "round_even(avg(duree_sejour_j) * 100, 0) / 100 as duree_moyenne, "
        "round_even(median(duree_sejour_j) * 100, 0) / 100 as duree_mediane, "
        "round_even(sum(cout_hospitalisation_fcfa), 0) as cout_total "
        "from cleaned group by pathologie",
    "seasonality_index": f"{upto('cleaned', m=MONTHLY)}, "
        "span as (select categorie_pathologie, min(annee * 12 + mois - 1) as low, "
        "max(annee * 12 + mois - 1) as high from m group by 1), "
        "every as (select categorie_pathologie, unnest(range(low, high + 1)) as k from span), "
        "f as (select e.categorie_pathologie, k, (k // 12)::int as annee, "
        "(k % 12 + 1)::int as mois, coalesce(m.sejours, 0) as sejours from every e left join m "
        "on m.categorie_pathologie = e.categorie_pathologie and m.annee * 12 + m.mois - 1 = k) "
        "select a.categorie_pathologie, a.annee, a.mois, a.sejours, "
        "round_even(a.sejours / avg(a.sejours) over (partition by a.categorie_pathologie) "
        "* 1000, 0) / 1000 as indice_saisonnier, b.sejours as sejours_an_passe, "
        f"{rate('a.sejours - b.sejours', 'nullif(b.sejours, 0)')} as evolution_pct "
        "from f a left join f b "
        "on a.categorie_pathologie = b.categorie_pathologie and a.k = b.k + 12",
    "diagnosis_by_age": f"{upto('cleaned', b=f'select pathologie, {BAND} as t from cleaned')} "
        "select pathologie, "
        + ", ".join(f'count(*) filter (where t = {quoted(x)}) as "{x}"' for x in BANDS)
        + f", count(*) filter (where t is null or t not in ({listed(BANDS)})) as autres "
        "from b group by pathologie",
    "diagnosis_age_totals":
        f"{upto('cleaned', b=f'select pathologie, {BAND} as tranche_age from cleaned')} "
        "select pathologie, tranche_age, grouping(pathologie, tranche_age)::int as niveau, "
        "count(*) as sejours from b group by cube (pathologie, tranche_age)",
    "inject_defects": "select o_orderkey, "
        f"case when {draw('o_orderkey', 13)} < 140 then -1.0::double else o_totalprice end "
        f"as o_totalprice, case when {draw('o_orderkey', 2)} < 310 then null "
        f"else o_orderstatus end as o_orderstatus, case when {draw('o_orderkey', 6)} < 600 "
        "then lower(o_orderpriority) else o_orderpriority end as o_orderpriority from orders",
    "inject_duplicates": "select o_orderkey, o_custkey, o_orderdate from orders union all "
        "select o_orderkey, o_custkey, o_orderdate from orders where "
        f"{draw('o_orderkey', 16)} < 200",
    "shuffle_orders": "select o_orderkey, o_custkey from orders",
    "null_exit_on_death": f"{STAYS} select seq, issue, "
        "case when issue = 'F' then null else s end as s from v",
    "shift_exit": f"{STAYS} select seq, e, duree, "
        "e + round_even(duree * 86400, 0)::bigint * interval 1 second as s from v",
    "expected_cost": f"{upto('cleaned')} select id_admission, service, duree_sejour_j, "
        "round_even((flat + daily * duree_sejour_j) / 100, 0) * 100 as cout_attendu "
        f"from cleaned left join (values {TARIFF}) as t(sv, flat, daily) on service = sv",
    "csv_roundtrip": f"{RAW_ONLY} select {RAW} from raw",
    "csv_header_roundtrip": "select c_custkey::varchar as c_custkey, c_name, c_mktsegment "
        "from customer",
    "csv_file_order": f"{upto('kept')} select {RAW} from kept",
    "parquet_hand_off": f"{RAW_TYPED} select seq, id_admission, date_entree, duree_sejour_j, "
        "age from typed",
    "full_run_from_csv": RAW_PREPARED,
    "full_run": RAW_PREPARED,
    "warehouse_load": f"{upto('prepared')} select coalesce(year(date_entree), 0)::int as annee, "
        "count(*) as sejours, count(distinct id_patient_pseudo) as patients from prepared "
        "group by 1",
}

ORACLES["orphan_check_by_words"] = ORACLES["orphan_check_found"]
ORACLES["resumed_journal"] = ORACLES["cleaning_journal"]
for _name in ("coerce_types", "clean_admissions"):
    ORACLES[_name] = portable(ORACLES[_name], dates=["date_naissance"])
for _name in ("enrich_admissions", "full_run", "full_run_from_csv"):
    ORACLES[_name] = portable(ORACLES[_name], integers=["annee_naissance", "mois"])
ORACLES["dim_date"] = portable(ORACLES["dim_date"], ["jour"], ["mois"])
ORACLES["pseudonymise_admissions"] = portable(
    ORACLES["pseudonymise_admissions"], integers=["annee_naissance"]
)
ORACLES["month_season"] = portable(ORACLES["month_season"], integers=["mois"])
ORACLES["dim_service"] = portable(ORACLES["dim_service"], integers=["lits"])
ORACLES["census_by_month"] = portable(ORACLES["census_by_month"], integers=["mois"])
ORACLES["occupancy_by_month"] = portable(
    ORACLES["occupancy_by_month"], integers=["lits", "mois"]
)
ORACLES["seasonality_index"] = portable(
    ORACLES["seasonality_index"], integers=["mois", "sejours_an_passe"]
)
