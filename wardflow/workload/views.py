"""Dirty views over the clean test tables.

The tables hold no nulls, duplicates or misspellings, so the defects the
operators repair are put in by expressions on the order key. Every row of the
tables is used. The texts run on Spark and on DuckDB: tables are written
``{orders}`` and ``{customer}``, and the one expression that differs, turning a
list of copy numbers into rows, is written ``{copies}``.
"""

from __future__ import annotations

from wardflow import reference as ref

# A re-issued row's position lies this far after its original's.
REISSUE = 1_000_000_000_000

# Some lines refer to orders that are not there.
LOST_ORDER = "case when (l_orderkey + l_linenumber) % 11 = 0 then -l_orderkey - 1 else l_orderkey end"

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEGMENT_LABELS = {name.lower(): name.capitalize() for name in SEGMENTS}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# Copies of an order: itself, an exact duplicate (1), a re-issue with another
# cost (2) and a late exact duplicate (3).
COPIES = (
    "0, case when k % 50 = 0 then 1 end, case when k % 60 = 0 then 2 end, "
    "case when k % 300 = 0 then 3 end"
)
ON_SPARK = f"explode(array_compact(array({COPIES})))"
ON_DUCKDB = f"unnest(list_filter([{COPIES}], lambda x: x is not null))"

# Orders seen as stays, few columns, typed.
STAYS = f"""
with b as (
  select o_orderkey k, o_custkey,
    o_orderdate + (o_orderkey*37 % 1440) * interval '1' minute as e,
    case when o_orderkey % 19 = 0 then cast(null as double)
         when o_orderkey % 113 = 0 then cast(-5.0 as double)
         else cast(o_orderkey % 137 as double)/10 end duree,
    case when o_orderkey % 7 = 0 then upper(c_mktsegment)
         when o_orderkey % 7 = 1 then concat('  ', lower(c_mktsegment), ' ')
         else c_mktsegment end pathologie,
    o_orderpriority service,
    case when o_orderkey % 71 = 0 then cast(-1 as double) else o_totalprice end cout,
    case when o_orderkey % 83 = 0 then null else o_orderstatus end issue,
    case when o_orderkey % 97 = 0 then '31/02/1999'
         else concat(cast(1 + o_orderkey % 28 as string), '/',
                     cast(1 + o_orderkey % 12 as string), '/',
                     cast(1930 + o_orderkey % 60 as string)) end naiss
  from {{orders}} join {{customer}} on o_custkey = c_custkey),
f as (
  select *, e + (k % 1000)*12 * interval '1' minute
         - (case when k % 125 = 0 then 30 else 0 end) * interval '1' day as s,
         {{copies}} as copy from b)
select k + copy*{REISSUE} as seq, k, o_custkey, e, duree, pathologie, service,
       case when copy = 2 then cout+1 else cout end as cout, issue, naiss, s
from f
"""


def _one_of(number: str, texts: list[str], other: str) -> str:
    """Expression that picks a text by its place in the list, from 0."""
    return f"split_part('{'|'.join([*texts, other])}', '|', cast({number} as int) + 1)"


RAW_DIAGNOSES = [text.capitalize() for text in ref.DIAGNOSIS_LABELS]
RAW_SERVICES = [text.capitalize() for text in ref.SERVICE_LABELS]
RAW_TOWNS = [text.capitalize() for text in ref.TOWN_LABELS]
RAW_SEXES = ["M", "F", "Masculin", "feminin", "f", "H", " Homme ", "Femme", "m"]
RAW_INSURANCES = ["CMU", "Aucune", "  aucune ", "MUTUELLE  EMPLOYEUR", "Assurance privee"]

# Orders seen as raw hospital admissions: the 21 text columns of the file, with
# each defect of the cleaning's list, and the row order in ``seq``.
ADMISSION_ORDERS = """
  select o_orderkey k, o_custkey cu, c_name nm, o_totalprice tp, o_orderkey % 130 + 1 as m,
    o_orderdate + (o_orderkey*37 % 1440) * interval '1' minute as e
  from {orders} join {customer} on o_custkey = c_custkey"""
ADMISSION_CELLS = f"""
    case when k % 501 = 0 then e + interval '60' minute
         else e + m*144 * interval '1' minute
              - (case when k % 125 = 0 then 30 else 0 end) * interval '1' day end as s,
    {_one_of('k*7 % 32', RAW_DIAGNOSES, 'Mal inconnu')} as patho,
    {_one_of('k*5 % 18', RAW_TOWNS, 'Ailleurs')} as town,
    {_one_of('k*5 % 9', RAW_SERVICES, 'Accueil')} as unit"""
ADMISSION_TEXTS = f"""
f as (
  select
    case when k % 977 = 0 then null
         else concat('ADM', lpad(cast(k as string), 9, '0')) end as id_admission,
    case when k % 151 = 0 then null
         else concat('PAT', lpad(cast(cu as string), 9, '0')) end as id_patient,
    nm as nom_patient,
    concat('Prenom ', cast(cu % 50 as string)) as prenom_patient,
    case when k % 97 = 0 then '31/02/1999'
         when k % 101 = 0 then null
         when k % 103 = 0 then '1/2/20'
         else concat(cast(1 + k % 28 as string), '/', cast(1 + k % 12 as string), '/',
                     cast(1930 + k % 60 as string)) end as date_naissance,
    case when k % 13 = 0 then null
         when k % 91 = 0 then '-3'
         when k % 97 = 0 then '999'
         when k % 29 = 0 then '4.5'
         else cast(k % 100 as string) end as age,
    case when k % 14 = 9 then null
         else {_one_of('k % 10', RAW_SEXES, 'X')} end as sexe,
    concat('+225 0', cast(cu as string)) as telephone,
    case when k % 7 = 0 then upper(town)
         when k % 7 = 1 then concat(chr(9), town, chr(160))
         else town end as commune_residence,
    case when k % 53 = 0 then null
         else {_one_of('k % 6', RAW_INSURANCES, 'autre')} end as assurance,
    {_one_of('k % 4', ref.ADMISSION_MODES, 'Inconnu')} as mode_admission,
    case when k % 307 = 0 then 'date inconnue' else cast(e as string) end as date_entree,
    case when k % 10 = 0 or k % 41 = 0 then null else cast(s as string) end as date_sortie,
    case when k % 19 = 0 or k % 501 = 0 then null
         when k % 113 = 0 then '-5.0'
         when k % 127 = 0 then '365.0'
         when k % 131 = 0 then 'inconnue'
         when k % 137 = 0 then '3.5d'
         else cast(cast(m as double)/10 as string) end as duree_sejour_j,
    case when k % 6 = 0 then upper(unit) else unit end as service,
    case when k % 7 = 0 then upper(patho)
         when k % 7 = 1 then concat('  ', patho, ' ')
         else patho end as pathologie,
    {_one_of('k % 5', ref.SEVERITIES, 'Autre')} as gravite,
    case when k % 31 = 0 then null
         when k % 37 = 0 then '   '
         else concat(' MED', lpad(cast(k % 120 as string), 3, '0')) end as id_medecin,
    case when k % 35 = 0 then null
         when k % 167 = 0 then '89.0'
         when k % 173 = 0 then '0.0'
         else cast(cast(360 + k % 50 as double)/10 as string) end
      as temperature_entree_c,
    case when copy = 2 then '777'
         when k % 71 = 0 then '-1'
         when k % 73 = 0 then '0'
         else cast(cast(floor(tp) as bigint) as string) end as cout_hospitalisation_fcfa,
    case when k % 83 = 0 then null
         when k % 89 = 0 then 'Evade'
         when k % 10 = 0 then 'Deces'
         when k % 10 = 1 then 'Transfert'
         when k % 10 = 2 then 'Sortie contre avis'
         else 'Gueri' end as issue,
    k + copy*{REISSUE} as seq
  from d)
select * from f
"""
ADMISSIONS = f"""
with b as ({ADMISSION_ORDERS}),
d as (
  select *,{ADMISSION_CELLS},
    {{copies}} as copy
  from b),{ADMISSION_TEXTS}"""

# The same in two steps: copies of orders with their row order, and the 21 columns of
# ``{rows}``, which hold the former.
ADMISSION_COPIES = f"""
with b as ({ADMISSION_ORDERS}),
c as (select *, {{copies}} as copy from b)
select *, k + copy*{REISSUE} as seq from c
"""
ADMISSIONS_OF = f"""
with d as (
  select *,{ADMISSION_CELLS}
  from {{rows}}),{ADMISSION_TEXTS}"""


def on_spark(text: str) -> str:
    """Text for Spark, with the table placeholders left in."""
    return text.replace("{copies}", ON_SPARK)


def on_duckdb(text: str) -> str:
    return text.format(orders="orders", customer="customer", copies=ON_DUCKDB)
