import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from wardflow import reference as ref
from wardflow.operators import privacy, quality
from wardflow.plans import admissions

COLUMNS = (
    "id_admission string, age double, duree_sejour_j double, date_entree timestamp_ntz, "
    "date_sortie timestamp_ntz, issue string, pathologie string, temperature_entree_c double"
)
DAY = dt.datetime(2024, 1, 1)
GOOD = ("A1", 30.0, 2.0, DAY, DAY + dt.timedelta(days=2), "Gueri", "Fracture", 37.0)


def changed(**new):
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    return tuple(new.get(name, value) for name, value in zip(names, GOOD))


def test_pseudonym_is_the_salted_digest(frame):
    df = frame([("PAT000001",), (None,)], "id string")
    got = [r.p for r in privacy.add_pseudonym(df, "id", "p", "sel").collect()]
    assert got == ["aae73a8216b18b13", None]
    as_text = privacy.add_pseudonym(df, "id", "p", "sel", missing_text="nan").collect()
    assert as_text[1].p == hashlib.sha256(b"selnan").hexdigest()[:16]


def test_pseudonyms_do_not_depend_on_partitions(spark):
    ids = spark.range(500).select(F.col("id").cast("string"))
    one = {r.p for r in privacy.add_pseudonym(ids.coalesce(1), "id", "p", "s").collect()}
    many = {r.p for r in privacy.add_pseudonym(ids.repartition(9), "id", "p", "s").collect()}
    assert one == many and len(one) == 500


@pytest.mark.parametrize("mode", ["simple", "extended", "formatted", "codegen", "cost"])
def test_salt_is_in_no_plan(frame, mode):
    df = privacy.add_pseudonym(frame([("a",)], "id string"), "id", "p", "very-secret-salt")
    assert "very-secret-salt" not in plan_text(df, mode)


def test_salt_is_required(monkeypatch):
    monkeypatch.delenv(ref.SALT_VARIABLE, raising=False)
    with pytest.raises(ValueError):
        admissions.sel_requis()
    monkeypatch.setenv(ref.SALT_VARIABLE, "from-env")
    assert admissions.sel_requis() == "from-env"
    assert admissions.sel_requis("given") == "given"


def test_pseudonymise_drops_and_audits(frame):
    df = frame(
        [("P1", "N", "F", "0", dt.date(1990, 5, 1), 3)],
        "id_patient string, nom_patient string, prenom_patient string, telephone string, "
        "date_naissance date, x int",
    )
    masked, audit = admissions.pseudonymiser(df, "sel")
    assert masked.columns == ["x", "id_patient_pseudo", "annee_naissance"]
    assert masked.first().annee_naissance == 1990
    assert admissions.verifier_absence_donnees_personnelles(masked)
    rows = audit.collect()
    assert [r.colonne for r in rows] == [
        "id_patient", "nom_patient", "prenom_patient", "telephone", "date_naissance"]
    assert {r.nb_lignes_traitees for r in rows} == {1}
    stamp = rows[0].horodatage
    assert rows[0].execution_id == hashlib.md5(stamp.encode()).hexdigest()[:8]


def test_gate_raises_on_each_personal_column(frame):
    for column in admissions.PERSONAL:
        with pytest.raises(AssertionError, match=column):
            admissions.verifier_absence_donnees_personnelles(frame([("x",)], f"{column} string"))


def test_clean_rows_pass_every_rule(frame):
    report = admissions.controler_qualite(frame([GOOD], COLUMNS))
    assert {r.statut for r in report.collect()} == {"OK"}
    assert quality.passed(report).first().regles_satisfaites == 8


@pytest.mark.parametrize(
    "rule, bad, faults",
    [
        (0, [GOOD], 1),
        (2, [changed(id_admission="A2", age=111.0), changed(id_admission="A3", age=None)], 1),
        (3, [changed(id_admission="A2", duree_sejour_j=0.0),
             changed(id_admission="A3", duree_sejour_j=None)], 2),
        (4, [changed(id_admission="A2", date_sortie=DAY - dt.timedelta(days=1))], 1),
        (5, [changed(id_admission="A2", issue=None), changed(id_admission="A3", issue="?")], 2),
    ],
)
def test_blocking_rules(frame, rule, bad, faults):
    df = frame([GOOD, *bad], COLUMNS)
    rows = admissions.controler_qualite(df, bloquant=False).collect()
    assert [r.violations for r in rows] == [faults if i == rule else 0 for i in range(8)]
    assert rows[rule].statut == "ÉCHEC" and rows[rule].criticite == "bloquante"
    with pytest.raises(ValueError, match=rows[rule].regle[:2]):
        admissions.controler_qualite(df)


def test_personal_column_fails_rule_two(frame):
    df = frame([GOOD], COLUMNS).withColumn("telephone", F.lit("0"))
    rows = admissions.controler_qualite(df, bloquant=False).collect()
    assert rows[1].violations == 1 and "2019-992" in rows[1].message


def test_informative_rules_do_not_block(frame):
    df = frame([changed(pathologie=ref.UNKNOWN_F, temperature_entree_c=None)], COLUMNS)
    rows = admissions.controler_qualite(df).collect()
    assert [r.statut for r in rows[6:]] == ["AVERTISSEMENT"] * 2
    assert rows[7].message == "1 températures non relevées (1 dossiers incomplets)."


def test_report_is_one_aggregation_and_one_over_the_key(frame):
    plan = plan_text(admissions.rapport_qualite(frame([GOOD], COLUMNS)), "simple")
    assert plan.count("Scan") == 2 and plan.count("hashpartitioning(id_admission") == 1
    assert "Expand" not in plan


def test_null_keys_repeat_each_other(frame):
    df = frame([(None,), (None,), ("a",)], "k string")
    assert quality.repeats("k")(df).first()[0] == 1


def test_domains_and_modalities(frame):
    df = frame([("x",), ("y",), (None,)], "c string")
    rules = quality.domain_rules({"c": ["x"]}) + quality.modality_rules({"c": 1})
    assert [r.violations for r in quality.quality_report(df, rules).collect()] == [2, 1]


def test_empty_table_is_reported(frame):
    rows = admissions.controler_qualite(frame([], COLUMNS), bloquant=False).collect()
    assert [r.violations for r in rows] == [0] * 8
