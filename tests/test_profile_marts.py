import datetime as dt

from pyspark.sql import functions as F

from wardflow import reference as ref
from wardflow.functions import draws
from wardflow.operators import defects, labels, marts, profile, star

D = dt.datetime


def test_profile_by_hand(frame):
    rows = [(2, "b", 1.0), (1, None, 0.0), (3, "b", -0.0), (4, "a", None)]
    df = frame(rows, "seq int, s string, x double")
    exact = {r.colonne: r for r in profile.column_profile(df, "seq").collect()}
    assert tuple(exact["s"]) == ("s", "string", 3, 1, 25.0, 2, "b")
    assert tuple(exact["x"]) == ("x", "double", 3, 1, 25.0, 2, "0.0")
    rough = {r.colonne: r for r in profile.column_profile(df, "seq", approx=True).collect()}
    assert {k: tuple(v) for k, v in rough.items()} == {k: tuple(v) for k, v in exact.items()}


def test_profile_of_an_all_null_column(frame):
    df = frame([(1, None), (2, None)], "seq int, s string")
    assert tuple(profile.column_profile(df, "seq").first()) == (
        "s", "string", 0, 2, 100.0, 0, None)


def test_audit_summary_by_hand(frame):
    rows = [(1, "a", None), (2, "a", None), (3, "a", 1), (4, None, 2), (5, None, 3)]
    got = profile.audit_summary(frame(rows, "seq int, k string, x int"), "k", "seq").first()
    assert got.asDict() == {
        "lignes": 5, "colonnes": 2, "doublons_stricts": 1, "k_dupliques": 3,
        "cellules_manquantes": 4, "taux_manquant_global_%": 40.0,
    }


def test_counts_include_null(frame):
    df = frame([("a",), (None,), (None,)], "c string")
    assert [(r.c, r.effectif) for r in profile.value_counts(df, "c").collect()] == [
        (None, 2), ("a", 1)]
    assert profile.distinct_count(df, "c").first()[0] == 1


def test_head_follows_file_order(frame):
    df = frame([(3, "c"), (1, "a"), (2, "b")], "seq int, c string")
    assert [r.c for r in profile.head(df, "seq", 2).collect()] == ["a", "b"]


def test_variants(frame):
    df = frame([("A b",), (" a  B ",), ("A b",), (None,), ("c",)], "t string")
    got = {r.libelle: (r.graphies, r.lignes) for r in labels.variant_counts(df, "t").collect()}
    assert got == {"a b": (2, 3), "c": (1, 1)}
    assert {r.graphie for r in labels.variants_of(df, "t", "a b").collect()} == {"A b", " a  B "}


def test_bed_days_match_a_day_by_day_count(frame):
    stays = [
        ("u", D(2024, 1, 30, 8), D(2024, 3, 2, 9)),
        ("u", D(2024, 2, 10, 8), D(2024, 2, 10, 20)),
        ("v", D(2023, 12, 31, 23), D(2024, 1, 1, 1)),
        ("v", D(2024, 1, 1), None),
    ]
    expected = {}
    for unit, start, end in stays:
        if end is None:
            continue
        day, last = start.date(), max(start.date(), end.date() - dt.timedelta(days=1))
        while day <= last:
            key = (unit, day.replace(day=1))
            expected[key] = expected.get(key, 0) + 1
            day += dt.timedelta(days=1)
    df = frame(stays, "u string, a timestamp_ntz, b timestamp_ntz")
    got = {(r.u, r.mois_debut): r.journees_lit for r in marts.bed_days(df, "u", "a", "b").collect()}
    assert got == expected
    rate = {(r.annee, r.mois): r.taux_occupation
            for r in marts.occupancy(df, "u", "a", "b", {"u": 2}).where("u = 'u'").collect()}
    assert rate[2024, 2] == round(30 / 58 * 100, 2)


def test_burden_is_the_same_either_way(frame):
    rows = [("a", 1.0, 10.0, "Deces"), ("a", 4.0, None, "x"), ("a", None, 5.0, None),
            ("b", 2.5, 1.0, "x")]
    df = frame(rows, "p string, d double, c double, o string")
    both = [
        sorted(tuple(r) for r in marts.burden(
            df, "p", "d", "c", "o", "Deces", direct_rows=limit).collect())
        for limit in (0, None)
    ]
    assert both[0] == both[1] == [
        ("a", 3, 75.0, 1, 33.33, 2.5, 2.5, 15.0), ("b", 1, 25.0, 0, 0.0, 2.5, 2.5, 1.0)]


def test_seasonality_looks_back_a_year(frame):
    rows = [("p", D(2023, 5, 1))] * 2 + [("p", D(2024, 5, 1))] * 3 + [("p", D(2024, 6, 1))]
    got = {(r.annee, r.mois): r for r in marts.seasonality(
        frame(rows, "g string, at timestamp_ntz"), "at", "g").collect()}
    assert (got[2024, 5].sejours_an_passe, got[2024, 5].evolution_pct) == (2, 50.0)
    assert got[2024, 6].sejours_an_passe == 0 and got[2024, 6].evolution_pct is None
    assert got[2024, 4].sejours_an_passe is None and got[2024, 4].sejours == 0
    assert len(got) == 14 and got[2024, 5].indice_saisonnier == 7.0


def test_crossings(frame):
    df = frame([("r", "x"), ("r", "x"), ("s", "y"), ("s", None)], "a string, b string")
    assert sorted(tuple(r) for r in marts.crossing(df, "a", "b", ["x", "y"]).collect()) == [
        ("r", 2, 0, 0), ("s", 0, 1, 1)]
    assert sorted(tuple(r) for r in marts.crossing(df, "a", "b", ["x"], "z").collect()) == [
        ("r", 2, 0), ("s", 0, 2)]
    totals = {(r.a, r.b, r.niveau): r.sejours
              for r in marts.crossing_totals(df, "a", "b").collect()}
    assert totals[None, None, 3] == 4 and totals["s", None, 1] == 2
    assert totals["s", None, 0] == 1 and totals[None, None, 2] == 1


def test_observed_values_are_numbered_in_order(spark):
    rows = spark.range(30_000).selectExpr("(id * 7919) % 20011 as v").repartition(6)
    got = star.observed_dimension(rows, "v", "k").collect()
    assert sorted((r.k, r.v) for r in got) == [(i + 1, i) for i in range(20011)]
    assert star.observed_dimension(rows.where("v < 0"), "v", "k").count() == 0


def test_dimensions_and_orphans(frame, spark):
    dates = star.date_dimension(
        frame([(D(2024, 3, 2, 5),), (D(2024, 3, 2, 9),), (None,)], "at timestamp_ntz"),
        "at", ref.MONTH_NAMES, ref.DAY_NAMES, ref.SEASON_BY_MONTH,
    ).collect()
    assert len(dates) == 1
    day = dates[0]
    assert (day.date_id, day.libelle_mois, day.libelle_jour, day.week_end, day.trimestre) == (
        20240302, "mars", "samedi", True, 1)
    dim = star.list_dimension(spark, ["a", "b", "a"], "id", "name", {"n": ({"a": 5}, "int")})
    assert [tuple(r) for r in dim.collect()] == [(1, "a", 5), (2, "b", None)]
    fact = star.with_dimension_key(
        frame([("a", 1), ("z", 2)], "name string, x int"), dim, "name", "id", max_rows=2)
    assert fact.columns == ["id", "x"]
    report = star.orphan_report(
        frame([(1,), (7,), (7,)], "id int"), {"id": (dim, "id")}).first()
    assert (report.cles_orphelines, report.lignes_orphelines) == (1, 2)


def test_defects_hit_a_share_and_repeat_exactly(spark):
    df = spark.range(10_000).withColumn("x", F.lit("ok"))
    defect = defects.Defect("x", F.lit(None).cast("string"), 0.1, 4)
    once = defects.inject(df, "id", [defect])
    hits = {r.id for r in once.where("x is null").collect()}
    again = {r.id for r in defects.inject(df.repartition(3), "id", [defect])
             .where("x is null").collect()}
    assert hits == again and 800 < len(hits) < 1200
    copies = defects.inject_duplicates(df, "id", 0.1, 4)
    assert copies.count() == 10_000 + len(hits)
    shuffled = [r.id for r in defects.shuffle_rows(df, "id", 1).collect()]
    assert sorted(shuffled) == list(range(10_000)) != shuffled
    assert df.where(draws.chosen(F.col("id"), 4, 0.0)).isEmpty()


def test_shift_tariff_and_conditional_null(frame):
    df = frame([("Urgences", D(2024, 1, 1), 1.5, "Deces"), ("?", None, 2.0, None)],
               "u string, a timestamp_ntz, d double, o string")
    df = defects.add_shifted(df, "a", "d", "b")
    df = defects.add_expected_cost(df, "u", "d", ref.SERVICE_TARIFF, "c")
    df = defects.null_when(df.withColumn("e", F.col("b")), "e", F.col("o") == "Deces")
    first = df.where("u = 'Urgences'").first()
    assert (first.b, first.c, first.e) == (D(2024, 1, 2, 12), 52_000.0, None)
    other = df.where("u = '?'").first()
    assert other.c is None and other.b is None
