import datetime as dt

from wardflow import reference as ref
from wardflow.operators import enrich, impute, labels, values
from wardflow.plans import admissions

D = dt.datetime
STAY = "i int, a timestamp_ntz, b timestamp_ntz, d double"


def test_types_and_blank_default(frame):
    df = frame(
        [(1, "2024-01-01 10:00:00", "3.5", "  "), (2, "x", "3,5", None), (3, None, "NaN", " M1 ")],
        "i int, t string, n string, doc string",
    )
    got = values.coerce_types(df, timestamps=["t"], numbers=["n"], blank_defaults={"doc": "?"})
    rows = {r.i: (r.t, r.n, r.doc) for r in got.collect()}
    assert rows == {1: (D(2024, 1, 1, 10), 3.5, "?"), 2: (None, None, "?"), 3: (None, None, "M1")}


def test_bounds_are_closed_and_rows_are_kept(frame):
    raw = [0.0, 0.1, 90.0, 90.1, None]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, d double")
    got = values.null_outside(df, {"d": (0.1, 90)}).orderBy("i").collect()
    assert [r.d for r in got] == [None, 0.1, 90.0, None, None]
    flags = df.select("i", values.outside("d", 0.1, 90).alias("o")).orderBy("i").collect()
    assert [r.o for r in flags] == [True, False, False, True, False]


def test_inverted_dates_and_durations(frame):
    rows = [
        (1, D(2024, 1, 3), D(2024, 1, 1), None),           # exit before entry
        (2, D(2024, 1, 1), D(2024, 1, 1, 1, 12), None),    # 72 minutes: a tie at 0.05
        (3, D(2024, 1, 1), D(2024, 1, 4, 12), None),
        (4, D(2024, 1, 1), D(2024, 1, 4), 9.0),            # known: left alone
        (5, None, D(2024, 1, 4), None),
    ]
    got = values.fix_chronology(frame(rows, STAY), "a", "b", "d").orderBy("i").collect()
    assert [r.d for r in got] == [None, 0.0, 3.5, 9.0, None]
    assert [r.b is None for r in got] == [True, False, False, False, False]


def test_inverted_exit_takes_the_group_median(frame):
    rows = [("x", D(2024, 1, 3), D(2024, 1, 1), None), ("x", None, None, 4.0)]
    df = frame(rows, "k string, a timestamp_ntz, b timestamp_ntz, d double")
    fixed = values.fix_chronology(df, "a", "b", "d")
    got = impute.impute_group_median(fixed, "k", "d", flag="f").collect()
    assert sorted((r.d, r.f) for r in got) == [(4.0, False), (4.0, True)]


def test_age_from_birth(frame):
    rows = [(1, None, dt.date(2024, 1, 2), D(2024, 1, 1)), (2, 40.0, dt.date(2000, 1, 1), D(2024, 1, 1)),
            (3, None, None, D(2024, 1, 1))]
    df = frame(rows, "i int, age double, birth date, at timestamp_ntz")
    got = impute.age_from_birth(df, "age", "birth", "at").orderBy("i").collect()
    assert [r.age for r in got] == [-1.0, 40.0, None]


def test_labels_and_second_run(frame):
    rows = [("\tFIEVRE  TYPHOIDE ",), (None,), ("grippe",)]
    rule = labels.LabelRule("p", ref.DIAGNOSIS_LABELS, ref.UNKNOWN_F)
    once = labels.normalise_labels(frame(rows, "p string"), [rule])
    assert [r.p for r in once.collect()] == ["Fièvre typhoïde", ref.UNKNOWN_F, ref.UNKNOWN_F]
    twice = labels.normalise_labels(once, [rule])
    assert {r.p for r in twice.collect()} == {ref.UNKNOWN_F}


def test_long_label_lists_are_joined(frame):
    table = {f"label {i}": f"L{i}" for i in range(120)}
    rule = labels.LabelRule("p", table, "other")
    df = frame([(1, " LABEL  7 "), (2, "label 500"), (3, None)], "i int, p string")
    got = labels.normalise_labels(df, [rule])
    assert got.columns == ["i", "p"]
    assert {r.i: r.p for r in got.collect()} == {1: "L7", 2: "other", 3: "other"}


def test_normalised_labels_stay_in_their_lists(spark):
    from tests.conftest import DATA
    from wardflow.workload import queries

    rows = admissions.normaliser_textes(queries.raw_admissions(spark, DATA))
    for rule in admissions.LABEL_RULES:
        found = {r[0] for r in rows.select(rule.column).distinct().collect()}
        assert found <= set(rule.labels.values()) | {rule.default}


def test_bands(frame):
    raw = [-0.1, 0.0, 4.5, 5.0, 120.5, 121.0, None]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, age double")
    got = enrich.add_band(df, "age", ref.AGE_BANDS, 121, ref.AGE_UNKNOWN, "b").orderBy("i")
    names = {label: rank for rank, label, _, _ in ref.AGE_BANDS}
    assert [names.get(r.b, 0) for r in got.collect()] == [0, 1, 1, 2, 6, 0, 0]


def test_season_group_and_unit_cost(frame):
    df = frame(
        [(D(2024, 7, 1), "Fracture", 1000.0, 0.0), (None, ref.UNKNOWN_F, 2500.0, 1000.0)],
        "at timestamp_ntz, p string, cost double, d double",
    )
    df = enrich.add_month_season(df, "at", ref.SEASON_BY_MONTH, "m", "s")
    df = enrich.add_group(df, "p", ref.DIAGNOSIS_GROUPS, ref.OTHER_GROUP, "g")
    df = enrich.add_unit_cost(df, "cost", "d", "u")
    first, second = df.collect()
    assert (first.m, first.s, first.g, first.u) == (
        7, "Grande saison des pluies", "Traumatologie et chirurgie", None)
    assert (second.m, second.s, second.g, second.u) == (None, None, "Autre", 2.0)


def test_reference_tables_agree_with_each_other():
    groups = enrich.members_to_group(ref.DIAGNOSIS_GROUPS)
    official = set(ref.DIAGNOSIS_LABELS.values())
    assert len(official) == 31 and official <= set(groups)
    assert set(ref.SERVICE_BEDS) == set(ref.SERVICE_LABELS.values()) == set(ref.SERVICE_TARIFF)
    assert sum(ref.SERVICE_BEDS.values()) == 1445
    assert len(set(ref.TOWN_LABELS.values())) == 13
