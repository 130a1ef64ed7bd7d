import datetime as dt

from pyspark.sql import functions as F

from wardflow.functions import draws, numbers, text, times


def values(df):
    return [row[0] for row in df.collect()]


def test_whitespace_of_any_kind_is_squeezed(frame):
    raw = ["\tAvc  Ischemique ", "\x1cavc\x1fischemique", "  a  b ", None]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i")
    got = values(df.select(text.normalise(F.col("x"))))
    assert got == ["avc ischemique", "avc ischemique", "a b", None]


def test_strip_keeps_inner_space(frame):
    df = frame([("  MED 01\t",)], "x string")
    assert values(df.select(text.strip(F.col("x")))) == ["MED 01"]


def test_lookup_label_matches_what_normal_form_matches(frame):
    labels = {"port bouet": "Port-Bouët", "Never Reached": "?"}
    rows = [("PORT BOUET",), (" port bouet",), ("never reached",), (None,)]
    df = frame(rows, "x string")
    got = values(df.select(text.lookup_label(F.col("x"), labels)))
    assert got == ["Port-Bouët", "Port-Bouët", None, None]


def test_missing_tokens(frame):
    df = frame([("NA",), ("None",), ("",), ("Aucune",), (" ",)], "x string")
    got = values(df.select(text.missing_to_null(F.col("x"))))
    assert got == [None, None, None, "Aucune", " "]


def test_accents_fold(frame):
    df = frame([("Pré-éclampsie aiguë Â – 漢",)], "x string")
    assert values(df.select(text.fold_accents(F.col("x")))) == ["Pre-eclampsie aigue A  "]
    assert len(text.ACCENTED) == len(text.UNACCENTED)


def test_numbers_are_read_strictly(frame):
    raw = ["1d", "NaN", " 12 ", "1e3", "-3", ".5", "1,5", "0x10", "5.", "", "Infinity", None]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i")
    got = values(df.select(numbers.to_double(F.col("x"))))
    assert got == [None, None, 12.0, 1000.0, -3.0, 0.5, None, None, 5.0, None, None, None]


def test_rounding_takes_ties_to_even(frame):
    df = frame([(0, 0.05), (1, 0.25), (2, 0.45), (3, 2.05)], "i int, x double").orderBy("i")
    assert values(df.select(numbers.round_even(F.col("x"), 1))) == [0.0, 0.2, 0.4, 2.0]
    hundreds = frame([(0, 1250.0), (1, 1350.0)], "i int, x double").orderBy("i")
    assert values(hundreds.select(numbers.round_even(F.col("x"), -2))) == [1200.0, 1400.0]


def test_ratio_by_zero_is_null(frame):
    df = frame([(5.0, 0.0)], "a double, b double")
    assert values(df.select(numbers.ratio(F.col("a"), F.col("b")))) == [None]


def test_birth_dates_are_day_first(frame):
    raw = ["31/02/1999", "1/2/2020", "01/02/20", "", "05/11/1987"]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i")
    got = values(df.select(times.to_birth_date(F.col("x"))))
    assert got == [None, dt.date(2020, 2, 1), None, None, dt.date(1987, 11, 5)]


def test_timestamps_with_and_without_a_format(frame):
    df = frame([("2023-05-01 08:24:00",), ("2023-05-01",), ("hier",)], "x string")
    free = values(df.select(times.to_timestamp(F.col("x"))))
    assert free == [dt.datetime(2023, 5, 1, 8, 24), dt.datetime(2023, 5, 1), None]
    strict = values(df.select(times.to_timestamp(F.col("x"), "yyyy-MM-dd HH:mm:ss")))
    assert strict == [dt.datetime(2023, 5, 1, 8, 24), None, None]


def test_years_round_towards_minus_infinity(frame):
    df = frame(
        [(dt.date(2023, 5, 2), dt.datetime(2023, 5, 1)),
         (dt.date(2000, 1, 1), dt.datetime(2001, 1, 1))],
        "b date, at timestamp_ntz",
    )
    got = sorted(values(df.select(times.whole_years(F.col("b"), F.col("at")))))
    assert got == [-1.0, 1.0]


def test_draws_depend_on_key_and_seed_only(spark):
    keys = spark.range(20_000)
    rate = keys.where(draws.chosen(F.col("id"), 7, 0.05)).count() / 20_000
    assert abs(rate - 0.05) < 0.01
    once = keys.select(draws.draw(F.col("id"), 7).alias("d")).agg(F.sum("d")).first()[0]
    again = keys.repartition(13).select(draws.draw(F.col("id"), 7).alias("d"))
    assert again.agg(F.sum("d")).first()[0] == once
