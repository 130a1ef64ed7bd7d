import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from wardflow.operators import dedup, marts, profile, returns, star
from wardflow.plans import increments
from wardflow.sources import tables, versions

ROWS = "k string, at timestamp_ntz, n int, extra string"


def test_keys_stay_and_new_ones_follow(frame, tmp_path):
    path = str(tmp_path / "keys")
    loads = [["b", "d", None, "b"], ["d"], ["a", "b", "e", "c"], []]
    expected = {}
    for i, values in enumerate(loads):
        df = frame([(v, "x") for v in values], "v string, other string")
        for _ in range(2):  # a repeated load changes nothing
            got = increments.register_keys(df, "v", "id", path, load=str(i))
        for v in sorted(v for v in set(values) if v is not None and v not in expected):
            expected[v] = len(expected) + 1
        assert {r.v: r.id for r in got.collect()} == expected and got.count() == len(expected)
    assert expected == {"b": 1, "d": 2, "a": 3, "c": 4, "e": 5}


def visits(seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(f"k{rng.randrange(12)}" if rng.random() < 0.7 else "hot",
             start + timedelta(days=rng.randrange(200)), i, "x") for i in range(500)]
    return rows + [(None, start, 900, "x"), ("k1", None, 901, None), (None, None, 902, None)]


@pytest.mark.parametrize("cut", [0, 1, 77, 199, 300])
@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_two_loads_split_at_any_date_equal_one(frame, tmp_path, cut, hot_rows):
    rows = visits(cut)
    at = datetime(2024, 1, 1) + timedelta(days=cut)
    one = returns.days_since_previous(frame(rows, ROWS), "k", "at", ["n"], "d", hot_rows)
    parts = []
    for load in (True, False, False):  # the second load is repeated
        some = [r for r in rows if (r[1] is None or r[1] < at) == load]
        parts.append(increments.delays_of_load(
            frame(some, ROWS), "k", "at", ["n"], "d", str(tmp_path / "s"), str(load), hot_rows))
    assert parts[2].columns == one.columns
    for second in parts[1:]:
        got = parts[0].unionByName(second).collect()
        assert sorted(map(str, got)) == sorted(map(str, one.collect()))


def test_rows_before_the_last_load_raise(frame, tmp_path):
    state = str(tmp_path / "s")
    first = frame([("a", datetime(2024, 5, 1), 1, "x"), ("b", datetime(2024, 1, 1), 2, "x")], ROWS)
    increments.delays_of_load(first, "k", "at", ["n"], "d", state, "1")
    late = frame([("a", datetime(2024, 4, 1), 3, "x")], ROWS)
    with pytest.raises(Exception, match="precedes"):
        increments.delays_of_load(late, "k", "at", ["n"], "d", state, "2").collect()


def test_state_is_rewritten_only_where_a_load_has_keys(spark, frame, tmp_path):
    state = str(tmp_path / "s")
    first = frame([(f"k{i}", datetime(2024, 1, 1), i, "x") for i in range(60)], ROWS)
    increments.delays_of_load(first, "k", "at", ["n"], "d", state, "1")
    increments.delays_of_load(frame([("k7", datetime(2024, 1, 2), 1, "x")], ROWS), "k", "at", ["n"], "d", state, "2")
    old, new = versions.manifests(spark, state)
    changed = [v for v in new["parts"] if new["parts"][v] != old["parts"][v]]
    assert len(changed) == 1 and len(new["parts"]) > 20
    assert versions.read_published(spark, state).count() == 60


def test_united_sketches_are_near_the_exact_number(spark, frame, tmp_path):
    path = str(tmp_path / "sketches")
    for load, (a, b) in enumerate([(0, 30_000), (20_000, 60_000), (0, 10)]):
        df = spark.range(a, b).select("id", (F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none"))
        for _ in range(2):
            increments.add_sketches(df, None, path, str(load))
    stored = versions.read_published(spark, path)
    assert stored.count() == 9 and stored.agg(F.max(F.length("esquisse"))).first()[0] < 20_000
    found = {r.colonne: r[profile.DISTINCT] for r in profile.united_distinct(stored).collect()}
    assert abs(found["id"] - 60_000) <= 3 * profile.SKETCH_ERROR * 60_000
    assert (found["few"], found["none"]) == (7, 0)


def test_census_equals_counting_days(frame):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(4000)), rng.randrange(-30, 2500))
            for _ in range(150)]
    rows = [(u, s, s + timedelta(hours=h)) for u, s, h in rows]
    odd = [("a", None, datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1), None), ("c", datetime(2023, 2, 28), datetime(2023, 2, 28))]
    days = {}
    for unit, s, e in rows + odd[2:]:
        day, last = s.date(), max(s.date(), e.date() - timedelta(days=1))
        while day <= last:
            days.setdefault(unit, {}).setdefault(day, 0)
            days[unit][day] += 1
            day += timedelta(days=1)
    expected = []
    for unit, beds in days.items():
        day, end = min(beds).replace(day=1), max(beds)
        while day <= end:
            nxt = (day + timedelta(days=32)).replace(day=1)
            found = [beds.get(day + timedelta(days=i), 0) for i in range((nxt - day).days)]
            expected.append((unit, day.year, day.month, max(found), min(found), sum(found)))
            day = nxt
    df = frame(rows + odd, "unit string, s timestamp_ntz, e timestamp_ntz")
    got = [tuple(r) for r in marts.daily_census(df, "unit", "s", "e").collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert marts.daily_census(df.limit(0), "unit", "s", "e").count() == 0


def test_positions_number_rows_over_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).orderBy(F.col("id").desc()).repartitionByRange(5, F.col("id").desc()).sortWithinPartitions(
        F.col("id").desc()).write.parquet(path)
    scan = spark.read.parquet(path)
    assert len(scan.inputFiles()) > 3
    got = tables.positions(scan, "place")
    assert got.columns == ["id", "place"]
    assert [r.place + r.id for r in got.collect()] == [1000] * 1000


def test_long_keys_are_shuffled_by_digest(frame):
    rows = [(1, "a" * 5000, "s"), (2, "a" * 5000, "t"), (3, None, "u"), (4, None, "v"), (5, "b", "w")]
    df = frame(rows, "n int, text string, s string")
    kept = dedup.keep_last(df, ["text"], "n", by_digest=True)
    assert {r.n for r in kept.collect()} == {2, 4, 5} and kept.columns == df.columns
    plan = plan_text(kept.drop("text"))
    exchange = plan[plan.index("Exchange\n", plan.index("(1)")):]
    assert "text" not in exchange[:exchange.index("Arguments")]


def test_winners_are_joined_without_a_hash_table_that_cannot_spill(frame):
    df = frame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "k string, v int, o int")
    found = dedup.deduplicate_counted(df, ["k"], "o", "c", "n")
    assert "ShuffledHashJoin" not in plan_text(found)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 2, 2, 2, 2), ("b", 1, 3, 1, 1)]




@pytest.mark.parametrize("limit", [100_000, 2])
def test_orphans_by_words_equal_orphans(spark, frame, monkeypatch, limit):
    monkeypatch.setattr(star, "BROADCAST_ROWS", limit)
    rng = random.Random(5)
    known = [(rng.randrange(-300, 300),) for _ in range(200)] + [(None,), (2**63 - 1,), (-2**63,), (63,), (64,)]
    used = [(rng.randrange(-400, 400),) for _ in range(900)] + [(None,), (None,), (2**63 - 1,), (-2**63,), (2**62,)]
    dimension, fact = frame(known, "id bigint"), frame(used, "ref bigint")
    got = star.orphans_by_words(fact, "ref", dimension, "id")
    assert sorted(map(str, got.collect())) == sorted(map(str, star.orphans(fact, "ref", dimension, "id").collect()))


def shuffled_rows(df):
    """Rows that the exchanges of an executed plan wrote."""
    df._jdf.queryExecution().toRdd().count()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_only_orphans_are_shuffled(spark, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "d"))
    spark.range(20_000).select((F.col("id") % 10_100).alias("ref")).write.parquet(str(tmp_path / "f"))
    dimension, fact = spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "f"))
    found = star.orphans_by_words(fact, "ref", dimension, "id")
    assert found.count() == 100
    assert 0 < shuffled_rows(found) <= 200
    assert shuffled_rows(star.orphans(fact, "ref", dimension, "id")) >= 10_000
