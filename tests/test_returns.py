import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from tests.test_increments import shuffled_rows
from wardflow.operators import attach, returns

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, k string, at timestamp_ntz"


def by_hand(rows):
    """Sort each key's rows in time, subtract neighbours."""
    groups = {}
    for row_id, key, at in rows:
        if key is not None and at is not None:
            groups.setdefault(key, []).append((at, row_id))
    delays = {row_id: None for row_id, _, _ in rows}
    for members in groups.values():
        members.sort()
        for (before, _), (now, row_id) in zip(members, members[1:]):
            delays[row_id] = round((now - before).total_seconds() / 86400 * 10) / 10
    return delays


@pytest.fixture(scope="module")
def rows():
    """One key holds half of the rows, with ties, bursts, gaps and nulls."""
    rng = random.Random(5)
    made = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None, f"c{i % 50}"])
        minutes = rng.choice([rng.randrange(100), rng.randrange(600_000), 777])
        at = None if rng.random() < 0.05 else START + dt.timedelta(minutes=minutes)
        made.append((i, key, at))
    return made


@pytest.mark.parametrize("hot_rows", [3, 50, 10_000])
def test_delays_match_brute_force(frame, rows, hot_rows):
    df = frame(rows, SCHEMA).repartition(6)
    got = returns.days_since_previous(df, "k", "at", ["id"], "d", hot_rows)
    assert {r.id: r.d for r in got.collect()} == by_hand(rows)


def test_delays_match_without_broadcast(frame, rows, monkeypatch):
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 0)
    got = returns.days_since_previous(frame(rows, SCHEMA), "k", "at", ["id"], "d", 40)
    assert {r.id: r.d for r in got.collect()} == by_hand(rows)


def test_only_instants_of_hot_keys_are_put_in_order(spark, frame, rows):
    df = frame(rows, SCHEMA)
    cut = plan_text(returns.days_since_previous(df, "k", "at", ["id"], "d", 50), "simple")
    assert "__first" in cut
    # Very many rows at one instant: one instant is sorted, whatever the row limit.
    tied = spark.range(5000).select("id", F.lit("k").alias("k"), F.lit(START).cast("timestamp_ntz").alias("at"))
    got = returns.days_since_previous(tied, "k", "at", ["id"], "d", 8).groupBy("d").count().collect()
    assert {r.d: r["count"] for r in got} == {None: 1, 0.0: 4999}
    plain = plan_text(returns.days_since_previous(df, "k", "at", ["id"], "d", 10_000), "simple")
    assert "__first" not in plain and "__spread" in plain


def test_threshold_applies_to_the_rounded_delay(frame):
    gap = START + dt.timedelta(days=30)
    rows = [(1, "a", START), (2, "a", gap + dt.timedelta(hours=1)),
            (3, "b", START), (4, "b", gap + dt.timedelta(hours=2))]
    got = returns.flag_returns(frame(rows, SCHEMA), "k", "at", ["id"], "d", "early")
    assert {r.id: (r.d, r.early) for r in got.collect()} == {
        1: (None, False), 2: (30.0, True), 3: (None, False), 4: (30.1, False)}


def test_hot_keys_counts(frame, rows):
    hot = returns.hot_keys(frame(rows, SCHEMA), "k", 300).select("k").collect()
    assert [r.k for r in hot] == ["hot"]
    assert returns.hot_keys(frame(rows, SCHEMA), "k", 10**6).isEmpty()


def test_columns_are_kept_in_order(frame, rows):
    df = frame(rows, SCHEMA).withColumn("extra", F.lit(1))
    got = returns.flag_returns(df, "k", "at", ["id"], "d", "early", hot_rows=50)
    assert got.columns == ["id", "k", "at", "extra", "d", "early"]


def test_keys_are_counted_only_where_a_lane_is_busy(spark, monkeypatch):
    monkeypatch.setattr(returns, "LANES", 4)
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    found = returns.hot_keys(df, "k", 10**6)
    assert shuffled_rows(found) <= 4 * df.rdd.getNumPartitions()
    assert found.isEmpty()
    busy = df.unionByName(spark.range(900).select(F.lit("hot").alias("k")))
    assert [tuple(r) for r in returns.hot_keys(busy, "k", 800).collect()] == [("hot", 900)]
