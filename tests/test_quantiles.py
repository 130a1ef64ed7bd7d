import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.operators import attach, enrich, impute, quantiles


def by_hand(rows, p):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return {key: float(np.quantile(values, p)) for key, values in groups.items()}


@pytest.fixture(scope="module")
def skewed():
    """One group holds most rows; values tie, repeat and spread."""
    rng = random.Random(11)
    rows = [("hot", rng.lognormvariate(2, 2)) for _ in range(3000)]
    rows += [("ties", float(rng.randrange(3))) for _ in range(400)]
    rows += [(f"g{i % 20}", rng.uniform(-5, 5)) for i in range(300)]
    rows += [("one", 7.5), ("none", None), (None, 3.0), (None, 4.0)]
    return rows


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 0.999, 1.0])
def test_sliced_quantile_is_exact(frame, skewed, p):
    df = frame(skewed, "k string, v double").repartition(5)
    expected = by_hand(skewed, p)
    for direct_rows in (0, 10**6):
        got = quantiles.quantile(df, ["k"], "v", p, "q", direct_rows, slices=16)
        found = {r.k: r.q for r in got.collect()}
        assert found.keys() == expected.keys()
        for key, value in expected.items():
            assert found[key] == pytest.approx(value, rel=1e-12), key


@pytest.mark.parametrize("p", [0.1, 0.5, 0.9])
def test_both_ways_give_the_same_value(frame, p):
    rng = random.Random(7)
    rows = [(f"g{i % 400}", rng.uniform(0, 1000)) for i in range(6000)]
    df = frame(rows, "k string, v double").repartition(4)
    both = [
        {r.k: r.q for r in quantiles.quantile(df, ["k"], "v", p, "q", limit, 8).collect()}
        for limit in (0, None)
    ]
    assert both[0] == both[1]


def test_sliced_quantile_without_broadcast(frame, skewed, monkeypatch):
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 0)
    df = frame(skewed, "k string, v double")
    found = {r.k: r.q for r in quantiles.quantile(df, ["k"], "v", 0.9, "q", 0, 16).collect()}
    assert found == pytest.approx(by_hand(skewed, 0.9))


def test_quantile_and_long_flag(frame):
    df = frame(
        [("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", None)], "k string, v double"
    )
    got = quantiles.quantile(df, ["k"], "v", 0.9, "q").first().q
    assert got == pytest.approx(3.6)
    for direct_rows in (0, None):
        flagged = enrich.add_long_flag(df, "k", "v", "long", direct_rows=direct_rows)
        assert sorted((r.v or 0, r.long) for r in flagged.collect()) == [
            (0, False), (1.0, False), (2.0, False), (4.0, True),
        ]


@pytest.mark.parametrize("slices", [2, 4])
def test_a_key_with_far_more_values_than_slices_times_the_limit(spark, slices):
    """Many rounds; what is sorted in the end is below the limit, and the result exact."""
    n, limit = 30_000, 300
    df = spark.range(n).select(
        F.when(F.col("id") % 100 < 98, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"),
        (F.pow(F.col("id") * 7919 % n, F.lit(1.5)) / 7).alias("v"))
    found = {r.k: r.q for r in quantiles.quantile(df, ["k"], "v", 0.73, "q", limit, slices).collect()}
    assert found == pytest.approx(by_hand([tuple(r) for r in df.collect()], 0.73), rel=1e-12)
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("__n")).where("k = 'hot'")
    total = counts.count()
    rows = counts.select("k", F.lit("").alias("__path"), F.lit(0).cast("bigint").alias("__before"),
                         F.lit((total - 1) * 0.73).alias("__position"), "v", "__n")
    left = quantiles.narrowed(rows, ["k"], "v", limit, slices)
    sizes = [r["count"] for r in left.groupBy("k", "__path").count().collect()]
    assert 1 <= len(sizes) <= 2 and max(sizes) <= limit and total > 256 * slices


def test_slice_of_counts_edges(frame):
    df = frame([(v, [1.0, 3.0, 3.0, 8.0]) for v in (0.0, 1.0, 2.0, 3.0, 9.0)],
               "v double, e array<double>")
    got = {r.v: r.s for r in df.select(
        "v", quantiles.slice_of(F.col("v"), F.col("e"), 5).alias("s")).collect()}
    assert got == {0.0: 0, 1.0: 1, 2.0: 1, 3.0: 3, 9.0: 4}


@pytest.mark.parametrize("direct_rows", [0, None])
def test_median_fallback_counts_imputed_values(frame, direct_rows):
    rows = [("a", 2.0), ("a", 4.0), ("a", 8.0), ("c", 100.0)]
    rows += [("c", None)] * 3 + [("b", None)]
    df = frame(rows, "k string, v double")
    filled = impute.impute_group_median(df, "k", "v", flag="f", direct_rows=direct_rows)
    got = sorted((r.k, r.v, r.f) for r in filled.collect())
    assert ("b", 100.0, True) in got
    assert got.count(("c", 100.0, True)) == 3 and ("c", 100.0, False) in got
    assert filled.columns == ["k", "v", "f"]


@pytest.mark.parametrize("direct_rows", [0, None])
def test_null_key_takes_the_overall_median(frame, direct_rows):
    df = frame([(None, None), (None, 50.0), ("a", 1.0), ("a", 3.0)], "k string, v double")
    filled = impute.impute_group_median(df, "k", "v", direct_rows=direct_rows)
    assert sorted(r.v for r in filled.collect()) == [1.0, 3.0, 3.0, 50.0]


def test_attach_keeps_rows_when_too_long_to_broadcast(frame, monkeypatch):
    monkeypatch.setattr(attach, "BROADCAST_ROWS", 1)
    small = frame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    df = frame([("a",), ("b",), ("c",), (None,)], "k string")
    plain = attach.attach(df, small, ["k"])
    assert sorted((str(r.k), r.x or 0) for r in plain.collect()) == [
        ("None", 0), ("a", 1), ("b", 2), ("c", 0)]
    safe = attach.attach(df, small, ["k"], null_safe=True)
    assert ("None", 3) in [(str(r.k), r.x) for r in safe.collect()]
