import random

from pyspark.sql import functions as F

from tests.conftest import plan_text
from tests.test_increments import shuffled_rows
from wardflow.operators import dedup


def last_by_hand(rows):
    """Exact copies keep their first position; then the last row of each key."""
    first = {}
    for seq, key, value in rows:
        first.setdefault((key, value), seq)
    best = {}
    for (key, value), seq in first.items():
        if key not in best or seq > best[key][0]:
            best[key] = (seq, value)
    return sorted((str(k), v, s) for k, (s, v) in best.items())


def collected(df):
    return sorted((str(r.k), r.v, r.seq) for r in df.collect())


def test_a_b_a_keeps_b(frame):
    df = frame([(1, "x", "A"), (2, "x", "B"), (3, "x", "A")], "seq long, k string, v string")
    assert collected(dedup.deduplicate(df, ["k"], "seq")) == [("x", "B", 2)]
    assert [r.v for r in dedup.keep_last(df, ["k"], "seq").collect()] == ["A"]


def test_null_keys_are_one_key(frame):
    df = frame([(1, None, "A"), (2, None, "B")], "seq long, k string, v string")
    assert [r.v for r in dedup.deduplicate(df, ["k"], "seq").collect()] == ["B"]
    counts = dedup.duplicate_counts(df, ["k"], "seq").first()
    assert (counts.lignes, counts.doublons_stricts, counts.cles_dupliquees) == (2, 0, 1)


def test_hot_key_matches_brute_force(spark, frame):
    rng = random.Random(3)
    rows = [
        (i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}", rng.randrange(40))
        for i in range(4000)
    ]
    df = frame(rows, "seq long, k string, v int").repartition(7)
    for partitions in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert collected(dedup.deduplicate(df, ["k"], "seq")) == last_by_hand(rows)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_dedup_is_idempotent(frame):
    rows = [(i, f"k{i % 5}", i % 3) for i in range(60)]
    once = dedup.deduplicate(frame(rows, "seq long, k string, v int"), ["k"], "seq")
    assert collected(dedup.deduplicate(once, ["k"], "seq")) == collected(once)


def test_a_hot_key_is_reduced_before_the_shuffle(frame):
    df = frame([(1, "x", "A")], "seq long, k string, v string")
    plan = plan_text(dedup.keep_last(df, ["k"], "seq"), "simple")
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and any("Partial" in line for line in limits)
    exact = plan_text(dedup.drop_exact_duplicates(df, "seq"), "simple")
    assert exact.count("Exchange") == 1 and "partial_min" in exact


def test_struct_positions_order_rows(frame):
    df = frame([(1, "x", "A"), (2, "x", "B")], "seq long, k string, v string").withColumn(
        "seq", F.struct(F.lit("file").alias("path"), F.col("seq").alias("row"))
    )
    assert [r.v for r in dedup.deduplicate(df, ["k"], "seq").collect()] == ["B"]


def test_counted_dedup_keeps_the_same_rows_and_adds_up(frame):
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", None, f"k{i % 90}"]), rng.randrange(30)) for i in range(2500)]
    df = frame(rows, "seq long, k string, v int").repartition(6)
    counted = dedup.deduplicate_counted(df, ["k"], "seq", "copies", "versions")
    assert counted.columns == ["seq", "k", "v", "copies", "versions"]
    assert collected(counted) == collected(dedup.deduplicate(df, ["k"], "seq"))
    totals = counted.agg(F.sum("copies"), F.sum("versions")).first()
    assert tuple(totals) == (len(rows), len({(k, v) for _, k, v in rows}))


def test_file_order_takes_hash_aggregation(spark, tmp_path):
    from wardflow.sources.csvfile import read_raw_csv

    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("k,v\n" + "".join(f"{j % 5},{i}\n" for j in range(40)))
    raw = read_raw_csv(spark, str(tmp_path), ["k", "v"])
    counted = dedup.deduplicate_counted(raw, ["k"], "_seq", "n", "m")
    for df in (dedup.drop_exact_duplicates(raw, "_seq"), counted):
        assert "SortAggregate" not in plan_text(df, "simple")
    assert {(r.k, r.v, r.n, r.m) for r in counted.collect()} == {(str(j), "2", 24, 3) for j in range(5)}


def test_digests_tell_cells_apart(frame):
    schema = "a string, b string, c array<string>, d double, e binary"
    rows = [
        ("x", None, ["p, q"], 1.0, b"a"), ("x", None, ["p", "q"], 1.0, b"a"), (None, "x", ["p, q"], 1.0, b"a"),
        ("x1:y", "", None, None, None), ("x", "1:y", None, None, None), ("", "", [], None, b""), (None, None, None, None, None),
        ("-", None, None, None, None), (None, None, [None], None, None), (None, None, ["null"], None, None),
    ]
    df = frame(rows + rows, schema)
    keyed = df.select(dedup.digest(df, *df.columns).alias("k"), "*")
    assert keyed.select("k").distinct().count() == len(rows)
    assert keyed.where("k is null").isEmpty()


def test_rows_alone_with_their_key_are_not_shuffled(frame):
    rows = [(i, f"k{i}", "v" * 50) for i in range(2000)] + [(5000, "k7", "w"), (5001, "k7", "w")]
    df = frame(rows, "seq long, k string, v string")
    for found in (dedup.deduplicate(df, ["k"], "seq"), dedup.deduplicate_counted(df, ["k"], "seq", "n", "m")):
        assert shuffled_rows(found) < 100
        assert {(r.seq, r.v) for r in found.where("k = 'k7'").collect()} == {(5000, "w")}


def test_keys_that_share_a_mark_change_no_result(frame, monkeypatch):
    monkeypatch.setattr(dedup, "MARK_WORDS", 1)
    rng = random.Random(4)
    rows = [(i, rng.choice([None, f"k{rng.randrange(400)}"]), rng.randrange(5)) for i in range(600)]
    df = frame(rows, "seq long, k string, v int").repartition(5)
    alone, others = dedup.parted(df, ["k"])
    several = {key for _, key, _ in rows if sum(key == other for _, other, _ in rows) > 1}
    assert alone.count() + others.count() == len(rows)
    assert not several & {r.k for r in alone.collect()}
    assert collected(dedup.deduplicate(df, ["k"], "seq")) == last_by_hand(rows)
    counted = dedup.deduplicate_counted(df, ["k"], "seq", "n", "m")
    assert collected(counted) == last_by_hand(rows)
    assert counted.agg(F.sum("n")).first()[0] == len(rows)
