import csv
import random

import pytest
from pyspark.sql import functions as F

from wardflow import session
from wardflow.operators import dedup, quality
from wardflow.sources import csvfile, tables


def write(path, rows, header):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(rows)


def test_cells_are_texts_and_tokens_are_null(spark, tmp_path):
    write(tmp_path / "a.csv", [["01", "NA", 'say "hi", ok', " x "], ["", "None", "é", "1.0"]],
          ["a", "b", "c", "d"])
    df = csvfile.read_raw_csv(spark, str(tmp_path / "a.csv"), ["a", "b", "c", "d"])
    assert {t for _, t in df.drop("_seq").dtypes} == {"string"}
    rows = [tuple(r) for r in df.drop("_seq").collect()]
    assert rows == [("01", None, 'say "hi", ok', " x "), (None, None, "é", "1.0")]


def test_header_must_agree_with_the_schema(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "2"]], ["b", "a"])
    with pytest.raises(Exception, match="(?i)header"):
        csvfile.read_raw_csv(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()


def test_file_order_over_files_and_splits(spark, tmp_path):
    n, expected = 0, []
    for name, size in (("b.csv", 40), ("a.csv", 900), ("c.csv", 300)):
        rows = [[f"{name}-{i:05d}", "x" * 20] for i in range(size)]
        write(tmp_path / name, rows, ["k", "pad"])
        n += size
    for name, size in (("a.csv", 900), ("b.csv", 40), ("c.csv", 300)):
        expected += [f"{name}-{i:05d}" for i in range(size)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = csvfile.read_raw_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 5
        assert [r.k for r in df.orderBy("_seq").collect()] == expected
        same = df.withColumn("id", F.substring("k", 1, 5))
        last = dedup.keep_last(same, ["id"], "_seq").collect()
        assert sorted(r.k for r in last) == ["a.csv-00899", "b.csv-00039", "c.csv-00299"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_roundtrip_keeps_spaces_and_quotes(spark, frame, tmp_path):
    rows = [("  padded ", 'a "b", c'), (None, "é\t"), ("plain", None)]
    csvfile.write_csv(frame(rows, "x string, y string"), str(tmp_path / "out"))
    back = csvfile.read_raw_csv(spark, str(tmp_path / "out"), ["x", "y"]).drop("_seq")
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", [["one\ntwo", "x"]], ["a", "b"])
    df = csvfile.read_raw_csv(spark, str(tmp_path / "a.csv"), ["a", "b"], multi_line=True)
    assert [r.a for r in df.collect()] == ["one\ntwo"]


def odd_cells(seed, n=400):
    rng = random.Random(seed)
    pieces = ["a", '"', "\n", "\r\n", ",", " ", "é", '""', "\n\n", "long text " * 30]
    return [[f"{i:04d}", "".join(rng.choices(pieces, k=rng.randrange(9))), "x" + rng.choice(pieces)]
            for i in range(n)]


@pytest.mark.parametrize("size", [300, 5000, 1 << 20])
def test_line_breaks_inside_quotes_in_split_files(spark, tmp_path, size):
    rows = {"a.csv": odd_cells(1), "b.csv": odd_cells(2, 30) + [["0030", "z\n" * 3000, "end"]], "c.csv": []}
    for name, cells in rows.items():
        write(tmp_path / name, cells, ["k", "t", "u"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        df = csvfile.read_raw_csv(spark, str(tmp_path), ["k", "t", "u"], null_tokens=(), multi_line=True)
        got = [tuple(r)[:3] for r in df.orderBy("_seq").collect()]
        learnt = csvfile.read_raw_csv(spark, str(tmp_path / "a.csv"), null_tokens=(), multi_line=True)
        assert learnt.columns == ["k", "t", "u", "_seq"] and learnt.count() == 400
        lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
        assert size > 5000 or lines.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [tuple(v or None for v in row) for name in sorted(rows) for row in rows[name]]
    assert got == expected
    one_task = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "a.csv"))
    # That reader makes one line feed of a carriage return and a line feed.
    plain = [str(tuple(v and v.replace("\r\n", "\n") for v in row)) for row in got[:400]]
    assert sorted(plain) == sorted(str(tuple(r)) for r in one_task.collect())


def test_split_files_check_header_and_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffx,y\r\n"1\n2",3\r\n\r\n4,5,6\r\n', newline="")
    path = str(tmp_path / "a.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        csvfile.read_raw_csv(spark, path, ["x", "y"], multi_line=True).collect()
    kept = csvfile.read_raw_csv(spark, path, ["x", "y"], multi_line=True, bad_records="keep").orderBy("_seq").collect()
    assert [(r.x, r.y, r._invalide) for r in kept] == [("1\n2", "3", None), ("4", "5", "4,5,6")]
    with pytest.raises(Exception, match="(?i)header"):
        csvfile.read_raw_csv(spark, path, ["y", "x"], multi_line=True).collect()


def test_lines_without_open_quotes_are_not_shuffled(spark, tmp_path):
    write(tmp_path / "a.csv", [[str(i), 'a "b", c'] for i in range(50)], ["x", "y"])
    df = csvfile.quoted_records(spark, str(tmp_path / "a.csv"))
    assert df.count() == 51
    parts = df.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert parts == 1  # all of them come from the branch that reads lines as records


def test_a_load_replaces_the_table_or_its_partitions(spark, frame, tmp_path):
    target = str(tmp_path / "t")
    first = frame([(1, 2023), (2, 2024)], "x int, annee int")
    for _ in range(2):
        tables.load_partitions(first, target, "annee")
    later = frame([(9, 2024)], "x int, annee int")
    tables.load_partitions(later, target, "annee")
    assert sorted((r.x, r.annee) for r in spark.read.parquet(target).collect()) == [
        (1, 2023), (9, 2024)]
    tables.load_table(later, target, "annee")
    assert [(r.x, r.annee) for r in spark.read.parquet(target).collect()] == [(9, 2024)]


def test_bad_records_raise_or_are_kept_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4,5\n6\n")
    path = str(tmp_path / "a.csv")
    for columns in (["x", "y"], None):
        with pytest.raises(Exception, match="(?i)malformed"):
            csvfile.read_raw_csv(spark, path, columns).select("x").collect()
    kept = csvfile.read_raw_csv(spark, path, ["x", "y"], bad_records="keep").collect()
    assert [r.x for r in kept if r._invalide is None] == ["1"]
    assert {r._invalide for r in kept} == {None, "3,4,5", "6"}
    with pytest.raises(ValueError):
        csvfile.read_raw_csv(spark, path, bad_records="keep")
    # A line break in quotes is no silent pair of rows, but an error.
    (tmp_path / "b.csv").write_text('x,y\n"7\n8",9\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        csvfile.read_raw_csv(spark, str(tmp_path / "b.csv"), ["x", "y"]).collect()


def test_file_numbers_sort_as_numbers(spark, tmp_path):
    for number in (100_000, 20_000, 3):
        (tmp_path / f"part-{number:05d}.csv").write_text(f"x\n{number}\n")
    df = csvfile.read_raw_csv(spark, str(tmp_path), ["x"])
    assert dict(df.dtypes)["_seq"] == "decimal(38,0)"
    assert [r.x for r in df.orderBy("_seq").collect()] == ["3", "20000", "100000"]


def test_nothing_is_loaded_when_the_gate_fails(spark, frame, tmp_path):
    df = frame([(None, 2024)], "x int, annee int")
    rules = [quality.Rule("R", quality.missing("x"), "{n} missing", blocking=True)]
    report = quality.quality_report(df, rules)
    with pytest.raises(ValueError):
        tables.load_checked(df, report, str(tmp_path / "t"), "annee")
    assert not (tmp_path / "t").exists()
    tables.load_checked(df, report, str(tmp_path / "t"), "annee", blocking=False)
    assert (tmp_path / "t").exists()


def test_hand_off_keeps_types(spark, frame, tmp_path):
    df = frame([(1, "a", None)], "i int, s string, d date")
    back = tables.hand_off(df, str(tmp_path / "p"))
    assert back.schema == df.schema and back.collect() == df.collect()


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.work_path(spark, "x").startswith(named)
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_work_folder_of_an_application_can_be_deleted(tmp_path, monkeypatch, spark):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    tables.hand_off(spark.range(3), session.work_path(spark, "x"))
    assert session.clean(spark) and not list(tmp_path.iterdir())
