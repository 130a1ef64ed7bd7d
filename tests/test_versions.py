import pytest
from pyspark.sql import functions as F

from wardflow.sources import versions

SCHEMA = "k bigint, annee int, text string"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_a_load_that_breaks_leaves_the_version_before(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    first = frame([(1, 2023, "a"), (2, None, None)], SCHEMA)
    versions.publish(first, path, "annee")
    broken = spark.range(50).select(
        F.col("id").alias("k"), F.lit(2024).alias("annee"),
        F.when(F.col("id") == 37, F.raise_error(F.lit("lost"))).otherwise("x").cast("string").alias("text"))
    for how in (versions.REPLACE, versions.PARTITIONS, versions.APPEND):
        with pytest.raises(Exception, match="lost"):
            versions.publish(broken, path, "annee", how)
        assert rows(versions.read_published(spark, path)) == rows(first)
    # What a load that was killed has left goes by an explicit call.
    spark.range(3).write.parquet(f"{path}/part-of-a-dead-load")
    assert rows(versions.read_published(spark, path)) == rows(first)
    assert versions.remove_old(spark, path) >= 1
    assert rows(versions.read_published(spark, path)) == rows(first)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]) == 1


def test_a_manifest_that_was_not_finished_is_no_version(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    first = frame([(1, 2023, "a")], SCHEMA)
    versions.publish(first, path)
    (tmp_path / "t" / "_manifests" / "000000000002.json").write_text('{"version": 2, "pa')
    assert rows(versions.read_published(spark, path)) == rows(first)
    versions.publish(frame([(2, 2024, "b")], SCHEMA), path, how=versions.APPEND)
    assert [m["version"] for m in versions.manifests(spark, path)] == [1, 3]
    assert versions.read_published(spark, path).count() == 2


def test_replace_partitions_and_append(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(frame([(1, 2023, "a"), (2, 2024, "b"), (3, None, "c")], SCHEMA), path, "annee")
    later = frame([(9, 2024, "z")], SCHEMA)
    versions.publish(later, path, "annee", versions.PARTITIONS)
    assert [r.k for r in versions.read_published(spark, path).orderBy("k").collect()] == [1, 3, 9]
    got = versions.publish(later, path, "annee", versions.APPEND)
    assert [r.k for r in got.orderBy("k").collect()] == [1, 3, 9, 9]
    one = versions.read_published(spark, path, values=[2024])
    assert {r.k for r in one.collect()} == {9} and len(one.inputFiles()) == 2
    assert versions.read_published(spark, path, values=[1999]).count() == 0
    assert [r.k for r in versions.read_published(spark, path, version=1).orderBy("k").collect()] == [1, 2, 3]
    versions.publish(later, path, "annee")
    assert rows(versions.read_published(spark, path)) == rows(later)
    # All that the older versions had goes, and only that.
    assert versions.remove_old(spark, path) == 3
    assert rows(versions.read_published(spark, path)) == rows(later)
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path, version=1)


def test_a_named_load_is_done_once(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame([(1, 2023, "a")], SCHEMA)
    for _ in range(2):
        versions.publish(df, path, how=versions.APPEND, load="monday")
    assert versions.read_published(spark, path).count() == 1
    versions.publish(df, path, how=versions.APPEND, load="tuesday")
    assert versions.read_published(spark, path).count() == 2


def test_of_two_loads_at_one_time_one_raises(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = frame([(1, 2023, "a")], SCHEMA)
    versions.publish(df, path)
    real = versions.current
    before = real(spark, path)
    monkeypatch.setattr(versions, "current", lambda *a: before)
    versions.publish(df, path, how=versions.APPEND)
    with pytest.raises(RuntimeError, match="meanwhile"):
        versions.publish(df, path, how=versions.APPEND)
    monkeypatch.setattr(versions, "current", real)
    assert versions.read_published(spark, path).count() == 2
    folder = versions.Folder(spark, path)
    with pytest.raises(Exception, match="(?i)exist"):
        folder.create("_manifests/000000000002.json", "{}")


def test_columns_and_empty_tables(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path)
    none = frame([], SCHEMA)
    assert versions.publish(none, path, "annee").schema == none.schema
    with pytest.raises(ValueError, match="columns"):
        versions.publish(none.drop("text"), path, "annee", versions.APPEND)
    assert versions.publish(none.drop("text"), path, "annee").columns == ["k", "annee"]
