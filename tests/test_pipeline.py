import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA, plan_text
from wardflow import reference as ref
from wardflow.plans import admissions, pipeline, star_schema
from wardflow.plans.journal import Journal
from wardflow.workload import queries


@pytest.fixture(scope="module")
def raw(spark):
    return queries.raw_admissions(spark, DATA).cache()


@pytest.fixture(scope="module")
def result(raw):
    return pipeline.run(raw, "sel", order="seq", source="admissions.csv")


def test_columns_and_row_counts(raw, result):
    assert result.prepared.columns == ref.PREPARED_COLUMNS
    journal = result.journal.orderBy("ordre").collect()
    assert len(journal) == 7
    assert journal[0].lignes_avant == raw.count()
    for before, after in zip(journal, journal[1:]):
        assert before.lignes_apres == after.lignes_avant
    # Only the duplicates' step loses rows.
    assert [r.etape for r in journal if r.delta] == ["Suppression des doublons"]
    assert journal[-1].lignes_apres == result.prepared.count()


def test_audit_and_report(result):
    assert result.audit.count() == 5
    rows = result.report.collect()
    assert [r.regle[:2] for r in rows] == [f"R{i}" for i in range(1, 9)]
    assert rows[0].statut == rows[1].statut == rows[4].statut == "OK"


def test_counts_are_taken_after_the_last_shuffle(raw, spark):
    """A task before a shuffle may run twice when an executor is lost."""
    journal = Journal(ref.JOURNAL)
    plan = plan_text(pipeline._stage(raw, "seq", journal), "simple")
    assert plan.count("CollectMetrics") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange")


def test_journals_do_not_mix(raw, result):
    again = pipeline.run(raw, "sel", order="seq", source="admissions.csv")
    assert again.journal.collect() == result.journal.collect()


@pytest.mark.parametrize("partitions, hot_rows", [("1", 2), ("200", 10**9)])
def test_result_depends_on_neither_partitions_nor_slicing(
    spark, raw, result, partitions, hot_rows
):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        other = pipeline.run(raw.repartition(5), "sel", order="seq", hot_rows=hot_rows).prepared
        assert other.exceptAll(result.prepared).isEmpty()
        assert other.count() == result.prepared.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_steps_one_by_one_give_the_same(raw, result):
    cleaned = admissions.nettoyer(raw, "seq")
    masked, _ = admissions.pseudonymiser(cleaned, "sel")
    enriched = admissions.enrichir(masked, trier=True).select(*ref.PREPARED_COLUMNS)
    assert enriched.exceptAll(result.prepared).isEmpty()
    dates = [r[0] for r in enriched.select("date_entree").collect()]
    known = [d for d in dates if d is not None]
    assert known == sorted(known) and dates[: len(known)] == known


def test_durations_are_filled_and_temperatures_are_not(result):
    assert result.prepared.where("duree_sejour_j is null").isEmpty()
    assert not result.prepared.where("temperature_entree_c is null").isEmpty()
    assert not result.prepared.where("duree_imputee").isEmpty()


def test_blocking_load_refuses_and_open_load_repeats(spark, result, tmp_path):
    target = str(tmp_path / "warehouse")
    with pytest.raises(ValueError):
        pipeline.load(result, target)
    pipeline.load(result, target, blocking=False)
    loaded = pipeline.load(result, target, blocking=False)
    assert loaded.count() == result.prepared.count()
    assert spark.read.parquet(f"{target}/audit").count() == 5


def test_load_refuses_personal_columns(result, tmp_path):
    leaking = pipeline.Run(
        result.prepared.withColumn("telephone", F.lit("0")),
        result.journal, result.audit, result.report,
    )
    with pytest.raises(AssertionError):
        pipeline.load(leaking, str(tmp_path / "w"), blocking=False)


def test_facts_refer_to_dimensions(result):
    fact = star_schema.facts(result.prepared)
    assert fact.count() == result.prepared.count()
    report = star_schema.check_links(fact, star_schema.dates(result.prepared))
    assert {r.lignes_orphelines for r in report.collect()} == {0}
    assert report.count() == 8


def test_native_types_of_a_run(result):
    kinds = dict(result.prepared.dtypes)
    assert {c: kinds[c] for c in ("date_entree", "annee_naissance", "mois", "age", "duree_imputee")} == {
        "date_entree": "timestamp_ntz", "annee_naissance": "int", "mois": "int", "age": "double",
        "duree_imputee": "boolean",
    }


def test_a_run_that_died_goes_on_without_its_input(spark, result, tmp_path, monkeypatch):
    raw = queries.raw_admissions(spark, DATA)
    settings = {"order": "seq", "source": "admissions.csv", "folder": str(tmp_path / "run"), "resume": True}
    stage, impute_step = pipeline._stage, pipeline._impute

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(pipeline, "_impute", die)
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.run(raw, "sel", **settings)
    # From here on the raw rows cannot be read.
    monkeypatch.setattr(pipeline, "_stage", die)
    monkeypatch.setattr(pipeline, "_impute", impute_step)
    again = pipeline.run(raw, "sel", **settings)
    assert again.journal.collect() == result.journal.collect()
    assert again.report.collect() == result.report.collect()
    assert again.prepared.schema == result.prepared.schema
    assert again.prepared.exceptAll(result.prepared).isEmpty()
    # All steps are done now; the journal is the same without any of them.
    monkeypatch.setattr(pipeline, "_impute", die)
    assert pipeline.run(raw, "sel", **settings).journal.collect() == result.journal.collect()
    # Another salt is another run.
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.run(raw, "other", **settings)
    monkeypatch.setattr(pipeline, "_stage", stage)


def test_a_table_without_its_record_is_written_again(spark, tmp_path):
    raw = queries.raw_admissions(spark, DATA)
    settings = {"order": "seq", "folder": str(tmp_path / "run"), "resume": True}
    first = pipeline.run(raw, "sel", **settings).journal.collect()
    record = tmp_path / "run" / "_ledger" / "cleaned.json"
    record.write_text(record.read_text()[:40])
    assert pipeline.run(raw, "sel", **settings).journal.collect() == first
    assert record.read_text().endswith("}")
    with pytest.raises(ValueError, match="files"):
        pipeline.run(spark.createDataFrame(raw.limit(5).collect(), raw.schema), "sel", **settings)


def test_a_fingerprint_follows_files_and_parameters(spark, tmp_path):
    from wardflow.plans.ledger import fingerprint

    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    one = fingerprint(spark.read.parquet(path), salt="a")
    assert one == fingerprint(spark.read.parquet(path), salt="a") != fingerprint(spark.read.parquet(path), salt="b")
    spark.range(5).write.mode("append").parquet(path)
    assert one != fingerprint(spark.read.parquet(path), salt="a")


def exchanged(df):
    """Column names of each exchange of a plan that was not run."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append({node.output().apply(i).name() for i in range(node.output().size())})
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_columns_of_a_row_alone_are_not_shuffled(raw):
    masked = admissions.masquer(admissions.nettoyer(raw, "seq"), "sel")
    (dealt,) = [d for d in exchanged(admissions.enrichir(masked)) if "id_patient_pseudo" in d]
    assert {"id_patient_pseudo", "pathologie", "sejour_prolonge"} <= dealt
    assert not dealt & {"tranche_age", "mois", "saison", "categorie_pathologie", "cout_journalier_fcfa"}


def test_admissions_are_sorted_before_their_texts_are_made(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "write_csv", lambda df, path: written.append(df))
    queries._as_csv(spark, DATA)
    assert all("telephone" not in dealt for dealt in exchanged(written[0]))
    whole = queries.raw_admissions(spark, DATA).orderBy("seq").drop("seq")
    assert written[0].columns == whole.columns and written[0].collect() == whole.collect()
