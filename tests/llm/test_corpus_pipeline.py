import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_secrets import brute as brute_spans
from tests.llm.test_simhash import brute_groups, brute_print, within_two
from wardflow.llm import quality, secrets
from wardflow.llm.tokens import WORD_BPE, tokenizer_path

FOLDER = "/root/testdata/sf0.01"


def by_stage(spark, folder):
    """Documents kept by each stage, found row by row on the driver."""
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    weights = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), labels, "doc_id", "text")

    def good(text):
        at, values = quality.features((text or "").encode())
        return weights[at] @ values >= 0

    kept = [d for d in docs if good(d[1])]
    yield kept
    best = {}
    for d in kept:
        best[d[1] or ""] = max(best.get(d[1] or "", d), d, key=lambda r: r[0])
    kept = list(best.values())
    yield kept
    groups = brute_groups([(d[0], brute_print(d[1])) for d in kept], within_two)
    kept = [d for d, g in zip(kept, groups) if d[0] == g]
    yield kept
    out = []
    for number, text, lang, source, n in kept:
        spans = secrets.to_code_points(text.encode(), secrets.find_spans([text.encode()])[0])
        assert [s for s in spans if s[1] < 3] == brute_spans(text)
        if spans:
            clean, at = "", 0
            for a, kind, b in spans:
                if a >= at:
                    clean += text[at:a] + f"[{secrets.KINDS[kind]}]"
                at = max(at, b)
            text = clean + text[at:]
            n = len(text)
        out.append((number, text, lang, source, n))
    yield out


@pytest.fixture(scope="module")
def stages(spark):
    return list(by_stage(spark, FOLDER))


def test_each_stage_equals_brute_force_on_its_input(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], stages):
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = sorted(tuple(r) for r in docs.collect())
        assert got == sorted(expected), name


def test_run_packs_every_id_of_what_is_left(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    documents = {d[0]: library.encode(d[1], add_special_tokens=False).ids + [1] for d in stages[-1]}
    covered = {}
    for r in rows:
        assert r.ids == documents[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
    assert covered == {i: len(t) for i, t in documents.items()}


def test_stages_take_empty_and_odd_tables(spark, frame):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _mark int"
    odd = [(None, None, None, None, None, 1), (1, "", None, "s", 0, 2), (2, "x" * 50_000, "en", None, 1, 3),
           (2, "x" * 50_000, "en", None, 1, 3)]
    for rows in ([], odd):
        docs = frame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
            assert out.columns == docs.columns
            docs = out
        corpus_pipeline.packing_stage(spark, docs, FOLDER).count()


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "secret_scans", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
