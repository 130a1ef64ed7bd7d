import random
import zlib

import numpy as np
import pytest

from tests.conftest import DATA
from wardflow.llm import quality
from wardflow.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, score double, held_out string, _text int"


def corpus(n=240):
    rng = random.Random(1)
    good = [f"word{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = rng.choices(good, k=rng.choice((5, 40)))
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), 0.0, "s", 1))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_rows_are_told_apart_and_not_learned_from(frame):
    rows, labels = corpus()
    odd = [(None, "word1", None, None, None), (1, rows[1][1], 0.0, "s", 1), (9000, None, 0.0, "s", 1), (9001, "", 0.0, "", 1)]
    df = frame(rows + odd, SCHEMA)
    marks = frame(labels + [(1, 1, 0), (None, 0, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    weights = quality.fit(df, marks, "doc_id", "text")
    got = quality.score(df, weights, "doc_id", "text").collect()
    assert len(got) == len(rows) + 4
    truth = {i: q for i, q, _ in labels}
    wrong = 0
    for r in got:
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        wrong += r.held_out and r.id in truth and truth[r.id] != r.predicted
    assert wrong == 0
    # Turning the labels of held-out rows round changes nothing.
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    again = quality.fit(df, frame(turned, "doc_id bigint, quality int, toxic int"), "doc_id", "text")
    kept = quality.fit(df, frame(labels, "doc_id bigint, quality int, toxic int"), "doc_id", "text")
    assert np.array_equal(again, kept)
    stay = quality.keep_good(df, weights, "text")
    assert stay.columns == df.columns
    assert sorted(str(r[0]) for r in stay.collect()) == sorted(str(r.id) for r in got if r.predicted)


def test_labels_without_a_document_take_no_place(frame, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 60)
    rows, labels = corpus()
    df = frame(rows, SCHEMA)
    marks = "doc_id bigint, quality int, toxic int"
    more = [(i, i % 2, 0) for i in range(10_000, 16_000)]
    weights = quality.fit(df, frame(labels, marks), "doc_id", "text")
    assert weights.any()
    assert np.array_equal(quality.fit(df, frame(labels + more, marks), "doc_id", "text"), weights)


def test_training_equals_dense_updates():
    texts, labels = [b"a b a", b"c C! c", b"", b"a c"], [1, 0, 1, 0]
    z, n = np.zeros(quality.INTERCEPT + 1), np.zeros(quality.INTERCEPT + 1)
    for _ in range(quality.EPOCHS):
        for text, label in zip(texts, labels):
            x = np.zeros(len(z))
            at, values = quality.features(text)
            x[at] = values
            w = np.array([0.0 if abs(a) <= quality.L1 else
                          -(a - np.sign(a) * quality.L1) / ((quality.BETA + b ** 0.5) / quality.ALPHA)
                          for a, b in zip(z, n)])
            g = (1 / (1 + np.exp(-(w @ x))) - label) * x
            z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / quality.ALPHA * w
            n += g * g
    assert np.allclose(quality.train(texts, labels), quality.weights_at(z, n))


@pytest.mark.parametrize("rows", [[], [(1, "x", 0.0, "", 0)]])
def test_no_labels_and_empty_tables(frame, rows):
    df = frame(rows, SCHEMA)
    weights = quality.fit(df, frame([], "doc_id bigint, quality int"), "doc_id", "text")
    assert not weights.any()
    assert [r.score for r in quality.score(df, weights, "doc_id", "text").collect()] == [0.5] * len(rows)


def test_held_out_accuracy_of_the_query(spark):
    scored = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert right / len(rows) > 0.9
    assert DATA
