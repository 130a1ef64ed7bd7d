"""Quality classifier: logistic regression over hashed word n-grams.

Features of a text are its words, its pairs of adjacent words, and the same of word
shapes (case, digits and punctuation, runs collapsed); a pair of two equal words is
one feature whatever the word. They are hashed into 2 ** ``BITS`` places; a value
is the square root of the count, each text scaled to length one. Weights are
learned with follow-the-regularised-leader updates (McMahan et al., "Ad click
prediction"), which leave most of them at zero, and a score is a sparse dot product.

Labels are learned from a sample of at most ``SAMPLE`` labelled rows, the first in
the order of a hash of their ids, so the model does not depend on how rows are
dealt out. The sample is trained on in one task, which is what the bound is for;
scoring takes all rows where they are read. Nothing but the text enters a score.

Defined results: null and empty texts have the intercept's score. Several labels of an
id are averaged. Rows without an id are scored but neither learned from nor held
out. Without labels every score is 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import pieces, ship, unused

BITS = 18
SAMPLE = 3000
EPOCHS = 2
ALPHA, BETA, L1 = 2.0, 1.0, 0.05
CACHE_WORDS = 200_000
INTERCEPT = 1 << BITS

SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
    for c in range(256)
)
RUN = re.compile(rb"(.)\1+", re.S)
PAIR = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xBF58476D1CE4E5B9)
SAME, SHAPES = np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)

_words: dict[bytes, bytes] = {}


def word_hashes(word: bytes) -> bytes:
    """Hash of the word in lower case and of its shape, remembered per worker."""
    if len(_words) >= CACHE_WORDS:
        _words.clear()
    shape = RUN.sub(rb"\1", word.translate(SHAPE))
    found = _words[word] = xxhash.xxh64_digest(word.lower()) + xxhash.xxh64_digest(shape)
    return found


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text, the intercept last."""
    words = text.split()
    if not words:
        return np.array([INTERCEPT]), np.ones(1)
    known = _words.get
    both = np.frombuffer(
        b"".join([known(w) or word_hashes(w) for w in words]), ">u8").reshape(-1, 2)
    word, shape = both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)
    with np.errstate(over="ignore"):
        pairs = word[:-1] * PAIR + word[1:]
        pairs[word[:-1] == word[1:]] = SAME
        shapes = shape + SHAPES
        found = np.concatenate((word, pairs, shapes, shapes[:-1] * PAIR + shapes[1:]))
        found ^= found >> np.uint64(29)
        found *= SPREAD
    places, counts = np.unique(found >> np.uint64(64 - BITS), return_counts=True)
    values = np.sqrt(counts / counts.sum())
    return np.append(places.astype(np.int64), INTERCEPT), np.append(values, 1.0)


def weights_at(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that the summed gradients stand for."""
    small = np.abs(z) <= L1
    return np.where(small, 0.0, (np.sign(z) * L1 - z) * ALPHA / (BETA + np.sqrt(n)))


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, x))))


def train(texts: list[bytes], labels: list[int]) -> np.ndarray:
    """Weights after ``EPOCHS`` passes over the examples in their order."""
    z, n = np.zeros(INTERCEPT + 1), np.zeros(INTERCEPT + 1)
    for _ in range(EPOCHS):
        for text, label in zip(texts, labels):
            at, values = features(text)
            before = n[at]
            now = weights_at(z[at], before)
            gradient = (sigmoid(float(now @ values)) - label) * values
            after = before + gradient * gradient
            z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * now
            n[at] = after
    return weights_at(z, n)


def held_out(id_col: str) -> Column:
    """Rows that no label is learned from: a third, by their id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_sample(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label: str
) -> DataFrame:
    """At most ``SAMPLE`` rows ``text``, ``label`` in one partition, in a fixed order.

    Labels without a document do not count.
    """
    here = df.select(F.col(id_col).alias("id")).distinct()
    given = (
        labels.select(F.col(label_id).alias("id"), F.col(label).cast("double").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull())
        .where(~held_out("id"))
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .join(here, "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(SAMPLE)
    )
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (
        rows.join(F.broadcast(given), "id")
        .orderBy(F.xxhash64("id"), "id", "text")
        .limit(SAMPLE)
        .select("text", "label")
    )


def _train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
        labels += batch.column(1).to_pylist()
    weights = train(texts, labels)
    places = np.flatnonzero(weights)
    yield pa.record_batch(
        [pa.array(places, pa.int64()), pa.array(weights[places])], names=["place", "weight"])


def fit(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str,
    label_id: str = "doc_id", label: str = "quality",
) -> np.ndarray:
    """Weights by place, 2 ** ``BITS`` + 1 of them."""
    ship(df.sparkSession)
    sample = training_sample(df, labels, id_col, text_col, label_id, label)
    found = sample.coalesce(1).mapInArrow(_train_batches, "place bigint, weight double").toArrow()
    weights = np.zeros(INTERCEPT + 1)
    weights[found.column("place").to_numpy()] = found.column("weight").to_numpy()
    return weights


def _scorer(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value)
        for batch in batches:
            for part in pieces(batch, batch.schema.names[text_at]):
                scores = []
                for text in part.column(text_at).cast(pa.binary()).to_pylist():
                    at, values = features(text or b"")
                    scores.append(sigmoid(float(weights[at] @ values)))
                kept = [c for i, c in enumerate(part.columns) if i != text_at]
                names = [c for i, c in enumerate(part.schema.names) if i != text_at]
                yield pa.record_batch(
                    [*kept, pa.array(scores, pa.float64())], names=[*names, "score"])

    return run


def score(df: DataFrame, weights: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Columns id, held_out, score, predicted of every row."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(weights.tobytes())
    rows = df.select(
        F.col(id_col).alias("id"), held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    kind = df.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(shared, 2), f"id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _keeper(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value)
        for batch in batches:
            for part in pieces(batch, batch.schema.names[text_at]):
                good = []
                for text in part.column(text_at).cast(pa.binary()).to_pylist():
                    at, values = features(text or b"")
                    good.append(float(weights[at] @ values) >= 0)
                yield part.filter(pa.array(good, pa.bool_()))

    return run


def keep_good(df: DataFrame, weights: np.ndarray, text_col: str) -> DataFrame:
    """The rows of ``df`` whose predicted label is 1, unchanged."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(weights.tobytes())
    text = unused(df, "_text")
    rows = df.withColumn(text, F.col(text_col))
    kept = rows.mapInArrow(_keeper(shared, len(df.columns)), rows.schema)
    return kept.select(*df.columns)
