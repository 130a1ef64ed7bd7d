"""Byte-pair encoding and decoding of whole texts.

``tokens.Encoder`` gives the ids the tokenizers library gives; long unsplit pieces are
encoded by halves (``joins``). Decoding puts the bytes of all ids together and reads
them as UTF-8.

Defined results: null text is empty and has no ids. Special tokens in a text are
that token, as in the library. Repeated rows give repeated results, an empty table an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import pieces, ship
from wardflow.llm.tokens import encoder, share, strings


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = known.encode(strings(part.column("text")))
                yield pa.record_batch(
                    [part.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return run


def encode(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Columns id and ids (array<int>) of every row."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(share(df.sparkSession, path)), "id bigint, ids array<int>")


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(shared).byte_table()
        for batch in batches:
            texts = [
                b"".join([table[i] for i in ids or ()]).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.record_batch([batch.column("id"), pa.array(texts)], names=["id", "text"])

    return run


def decode(df: DataFrame, id_col: str, ids_col: str, path: str) -> DataFrame:
    """Columns id and text of every row of ids; null ids are an empty text."""
    ship(df.sparkSession)
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode(share(df.sparkSession, path)), "id bigint, text string")


def _round_trip(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared)
        table = known.byte_table()
        decimal = [str(i) for i in range(len(table))]
        for batch in batches:
            for part in pieces(batch, "text"):
                counts, digests, texts = [], [], []
                for ids in known.encode(strings(part.column("text"))):
                    numbers = ids.tolist()
                    counts.append(len(numbers))
                    joined = ",".join([decimal[i] for i in numbers])
                    digests.append(hashlib.sha256(joined.encode()).hexdigest())
                    text = b"".join([table[i] for i in numbers]).decode("utf-8", "replace")
                    texts.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.record_batch(
                    [part.column("id"), pa.array(counts, pa.int64()), pa.array(digests),
                     pa.array(texts)],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def round_trip(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Columns id, n_tokens and digests of the ids and of the decoded text.

    Encodes and decodes in one pass, so that ids need not leave the task.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _round_trip(share(df.sparkSession, path)),
        "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
