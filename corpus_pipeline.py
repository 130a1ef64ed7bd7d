"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm import exact_dedup, packing, quality, secrets, simhash
from wardflow.llm.common import stored, table
from wardflow.llm.tokens import WORD_BPE, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text")
    return quality.keep_good(docs, weights, "text")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.exact_dedup(docs, "doc_id", "text")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.near_dedup(docs, "doc_id", "text")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each secret in its place."""
    return secrets.redact(docs, "text", "n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    packed = packing.pack(docs, "doc_id", "text", tokenizer_path(WORD_BPE), with_ids=True)
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("secret_scans", secrets_stage),
    ("packing", packing_stage),
]

# The model, the fingerprints and the tokenizer have no SQL; tests compare run() with
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed sequences of the documents table of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
