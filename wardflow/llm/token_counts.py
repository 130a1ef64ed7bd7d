"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are counted by encoded length, combined before the shuffle. Suffix sums over
lengths then give, for a limit, how many documents are longer, how many tokens
there are below it and how many remain after truncation. Sums run within ranges of
``RANGE`` lengths, on top of the totals of the ranges above, so no task has more than
a range; the totals are one row per range that occurs.

Defined results: null and empty texts have length zero. An empty table has no
lengths, and its answers are null or zero. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wardflow.llm.common import pieces, ship, stored
from wardflow.llm.tokens import encoder, share, strings

RANGE = 1024


def _lengths(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared)
        for batch in batches:
            for part in pieces(batch, "text"):
                sizes = [len(ids) for ids in known.encode(strings(part.column(0)))]
                yield pa.record_batch([pa.array(sizes, pa.int64())], names=["length"])

    return run


def encoded_lengths(df: DataFrame, text_col: str, path: str) -> DataFrame:
    """Column length of every row."""
    ship(df.sparkSession)
    rows = df.select(F.col(text_col).alias("text"))
    return rows.mapInArrow(_lengths(share(df.sparkSession, path)), "length bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs, with the sums from it upwards.

    Columns: length, docs, docs_at_least, tokens_at_least (tokens of documents of this
    length or longer), docs_total, tokens_total, truncated_total (tokens left when all
    documents are cut at this length) and quantile (share of documents up to it).
    """
    # Read twice below, and encoding must not run twice: one short row per length that occurs.
    counts = stored(
        lengths.groupBy("length").agg(F.count(F.lit(1)).alias("docs")).withColumn(
            "span", F.floor(F.col("length") / RANGE)),
        "lengths",
    )
    tokens = F.col("docs") * F.col("length")
    spans = counts.groupBy("span").agg(
        F.sum("docs").alias("span_docs"), F.sum(tokens).alias("span_tokens"))
    above = Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("span_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("span_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("span_docs").over(every).alias("docs_total"),
        F.sum("span_tokens").over(every).alias("tokens_total"),
    )
    upwards = Window.partitionBy("span").orderBy(F.col("length").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        counts.join(spans, "span")
        .withColumn("docs_at_least", F.sum("docs").over(upwards) + F.col("docs_above"))
        .withColumn("tokens_at_least", F.sum(tokens).over(upwards) + F.col("tokens_above"))
        .select(
            "length", "docs", "docs_at_least", "tokens_at_least", "docs_total", "tokens_total",
            (F.col("tokens_total") - F.col("tokens_at_least")
             + F.col("docs_at_least") * F.col("length")).alias("truncated_total"),
            ((F.col("docs_total") - F.col("docs_at_least") + F.col("docs"))
             / F.col("docs_total")).alias("quantile"),
        )
    )


def at_limit(found: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: docs_over, truncated_total and tokens_total."""
    over = F.col("length") > limit
    return found.agg(
        F.coalesce(F.sum(F.when(over, F.col("docs"))), F.lit(0)).alias("docs_over"),
        F.sum(F.col("docs") * F.least(F.col("length"), F.lit(limit))).alias("truncated_total"),
        F.sum(F.col("docs") * F.col("length")).alias("tokens_total"),
    )


def quantile(found: DataFrame, share_of_docs: float) -> DataFrame:
    """The smallest length that at least this share of documents does not exceed."""
    return found.where(F.col("quantile") >= share_of_docs).agg(F.min("length").alias("length"))
