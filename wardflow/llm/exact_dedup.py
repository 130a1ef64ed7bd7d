"""Exact duplicates with a heavy-hitter split; DataFrame functions only.

``freqItems`` keeps a Misra-Gries summary (Karp, Schenker and Papadimitriou's
form) in every task and merges them: it holds at most ``1 / support`` digests
and misses none that has more than ``support`` of the rows. These candidates
are verified by an exact count, which also finds each one's winner. The winners,
bounded by ``1 / support`` rows, are broadcast, so the copies of a frequent text
are settled where they are read. All other digests, none with more than
``support`` of the rows, go through an ordinary shuffle.

Texts are compared by SHA-256. Null texts count as empty. The row with the
largest id stays; a null id is smaller than any other. Of repeated rows with the
same id and text exactly one stays. An empty table gives an empty result. Extra
columns are kept by ``exact_dedup``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import stored, unused

SUPPORT = 0.001


def text_digest(text: str) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8, null as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def frequent_winners(slim: DataFrame, support: float) -> DataFrame:
    """Digest, winner and exact count of the candidates for frequent digests.

    ``slim`` has the columns ``digest`` and ``rank``, the largest rank wins.
    """
    summary = slim.stat.freqItems(["digest"], support)
    candidates = summary.select(F.explode(F.col("digest_freqItems")).alias("digest"))
    return (
        slim.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.max("rank").alias("winner"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def duplicate_report(
    df: DataFrame, id_col: str, text_col: str, support: float = SUPPORT
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = stored(
        df.select(
            F.struct(
                F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row")
            ).alias("rank"),
            text_digest(text_col).alias("digest"),
        ),
        "digests",
    )
    heavy = frequent_winners(slim, support)
    marked = slim.join(F.broadcast(heavy), "digest", "left")
    same = Window.partitionBy("digest")
    rest = (
        marked.where(F.col("copies").isNull())
        .withColumn("winner", F.max("rank").over(same))
        .withColumn("copies", F.count(F.lit(1)).over(same))
    )
    return (
        marked.where(F.col("copies").isNotNull())
        .unionByName(rest)
        .select(
            F.col("rank.id").alias("doc_id"),
            F.col("winner.id").alias("keep_id"),
            F.col("copies").alias("group_size"),
            (F.col("rank.row") == F.col("winner.row")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def exact_dedup(
    df: DataFrame, id_col: str, text_col: str, support: float = SUPPORT
) -> DataFrame:
    """The rows of ``df`` that stay, one of each text, with all their columns."""
    digest, winner, place = (unused(df, c) for c in ("_digest", "_winner", "_place"))
    slim = df.select(text_digest(text_col).alias("digest"), F.col(id_col).alias("rank"))
    heavy = frequent_winners(slim, support).select(
        F.col("digest").alias(digest), F.struct(F.col("winner").alias("id")).alias(winner)
    )
    read = df.withColumn(digest, text_digest(text_col))
    # Copies of a frequent text go here; its winner, repeated or not, goes on.
    left = read.join(F.broadcast(heavy), digest, "left").where(
        F.col(winner).isNull() | F.col(winner)["id"].eqNullSafe(F.col(id_col))
    )
    order = Window.partitionBy(digest).orderBy(F.col(id_col).desc_nulls_last())
    return (
        left.withColumn(place, F.row_number().over(order))
        .where(F.col(place) == 1)
        .select(*[df[c] for c in df.columns])
    )
