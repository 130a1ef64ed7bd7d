"""Connected components of a link table, by alternating star contractions.

Every round joins each node's larger neighbours to its smallest one, then its
smaller neighbours (Kiveris et al., "Connected components in MapReduce and
beyond"). Minima are combined before the shuffle; the links are written after
each round, which cuts lineage, and stay distributed throughout. The number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("low"))
    lower = links.join(least, "u").where("v <> low").select(
        F.col("v").alias("u"), F.col("low").alias("v"))
    return lower.unionByName(least.select("u", F.col("low").alias("v")))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Table ``node``, ``root`` of all linked nodes; the root is the smallest node.

    Nulls and links of a node to itself say nothing; repeated links count once.
    No links give an empty table.
    """
    a, b = F.col(left), F.col(right)
    now = stored(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("u").alias("node"), F.col("v").alias("root")))
