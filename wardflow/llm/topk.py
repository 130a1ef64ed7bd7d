"""Exact top-k inner products over norm-sorted vectors.

Components are turned into integers first, so scores are exact. A rotation by the
singular vectors of all vectors (from the d x d second moments, summed in Spark)
puts most of every length into the first coordinates. Products over those plus the
Cauchy-Schwarz bound of the rest, |q_rest| |x_rest|, bound each score from above:

* The ``HEAD`` longest vectors are scored first, which gives each query a threshold that
  its k-th best score reaches at least.
* Other vectors are dealt into ranges of descending length, queries into blocks. A
  block meets a range only if its longest query times the range's longest vector
  reaches its lowest threshold.
* Within such a pair, vectors are taken in tiles by descending length. Partial sums
  over more and more rotated coordinates drop those whose bound is below the query's
  threshold; survivors are scored exactly, and thresholds rise.

A task holds one block of queries and one range, both of fixed size; the head is
broadcast, and its size is fixed too. Rotated sums are floats and only ever used
with a margin for their rounding; scores are integers throughout.

Vectors of each dimension are searched by themselves. Those of squared length below
``PLAIN`` have scores of 64 bits with each other (Cauchy-Schwarz). Scores with a longer
vector are taken from Python's integers, such queries and candidates meeting in blocks.

Defined results: vectors that are null, empty, or hold a component that is null or not
finite take no part. Vectors of different dimensions have no score with each other. A
score beyond 64 bits is shown as the nearest number of 64 bits but ranked as what it is.
Candidates are all rows whose id differs from the query's; repeated rows are candidates
each, and repeated query rows are answered each. Rows without an id take no part. Ties
go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import ship, stored
from wardflow.session import short_table

HEAD = 2048
RANGE_ROWS = 8192
QUERY_ROWS = 1024
TILE = 1024
STEPS = (0.25, 0.5)
EMPTY_SCORE = -(1 << 62)
PLAIN = float(1 << 61)
LONG_QUERIES, LONG_ROWS = 64, 4096
# Twice the bits of a double's largest whole part, and room for the scale and the sum.
KEY_BYTES = 288


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component, as whole numbers."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))


def squared(vector: str, scale: int) -> Column:
    """Squared length of a scaled vector, rounded; infinite if it is beyond all numbers."""
    return F.aggregate(
        F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x).cast("double")),
        F.lit(0.0), lambda a, v: a + v * v)


def usable(vector: str) -> Column:
    """No component is null or not finite."""
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)),
    )


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0)).astype(np.float64)
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        size = total.shape[0]
        yield pa.record_batch(
            [pa.array(np.repeat(np.arange(size), size)), pa.array(np.tile(np.arange(size), size)),
             pa.array(total.reshape(-1))], names=["i", "j", "s"])


def rotation(vectors: DataFrame, size: int) -> np.ndarray:
    """Right singular vectors, strongest first; d x d sums are all the driver gets."""
    sums = vectors.select("x").mapInArrow(_moments, "i bigint, j bigint, s double")
    found = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    moments = np.zeros((size, size))
    moments[found.column("i").to_numpy(), found.column("j").to_numpy()] = found.column("s").to_numpy()
    values, directions = np.linalg.eigh((moments + moments.T) / 2)
    return directions[:, np.argsort(-values)]


class Best:
    """The k best (score, id) of each query, ties to the smaller id."""

    def __init__(self, count: int, k: int, thresholds: np.ndarray):
        self.k = k
        self.floor = thresholds.copy()
        self.scores = np.full((count, k), EMPTY_SCORE, np.int64)
        self.ids = np.full((count, k), np.iinfo(np.int64).max, np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in scored candidates of some queries, ``rows`` ascending."""
        if not len(rows):
            return
        cuts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1], [True])))
        for a, b in zip(cuts, cuts[1:]):
            q = rows[a]
            s = np.concatenate((self.scores[q], scores[a:b]))
            n = np.concatenate((self.ids[q], ids[a:b]))
            order = np.lexsort((n, -s))[:self.k]
            self.scores[q], self.ids[q] = s[order], n[order]
            self.floor[q] = max(self.floor[q], self.scores[q, -1])


class Block:
    """Vectors of one side: whole numbers, rotated floats, lengths of what is left."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.x = x
        self.turned = x.astype(np.float64) @ turn
        size = turn.shape[0]
        self.cuts = [0, *sorted({max(1, int(size * s)) for s in STEPS if int(size * s) < size})]
        self.left = [np.sqrt((self.turned[:, c:] ** 2).sum(axis=1)) for c in self.cuts]


def search(queries: Block, query_ids: np.ndarray, others: Block, ids: np.ndarray, best: Best) -> None:
    """Score every candidate that may be among the best, by descending length."""
    order = np.argsort(-others.left[0], kind="stable")
    for at in range(0, len(order), TILE):
        some = order[at:at + TILE]
        # Rounding of the rotated sums is far below this share of the product of lengths.
        reach = queries.left[0] * others.left[0][some[0]]
        live = np.flatnonzero(reach * (1 + 1e-9) + 1e-6 >= best.floor)
        if not len(live):
            continue
        bound = queries.left[0][live][:, None] * others.left[0][some][None, :]
        near = bound * (1 + 1e-9) + 1e-6 >= best.floor[live][:, None]
        partial = np.zeros((len(live), len(some)))
        for step in range(1, len(queries.cuts)):
            a, b = queries.cuts[step - 1], queries.cuts[step]
            partial += queries.turned[live, a:b] @ others.turned[some, a:b].T
            rest = queries.left[step][live][:, None] * others.left[step][some][None, :]
            near &= partial + rest + bound * 1e-9 + 1e-6 >= best.floor[live][:, None]
        row, column = np.nonzero(near)
        q, c = live[row], some[column]
        other = query_ids[q] != ids[c]
        q, c = q[other], c[other]
        for lo in range(0, len(q), 1 << 16):
            rows, columns = q[lo:lo + (1 << 16)], c[lo:lo + (1 << 16)]
            scores = np.einsum("ij,ij->i", queries.x[rows], others.x[columns])
            good = scores >= best.floor[rows]
            best.add(rows[good], scores[good], ids[columns[good]])


def _head_batches(turn_shared, head_shared, k: int):
    """Each query's best among the longest vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = turn_shared.value
        ids, x = head_shared.value
        head = Block(x, turn)
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS)
                query_ids = part.column("id").to_numpy()
                best = Best(len(query_ids), k, np.full(len(query_ids), EMPTY_SCORE))
                search(Block(matrix(part.column("x")), turn), query_ids, head, ids, best)
                yield pa.record_batch(
                    [*part.columns, pa.array(best.floor), pa.array(list(best.scores), pa.list_(pa.int64())),
                     pa.array(list(best.ids), pa.list_(pa.int64()))],
                    names=[*part.schema.names, "floor", "scores", "ids"])

    return run


def _pair(turn_shared, k: int):
    """One block of queries against one range of vectors."""

    def run(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "query_id", "score", "vec_id"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        turn = turn_shared.value
        query_ids = left.column("id").to_numpy()
        best = Best(len(query_ids), k, left.column("floor").to_numpy())
        search(Block(matrix(left.column("x")), turn), query_ids,
               Block(matrix(right.column("x")), turn), right.column("id").to_numpy(), best)
        row, place = np.nonzero(best.scores != EMPTY_SCORE)
        return pa.table(
            [pa.array(left.column("q").to_numpy()[row]), pa.array(query_ids[row]),
             pa.array(best.scores[row, place]), pa.array(best.ids[row, place])], names=names)

    return run


def ranges_of(number: int, parts: int) -> Column:
    """Names of the ranges a length class is dealt into."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)), lambda part: F.concat_ws("-", F.lit(number), part))


def top_k(
    df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 5, scale: int = 256
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k best of every query."""
    spark = df.sparkSession
    ship(spark)
    rows = df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("query"),
    )
    # Components of 2^55 and more saturate here, far above the limit.
    vectors = stored(
        rows.withColumn("size", F.size("v"))
        .withColumn("plain", squared("v", scale) < PLAIN)
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    # One row per dimension that occurs, and one more for those with long vectors.
    sizes = vectors.groupBy("size", "plain").agg(F.count_if("query").alias("asked")).collect()
    found = spark.createDataFrame([], f"q bigint, query_id bigint, score bigint, vec_id bigint, {BEYOND}")
    for size, plain, asked in sorted(map(tuple, sizes)):
        same = vectors.where(F.col("size") == size)
        if not plain:
            found = found.unionByName(among_long(same, k, scale))
        elif asked:
            best = among_plain(same.where("plain"), size, k, scale)
            found = found.unionByName(best, allowMissingColumns=True)
    order = Window.partitionBy("q").orderBy(
        F.coalesce("beyond", F.lit(0)).desc(), F.col("score").desc(), F.col("key").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


# Sign of a score that 64 bits cannot hold, and its value as bytes in the order of numbers.
BEYOND = "beyond int, key binary"


def whole(vector: list[float], scale: int) -> list[int]:
    """floor(scale * x) of each component, the product rounded as a double where it is one."""
    products = [scale * x for x in vector]
    return [math.floor(p if math.isfinite(p) else Fraction(x) * scale)
            for p, x in zip(products, vector)]


def _long_pair(k: int, scale: int):
    """One block of queries against one of candidates, in Python's integers."""

    def run(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        names = ["q", "query_id", "vec_id", "score", "beyond", "key"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        queries = [whole(v, scale) for v in left.column("v").to_pylist()]
        others = [whole(v, scale) for v in right.column("other_v").to_pylist()]
        ids, either = right.column("other").to_pylist(), right.column("other_plain").to_pylist()
        out = []
        for q, own, plain, x in zip(
            left.column("q").to_pylist(), left.column("id").to_pylist(),
            left.column("plain").to_pylist(), queries,
        ):
            scores = [
                (-sum(map(int.__mul__, x, y)), i) for y, i, p in zip(others, ids, either)
                if i != own and not (plain and p)
            ]
            for score, i in sorted(scores)[:k]:
                out.append((q, own, i, *shown(-score)))
        columns = list(zip(*out)) or [()] * 6
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def shown(score: int) -> tuple[int, int, bytes | None]:
    """A score as 64 bits, the side on which it is beyond them, and then its sorted bytes."""
    near = max(-(1 << 63), min((1 << 63) - 1, score))
    if near == score:
        return score, 0, None
    shifted = score + (1 << (8 * KEY_BYTES - 1))
    return near, 1 if score > 0 else -1, shifted.to_bytes(KEY_BYTES, "big")


def among_long(vectors: DataFrame, k: int, scale: int) -> DataFrame:
    """The k best scores of which the query or the candidate is a long vector."""
    parts = []
    for asked, others in (("query and not plain", "true"), ("query and plain", "not plain")):
        queries = vectors.where(asked).select(F.col("row").alias("q"), "id", "plain", "v")
        # Columns of their own names: both sides come from one table.
        rows = vectors.where(others).select(
            "row", F.col("id").alias("other"), F.col("plain").alias("other_plain"),
            F.col("v").alias("other_v"))
        number = [max(1, -(-n // size)) for n, size in (
            (queries.count(), LONG_QUERIES), (rows.count(), LONG_ROWS))]
        every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in number]
        own = [F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in zip(("q", "row"), number)]
        left = queries.withColumn("block", own[0]).withColumn("part", every[1])
        right = rows.withColumn("part", own[1]).withColumn("block", every[0])
        parts.append(
            left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
                _long_pair(k, scale),
                f"q bigint, query_id bigint, vec_id bigint, score bigint, {BEYOND}"))
    return parts[0].unionByName(parts[1])


def among_plain(plain: DataFrame, size: int, k: int, scale: int) -> DataFrame:
    """Columns q, query_id, score, vec_id: the k best among vectors of one dimension, or more."""
    spark = plain.sparkSession
    context = spark.sparkContext
    length = F.aggregate("x", F.lit(0).cast("bigint"), lambda a, v: a + v * v)
    vectors = stored(
        plain.select("id", "row", "query", scaled("v", scale).alias("x")).withColumn("length", length),
        "plain",
    )
    turn = context.broadcast(rotation(vectors, size))
    by_length = [F.col("length").desc(), F.col("row")]
    head = vectors.orderBy(*by_length).limit(HEAD).select("id", "x", "length", "row").toArrow()
    shared = context.broadcast((head.column("id").to_numpy(), matrix(head.column("x"))))
    last = (head.column("length")[-1].as_py(), head.column("row")[-1].as_py())
    wide = "array<bigint>"
    queries = stored(
        vectors.where("query").select(F.col("row").alias("q"), "id", "x", "length")
        .mapInArrow(
            _head_batches(turn, shared, k),
            f"q bigint, id bigint, x {wide}, length bigint, floor bigint, scores {wide}, ids {wide}"),
        "queries",
    )
    # Ranges of descending length: rows are counted per length class, and a class that
    # holds more than a range is dealt out over as many ranges as it needs.
    tail = vectors.where(
        (F.col("length") < last[0]) | ((F.col("length") == last[0]) & (F.col("row") > last[1]))
    ).withColumn("class", F.floor(F.log2(F.col("length") + 1.0) * 16))
    classes = tail.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")
    ).withColumn("parts", F.ceil(F.col("n") / RANGE_ROWS))
    # At most one row per sixteenth of a doubling of the length.
    known = classes.orderBy(F.col("class").desc()).toArrow().to_pylist()
    classes = short_table(
        spark, [(r["class"], r["parts"]) for r in known], {"class": "bigint", "parts": "bigint"})
    number = F.pmod(F.xxhash64("row"), F.col("parts"))
    others = tail.join(F.broadcast(classes), "class").select(
        F.concat_ws("-", "class", number).alias("range"), "id", "x")
    block_of = F.pmod(F.xxhash64("q"), F.ceil(F.lit(max(1, queries.count())) / QUERY_ROWS))
    blocked = queries.select("q", "id", "x", "length", "floor", block_of.alias("block"))
    blocks = blocked.groupBy("block").agg(
        F.max("length").alias("reach"), F.min("floor").alias("least"))
    met = [
        F.when(
            F.sqrt(F.col("reach").cast("double")) * (r["longest"] ** 0.5 * (1 + 1e-9))
            >= F.col("least"),
            ranges_of(r["class"], r["parts"]),
        )
        for r in known
    ]
    ranges = F.flatten(F.array_compact(F.array(*met))) if met else F.array().cast("array<string>")
    pairs = stored(blocks.select("block", F.explode(ranges).alias("range")), "pairs")
    left = blocked.join(pairs, "block").select("block", "range", "q", "id", "x", "floor")
    right = others.join(pairs, "range").select("block", "range", "id", "x")
    found = left.groupBy("block", "range").cogroup(right.groupBy("block", "range")).applyInArrow(
        _pair(turn, k), "q bigint, query_id bigint, score bigint, vec_id bigint")
    first = queries.select("q", "id", F.explode(F.arrays_zip("scores", "ids")).alias("s")).select(
        "q", F.col("id").alias("query_id"), F.col("s.scores").alias("score"),
        F.col("s.ids").alias("vec_id"),
    ).where(F.col("score") != EMPTY_SCORE)
    return first.unionByName(found)
