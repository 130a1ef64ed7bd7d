"""Ranked lexical search with document FP-trees.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
lower-cased. Each document is read once and reduced to the terms that some item asks
for, with their frequencies, and its length. From these short vectors come the
statistics of the corpus, and then the ranking:

* In every task documents are taken in blocks. Their vectors, most frequent term first, are
  sorted, which makes them the paths of a trie: a node is a run of documents that share
  a path, and paths without branches are one node.
* A node bounds every score below it: each term of its subtree counts with the largest
  frequency and the smallest m that the subtree has.
* The trie is searched depth first, the most promising child first, for all items that may
  still gain from a node; one whose bound is below its k-th best score so far is done
  with it. Documents reached are scored exactly, in whole numbers.
* A first search of ``SEED`` vectors gives each item a score that its k-th best reaches at
  least, with which all tasks begin. A task returns at most k documents of each item, and
  the best of these are the result.

Items are taken in groups of about ``ITEMS`` rows or ``TERMS`` terms, so what is broadcast,
the terms of a group and their items, does not grow with the number of items; each
group reads the documents once.

Defined results: null and empty texts have no terms; such items get no rows, and such
documents do not count. Every row of the documents is a document and every row of the items
an item, also when repeated. Rows without an id count in the statistics; as documents
they are not ranked, as items they are answered. Empty tables give empty results. Extra
columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wardflow.llm.common import pieces, ship, stored

BLOCK = 2048
FEW = 4
SEED = 8192
ITEMS, TERMS = 1024, 1_000_000

# Letters and digits of ASCII in lower case, other bytes of ASCII as space, the rest as is.
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def gain(tf: np.ndarray, m) -> np.ndarray:
    """What a term of weight 1 adds; grows with ``tf`` and falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def lengths_to_m(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The m of documents of ``n`` terms; in Python's integers where 64 bits may not do."""
    if 50 * int(n.max(initial=0)) * documents < 1 << 63:
        return 50 + (50 * n * documents) // length
    return np.array([50 + (50 * x * documents) // length for x in n.tolist()], np.int64)


# --- Vectors ------------------------------------------------------------------


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        terms = [sorted(set(terms_of(t))) for t in texts]
        yield pa.record_batch(
            [batch.column("item"), batch.column("id"), pa.array(terms, pa.list_(pa.binary()))],
            names=["item", "id", "terms"])


def _vector_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                sizes, counts, terms, tfs = [], [], [], []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    words = terms_of(text) if text else []
                    found = Counter(words)
                    wanted = known.keys() & found.keys()
                    sizes.append(len(words))
                    counts.append(len(wanted))
                    terms += [known[t] for t in wanted]
                    tfs += [found[t] for t in wanted]
                ends = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                yield pa.record_batch(
                    [part.column("id"), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                    names=["id", "n", "terms", "tfs"])

    return run


def _holding_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, of one task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(total))
        found[:len(total)] += total
        total = found
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["term", "df"])


# --- Trees --------------------------------------------------------------------


class Items:
    """Items of a group by term; terms are numbered by falling document frequency."""

    def __init__(self, number: list[int], item_terms: list[list[int]], weights: np.ndarray):
        self.number = np.array(number, np.int64)
        self.weights = weights
        pairs = sorted((t, i) for i, terms in enumerate(item_terms) for t in terms)
        self.of = np.array([i for _, i in pairs], np.int64)
        self.ends = np.searchsorted([t for t, _ in pairs], np.arange(len(weights) + 1))

    def sums(self, terms: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Sum of weight times gain for each item, exact: below 2 ** 53 in floats."""
        first, count = self.ends[terms], self.ends[terms + 1] - self.ends[terms]
        total = int(count.sum())
        place = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        values = np.repeat((self.weights[terms] * gains).astype(np.float64), count)
        return np.bincount(self.of[place + np.arange(total)], values, len(self.number))


class Best:
    """The k best documents of each item: highest score, then smallest id."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k = k
        # A score that is reached by k documents; never less than the smallest above 0.
        self.floor = np.maximum(floors, 1).astype(np.float64)
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in floors]

    def add(self, items: np.ndarray, scores: np.ndarray, number: int) -> None:
        for item, score in zip(items.tolist(), scores.tolist()):
            heap, entry = self.heaps[item], (int(score), -number)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = max(self.floor[item], heap[0][0])


class Tree:
    """Trie over the vectors of a block, as runs of its documents in sorted order."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        paths = [terms[a:b].astype(">u4").tobytes() for a, b in zip(ends, ends[1:])]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.paths = [paths[i] for i in order]
        self.ids, self.m = ids[order].tolist(), m[order]
        sizes = np.diff(ends)[order]
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        place = np.repeat(ends[:-1][order] - self.ends[:-1], sizes) + np.arange(self.ends[-1])
        self.terms, self.tfs = terms[place], tfs[place]

    def depth(self, lo: int, hi: int) -> int:
        """Length of the path that the documents lo up to hi share."""
        a, b = self.paths[lo], self.paths[hi - 1]
        most = min(len(a), len(b))
        differ = np.flatnonzero(
            np.frombuffer(a, ">u4", most // 4) != np.frombuffer(b, ">u4", most // 4))
        return int(differ[0]) if len(differ) else most // 4

    def children(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Runs below a node: the documents that end there, and one for each next term."""
        depth = self.depth(lo, hi)
        start, end = self.ends[lo:hi], self.ends[lo + 1:hi + 1]
        longer = start + depth < end
        following = np.where(longer, self.terms[np.minimum(start + depth, len(self.terms) - 1)], -1)
        if following[0] == following[-1]:  # all end here: equal paths
            return [(i, i + 1) for i in range(lo, hi)]
        cuts = [lo, *(np.flatnonzero(np.diff(following)) + lo + 1).tolist(), hi]
        return list(zip(cuts, cuts[1:]))

    def bounds(self, lo: int, hi: int, items: Items) -> np.ndarray:
        """What no document of a node exceeds, for each item; of one document, its scores."""
        part = slice(self.ends[lo], self.ends[hi])
        terms, tfs = self.terms[part], self.tfs[part]
        if hi - lo > 1:
            order = np.argsort(terms, kind="stable")
            terms, tfs = terms[order], tfs[order]
            new = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
            terms, tfs = terms[new], np.maximum.reduceat(tfs, new)
        return items.sums(terms, gain(tfs, self.m[lo:hi].min()))

    def search(self, items: Items, best: Best) -> None:
        def open_node(lo: int, hi: int):
            bound = self.bounds(lo, hi, items)
            return float((bound - best.floor).max()), lo, hi, bound

        stack = [open_node(0, len(self.ids))] if len(self.ids) else []
        while stack:
            _, lo, hi, bound = stack.pop()
            alive = np.flatnonzero(bound >= best.floor)
            if not len(alive):
                continue
            if hi - lo == 1:
                best.add(alive, bound[alive], self.ids[lo])
                continue
            below = [(i, i + 1) for i in range(lo, hi)] if hi - lo <= FEW else self.children(lo, hi)
            # The most promising one is opened first.
            stack += sorted((open_node(*child) for child in below), key=lambda n: n[0])


def _search_batches(shared, k: int, documents: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, place, floors = shared.value
        best = Best(k, floors)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                lists = part.column("terms")
                ends = lists.value_lengths().to_numpy()
                ends = np.concatenate(([0], np.cumsum(ends)))
                terms = place[lists.flatten().to_numpy()]
                tfs = part.column("tfs").flatten().to_numpy()
                # Most frequent terms first; those that weigh nothing are left out.
                owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
                order = np.lexsort((terms, owner))
                order = order[items.weights[terms[order]] > 0]
                kept = np.bincount(owner[order], minlength=part.num_rows)
                some = np.flatnonzero(kept)
                if not len(some):
                    continue
                m = lengths_to_m(part.column("n").to_numpy(), documents, length)
                ids = part.column("id").to_numpy()
                ends = np.concatenate(([0], np.cumsum(kept[some])))
                Tree(ids[some], m[some], ends, terms[order], tfs[order]).search(items, best)
        rows = [
            (int(items.number[i]), -negative, score)
            for i, heap in enumerate(best.heaps) for score, negative in heap
            if score >= best.floor[i]
        ]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.record_batch(
            [pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return run


FOUND = "item bigint, doc_id bigint, score bigint"


def among(docs: DataFrame, group: list, k: int) -> DataFrame:
    """Columns item, doc_id, score: at least the k best documents for a group of items."""
    spark = docs.sparkSession
    context = spark.sparkContext
    known: dict[bytes, int] = {}
    for row in group:
        for term in row["terms"]:
            known.setdefault(bytes(term), len(known))
    vectors = stored(
        docs.mapInArrow(
            _vector_batches(context.broadcast(known)),
            "id bigint, n bigint, terms array<int>, tfs array<bigint>").where("n > 0"),
        "vectors",
    )
    documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return spark.createDataFrame([], FOUND)
    counted = vectors.select("terms").mapInArrow(_holding_batches, "term bigint, df bigint")
    # At most one row per term of the group.
    holding = dict(map(tuple, counted.groupBy("term").agg(F.sum("df")).collect()))
    order = sorted(range(len(known)), key=lambda t: -holding.get(t, 0))
    place = np.empty(len(known), np.int64)
    place[order] = np.arange(len(known))
    weights = np.array([weight(documents, holding.get(t, 0)) for t in order], np.int64)
    items = Items(
        [row["item"] for row in group],
        [[int(place[known[bytes(t)]]) for t in row["terms"]] for row in group], weights)
    named = vectors.where(F.col("id").isNotNull())

    def search(rows: DataFrame, floors: np.ndarray) -> DataFrame:
        shared = context.broadcast((items, place, floors))
        return rows.mapInArrow(_search_batches(shared, k, documents, length), FOUND)

    none = np.zeros(len(group), np.int64)
    seeds = search(named.limit(SEED).coalesce(1), none)
    full = seeds.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = dict(map(tuple, full.where(F.col("n") >= k).select("item", "least").collect()))
    return search(named, np.array([reached.get(i, 0) for i in items.number.tolist()], np.int64))


def ranked(
    docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str,
    k: int = 50,
) -> DataFrame:
    """Columns item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    asked = stored(
        items.select(
            F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("id"),
            F.col(item_text).cast("string").alias("text"))
        .mapInArrow(
            _item_batches, f"item bigint, id {items.schema[item_id].dataType.simpleString()}, "
            "terms array<binary>")
        .where(F.size("terms") > 0),
        "items",
    )
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"), F.col(doc_text).cast("string").alias("text"))
    number, terms = asked.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    groups = max(-(-number // ITEMS), -(-(terms or 0) // TERMS))
    found = spark.createDataFrame([], FOUND)
    for g in range(groups):
        group = asked.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        if listed := group.orderBy("item").collect():
            found = found.unionByName(among(rows, listed, k))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return best.join(asked.select("item", F.col("id").alias("item_id")), "item").select(
        "item_id", "rank", "doc_id", "score")
