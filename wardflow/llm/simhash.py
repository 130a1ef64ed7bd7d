"""SimHash near-duplicates by tiled exact comparison.

Words are runs of anything but space and the control characters 9 to 13, after
lower-casing A-Z. A document's shingles are hashed with XXH64; a fingerprint bit is
set where over half of the hashes, repeats included, have it.

Fingerprints are compared exactly, in tiles, with numpy's exclusive-or and bit
counts. Two levels keep the number of tiles down, neither of which loses a link:

* Spark deals distinct fingerprints into cells outside which no link is possible:
  a cell is one value of one of radius + 1 segments, as two fingerprints within the
  radius have one of these segments equal. A cell with over ``BLOCK`` fingerprints is
  cut into blocks and every pair of blocks is a unit of its own, so no task needs more
  than two blocks.
* Within a unit both sides are sorted by population count and cut into tiles;
  pairs of tiles whose population counts differ by more than the radius are skipped.
  Units of up to ``SMALL`` fingerprints are compared together, without tiles.

A unit returns a spanning forest of its links, not all of them: components are the
same and a group of n near copies gives n - 1 rows.

Defined results: null text is empty; without words the fingerprint is zero and
linked like any other. Null ids take no part as smallest ids, so a group of
null ids only has a null component. Repeated rows, equal ids and extra columns do
no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import pieces, ship, stored, unused
from wardflow.llm.components import components
from wardflow.llm.words import LOWERED, words_of, xxh64_spans

BLOCK = 2048
TILE = 512
SMALL = 16


def shingles_of(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and the text of each."""
    words = words_of(texts, LOWERED)
    owner, counts = words.owner, words.counts
    if not len(owner):
        return np.zeros(0, np.uint64), owner
    # A shingle starts at each word that has width - 1 more of its text behind it;
    # a shorter text is one shingle.
    order = np.arange(len(owner)) - words.first[owner]
    shingle = np.flatnonzero((order + width <= counts[owner]) | (order == 0))
    span = np.minimum(width, counts[owner[shingle]])
    starts = words.starts[shingle]
    hashes = xxh64_spans(words.data, starts, words.ends[shingle + span - 1] - starts)
    return hashes, owner[shingle]


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """Fingerprint of each of a list of texts."""
    hashes, of = shingles_of(texts, width)
    out = np.zeros(len(texts), np.uint64)
    if not len(of):
        return out
    cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    sizes = np.diff(np.concatenate((cuts, [len(of)])))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")
    out[of[cuts]] = packed.view("<u8")[:, 0]
    return out


def _fingerprint_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.record_batch(
                    [part.column("id"), part.column("mark"),
                     pa.array(fingerprints(texts, width).view(np.int64))],
                    names=["id", "mark", "f0"])

    return run


def text_mark(text: str) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fingerprint_table(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Columns id, mark and f0 (the fingerprint) of every row."""
    ship(df.sparkSession)
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), text_mark(text_col).alias("mark"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(_fingerprint_batches(width), "id bigint, mark bigint, f0 bigint")


# --- Links --------------------------------------------------------------------


class Links:
    """Spanning forest of the links found so far in one unit."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self.edges: list[tuple[int, int]] = []

    def add(self, i: int, others: np.ndarray) -> None:
        labels = self.label[others]
        fresh = labels != self.label[i]
        if not fresh.any():
            return
        found, where = np.unique(labels[fresh], return_index=True)
        self.edges.extend((i, int(j)) for j in others[fresh][where])
        merged = np.append(found, self.label[i])
        self.label[np.isin(self.label, merged)] = merged.min()


def compare(
    prints: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, radius: int, links: Links
) -> None:
    """Link the rows ``left`` with the rows ``right``, tile by tile."""
    weight = np.bitwise_count(prints).astype(np.int64)
    left = left[np.argsort(weight[left], kind="stable")]
    right = left if same else right[np.argsort(weight[right], kind="stable")]
    for a in range(0, len(left), TILE):
        rows = left[a:a + TILE]
        for b in range(a if same else 0, len(right), 2 * TILE):
            columns = right[b:b + 2 * TILE]
            if weight[columns[0]] - weight[rows[-1]] > radius:
                break
            if weight[rows[0]] - weight[columns[-1]] > radius:
                continue
            near = np.bitwise_count(prints[rows][:, None] ^ prints[columns][None, :]) <= radius
            if not near.any():
                continue
            # Rows that are connected already need not be looked at again.
            near &= links.label[rows][:, None] != links.label[columns][None, :]
            for i in np.flatnonzero(near.any(axis=1)):
                links.add(int(rows[i]), columns[near[i]])


def _unit_links(nodes, prints, block, radius: int) -> list[tuple[int, int]]:
    """Links of one unit: a cell, or two blocks of a large one."""
    links = Links(len(nodes))
    sides = [np.flatnonzero(block == b) for b in np.unique(block)]
    compare(prints, sides[0], sides[-1], len(sides) == 1, radius, links)
    return [(int(nodes[i]), int(nodes[j])) for i, j in links.edges]


def _small_links(unit, nodes, prints, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within small units, all units of a batch together."""
    a, b, step = [], [], 1
    while len(unit) > step and len(same := np.flatnonzero(unit[step:] == unit[:-step])):
        hit = same[np.bitwise_count(prints[same] ^ prints[same + step]) <= radius]
        a.append(nodes[hit])
        b.append(nodes[hit + step])
        step += 1
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(a or empty), np.concatenate(b or empty)


def _link_batches(radius: int):
    """Compare units that arrive sorted, of which only the last may be unfinished."""

    def finish(rows: pa.Table) -> pa.RecordBatch:
        get = lambda name: rows.column(name).to_numpy()
        cell, lo, hi = get("cell"), get("lo"), get("hi")
        new = np.concatenate(
            ([True], (cell[1:] != cell[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        unit = np.cumsum(new) - 1
        size = np.bincount(unit)
        nodes, block, prints = get("node"), get("block"), get("f0").view(np.uint64)
        small = (size[unit] <= SMALL) & (lo == hi)
        a, b = _small_links(unit[small], nodes[small], prints[small], radius)
        edges = []
        first = np.flatnonzero(new)
        for u in np.flatnonzero(~small[first]):
            part = slice(first[u], first[u] + size[u])
            if lo[first[u]] != hi[first[u]] and len(np.unique(block[part])) < 2:
                continue
            edges += _unit_links(nodes[part], prints[part], block[part], radius)
        more = np.array(edges, np.int64).reshape(-1, 2)
        return pa.record_batch(
            [pa.array(np.concatenate((a, more[:, 0]))), pa.array(np.concatenate((b, more[:, 1])))],
            names=["a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "lo", "hi")], axis=1)
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            start = int(changes[-1]) + 1 if len(changes) else 0
            if waiting:
                last = waiting[-1]
                before = [last.column(c)[last.num_rows - 1].as_py() for c in ("cell", "lo", "hi")]
                if start == 0 and before == keys[0].tolist():
                    waiting.append(batch)
                    continue
            done = waiting + ([batch.slice(0, start)] if start else [])
            if done:
                yield finish(pa.Table.from_batches(done))
            waiting = [batch.slice(start)]
        if waiting:
            yield finish(pa.Table.from_batches(waiting))

    return run


def segment_cells(radius: int) -> Column:
    """Array of cells: a value of each of radius + 1 segments of f0."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    cells = []
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        mask = (1 << (high - low)) - 1 if high - low < 64 else -1
        value = F.shiftrightunsigned(F.col("f0"), low).bitwiseAND(F.lit(mask))
        cells.append(value * (radius + 1) + i)
    return F.array(*cells)


def find_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links a, b between the nodes of ``prints`` (node, f0)."""
    rows = prints.select("node", "f0", F.explode(segment_cells(radius)).alias("cell"))
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.where("n > 1"), "cells")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    keys = ["cell", "lo", "hi"]
    return (
        rows.join(sizes, "cell").withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "node", "f0",
        )
        .repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_link_batches(radius), "a bigint, b bigint")
    )


def near_groups(
    df: DataFrame, id_col: str, text_col: str, width: int = 3, radius: int = 2
) -> DataFrame:
    """Columns id, mark, f0, component: the smallest id of each row's group."""
    rows = stored(fingerprint_table(df, id_col, text_col, width), "fingerprints")
    prints = stored(
        rows.groupBy("f0").agg(F.min("id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct",
    )
    found = components(find_links(prints, radius), "a", "b")
    rooted = prints.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    linked = rooted.where(F.col("root") != F.col("node"))
    smallest = linked.select("root", "least").unionByName(
        linked.select("root").distinct().join(
            prints.select(F.col("node").alias("root"), "least"), "root")
    ).groupBy("root").agg(F.min("least").alias("component"))
    labelled = stored(
        rooted.join(smallest, "root", "left")
        .select("f0", F.coalesce("component", "least").alias("component")),
        "labelled",
    )
    return rows.join(labelled, "f0").select("id", "mark", "f0", "component")


def near_dedup(
    df: DataFrame, id_col: str, text_col: str, width: int = 3, radius: int = 2
) -> DataFrame:
    """The rows of ``df`` that stay: of each group of :func:`near_groups` the smallest id.

    Rows without an id stay. A row that is there several times, with one id and text, is
    one document; such rows stay or go together, and so do near texts of one id.
    """
    groups = near_groups(df, id_col, text_col, width, radius)
    mark, gone_id, gone_mark = (unused(df, c) for c in ("_mark", "_gone_id", "_gone_mark"))
    gone = groups.where(F.col("id") > F.col("component")).select(
        F.col("id").alias(gone_id), F.col("mark").alias(gone_mark)).distinct()
    here = (F.col(id_col) == F.col(gone_id)) & (F.col(mark) == F.col(gone_mark))
    return (
        df.withColumn(mark, text_mark(text_col)).join(gone, here, "left_anti").select(*df.columns)
    )
