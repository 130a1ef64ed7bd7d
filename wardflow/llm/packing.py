"""Hierarchical packing of token ids into context windows of several sizes.

Documents are encoded where they are read and packed in units of about ``UNIT`` tokens,
so a task holds one unit and nothing is shuffled. Within a unit:

* A document above the longest window gives whole windows; the rest is routed to the
  smallest tier that holds it.
* Tiers are packed from long to short. A window opens with its tier's longest piece; its
  gap takes the longest piece that fits, from any tier at or below, again and again.
* When no piece fits, the shortest one available is cut to close the gap, and what is
  left of it goes to the tier it now fits.
* The last window, for which pieces have run out, is closed at the powers of two that
  its length is made of.

So every window has a power of two of tokens and needs no padding. Finished windows of
a tier are dealt out into step groups of about ``STEP`` tokens, the most costly first,
each to the group with the least attention cost (sum of squared piece lengths) so
far; a group's number is ``step_group``.

Sequence and group numbers begin with the partition's number, so a task that runs
again gives the same ones. Defined results: null and empty texts are the closing id
alone. Repeated rows are packed each time; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import pieces, ship
from wardflow.llm.tokens import encoder, share, strings

TIERS = (256, 512, 1024, 2048)
UNIT = 1 << 20
STEP = 1 << 16
CLOSING_ID = 1

# A piece: length, document's place in the unit, start.
Piece = tuple[int, int, int]


def powers(length: int) -> list[int]:
    """The powers of two a length is made of, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def pack_unit(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Windows of a unit, each a list of pieces in order."""
    longest = tiers[-1]
    windows: list[list[Piece]] = []
    rest: list[Piece] = []
    for doc, length in enumerate(lengths):
        whole = length // longest * longest
        windows += [[(longest, doc, start)] for start in range(0, whole, longest)]
        if length > whole:
            rest.append((length - whole, doc, whole))
    rest.sort()
    while rest:
        first = rest.pop()
        size = next(t for t in tiers if t >= first[0])
        window, gap = [first], size - first[0]
        while gap and rest:
            at = bisect_right(rest, (gap, len(lengths), 0)) - 1
            if at >= 0:
                piece = rest.pop(at)
            else:
                length, doc, start = rest.pop(0)
                piece = (gap, doc, start)
                insort(rest, (length - gap, doc, start + gap))
            window.append(piece)
            gap -= piece[0]
        windows += close(window, size - gap) if gap else [window]
    return windows


def close(window: list[Piece], length: int) -> list[list[Piece]]:
    """Cut an open window into windows of powers of two."""
    out = []
    waiting = window[::-1]
    for size in powers(length):
        now = []
        while size:
            have, doc, start = waiting.pop()
            take = min(have, size)
            now.append((take, doc, start))
            if take < have:
                waiting.append((have - take, doc, start + take))
            size -= take
        out.append(now)
    return out


def step_groups(windows: list[list[Piece]], step: int = STEP) -> list[int]:
    """A group for each window; windows of one size share groups."""
    sizes = [sum(p[0] for p in w) for w in windows]
    costs = [sum(p[0] * p[0] for p in w) for w in windows]
    groups = [0] * len(windows)
    used = 0
    for size in sorted(set(sizes)):
        members = [i for i, s in enumerate(sizes) if s == size]
        room = max(1, step // size)
        number = -(-len(members) // room)
        heap = [(0, used + g, 0) for g in range(number)]
        for i in sorted(members, key=lambda i: -costs[i]):
            cost, group, count = heapq.heappop(heap)
            groups[i] = group
            if count + 1 < room:
                heapq.heappush(heap, (cost + costs[i], group, count + 1))
        used += number
    return groups


COLUMNS = (
    "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window bigint, step_group bigint"
)


class Packer:
    """Packs the documents of one partition, unit by unit."""

    def __init__(self, partition: int, tiers: tuple[int, ...], with_ids: bool):
        self.base = partition << 40
        self.tiers, self.with_ids = tiers, with_ids
        self.sequences = self.groups = 0
        self.names: list = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, name, ids: np.ndarray) -> None:
        self.names.append(name)
        self.ids.append(ids)
        self.size += len(ids)

    def flush(self) -> pa.RecordBatch:
        windows = pack_unit([len(i) for i in self.ids], self.tiers)
        groups = step_groups(windows)
        rows, tokens = [], []
        for window, group in zip(windows, groups):
            offset, size = 0, sum(p[0] for p in window)
            for length, doc, start in window:
                piece = self.ids[doc][start:start + length]
                rows.append((
                    self.names[doc], start, length, zlib.crc32(piece.astype("<u4").tobytes()),
                    len(self.ids[doc]), self.base + self.sequences, offset, size,
                    self.base + self.groups + group,
                ))
                tokens.append(piece)
                offset += length
            self.sequences += 1
        self.groups += max(groups, default=-1) + 1
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        arrays = [pa.array(c, pa.int64()) for c in zip(*rows)]
        if self.with_ids:
            names.append("ids")
            arrays.append(pa.array(tokens, pa.list_(pa.int32())))
        self.names, self.ids, self.size = [], [], 0
        return pa.record_batch(arrays, names=names)


def _pack(shared, tiers: tuple[int, ...], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared)
        packer = Packer(TaskContext.get().partitionId(), tiers, with_ids)
        end = np.array([CLOSING_ID], np.uint32)
        for batch in batches:
            for part in pieces(batch, "text"):
                names = part.column("id").to_pylist()
                for name, ids in zip(names, known.encode(strings(part.column("text")))):
                    packer.add(name, np.concatenate((ids, end)))
                    if packer.size >= UNIT:
                        yield packer.flush()
        if packer.ids:
            yield packer.flush()

    return run


def pack(
    df: DataFrame, id_col: str, text_col: str, path: str, tiers: tuple[int, ...] = TIERS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``with_ids`` adds its token ids.

    ``tiers`` are increasing powers of two. ``window`` is the number of tokens in the
    piece's sequence.
    """
    if list(tiers) != sorted(set(tiers)) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be increasing powers of two")
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = COLUMNS + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_pack(share(df.sparkSession, path), tiers, with_ids), schema)
