"""Repeated passages, found with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. Words covered by a window that also starts in
a document with a smaller id are removed.

Broadcasting automata of the whole corpus to every document would cost the square of
the corpus, so documents and shards are brought together instead:

1. Of every window the anchor is taken: the group of ``GRAM`` words with the smallest
   hash. Equal windows have equal anchors, and neighbouring windows mostly share one.
   Anchors that occur in two documents at least are the shared ones; no other window
   can repeat.
2. Anchors in over ``HOT`` documents are hot. Their windows are counted, equal ones of a
   batch together; those in over ``HOT`` places are busy. The documents that have
   busy windows first are the references that all others meet: their passages of busy
   windows are broadcast as one suffix automaton, at most ``BUSY`` windows, the most
   frequent ones. Any other window is in few places, or in a share of 1 / ``BUSY`` at most.
3. Documents are streamed. Busy windows go through the broadcast automaton: where its
   matching statistic reaches ``WINDOW`` words of an earlier document, they are covered.
   Other windows of hot anchors go to a shard each; the windows around each cold anchor,
   joined into one stretch of words, go to that anchor's shard.
4. In a shard stretches arrive in the order of document ids. Each one is streamed
   through the suffix automaton of the stretches of smaller ids, and then added to it,
   unless it is there already. Words are compared as they are: hashes only decide who
   meets whom.
5. Covers go back to their documents, which are read once more.

Up to ``BROADCAST_ANCHORS`` shared anchors are sent to the readers as one sorted array;
above that each document gets its own from a join. Both give the same covers.

Defined results: null text has no words. Rows without an id lose nothing and are no
reference. Rows of equal id and text share their covers; an id with several texts
never covers itself. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardflow.llm.common import pieces, ship, stored
from wardflow.llm.words import Words, words_of, xxh64_spans
from wardflow.operators.attach import attach

WINDOW = 13
GRAM = 5
HOT = 2000
BUSY = 100_000
BROADCAST_ANCHORS = 4_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xBF58476D1CE4E5B9)

def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for i in range(1, width):
            total *= STEP
            total += hashes[i:i + n]
        total ^= total >> np.uint64(31)
        total *= SPREAD
        return total ^ (total >> np.uint64(29))


def anchors_of(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window, its anchor's hash and the anchor's place.

    Of equal hashes in a window the leftmost counts.
    """
    order = np.arange(len(hashes)) - words.first[words.owner]
    starts = np.flatnonzero(order + WINDOW <= words.counts[words.owner])
    if not len(starts):
        return starts, starts, starts
    grams = rolling(hashes, GRAM)
    count = len(grams) - (WINDOW - GRAM)
    best, place = grams[:count].copy(), np.zeros(count, np.int64)
    for i in range(1, WINDOW - GRAM + 1):
        less = grams[i:i + count] < best
        best[less] = grams[i:i + count][less]
        place[less] = i
    return starts, best[starts].view(np.int64), place[starts] + starts


def read_words(part: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    """Words of a batch's texts and their hashes."""
    texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
    words = words_of(texts)
    return words, xxh64_spans(words.data, words.starts, words.ends - words.starts)


def runs(places: np.ndarray) -> np.ndarray:
    """Where a run of windows with one anchor begins."""
    return np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            words, hashes = read_words(part)
            starts, anchors, places = anchors_of(words, hashes)
            if not len(starts):
                continue
            new = runs(places)
            texts = pa.array(words.owner[starts[new]])
            columns = [part.column(c).take(texts) for c in part.schema.names if c != "text"]
            names = [c for c in part.schema.names if c != "text"]
            yield pa.record_batch([pa.array(anchors[new]), *columns], names=["anchor", *names])


def among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ones."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


class Wanted:
    """Which anchors are shared: two sorted arrays, or lists beside each text."""

    def __init__(self, sent):
        self.cold, self.hot = sent.value if sent is not None else (None, None)

    def find(self, part: pa.RecordBatch, owners: np.ndarray, anchors: np.ndarray, name: str) -> np.ndarray:
        known = getattr(self, name)
        if known is not None:
            return among(known, anchors)
        own = [set(row or ()) for row in part.column(name).to_pylist()]
        return np.array([a in own[t] for t, a in zip(owners.tolist(), anchors.tolist())], bool)


class Runs:
    """Runs of windows with one anchor, in all texts of a batch."""

    def __init__(self, part: pa.RecordBatch):
        self.part = part
        self.words, self.hashes = read_words(part)
        starts, anchors, places = anchors_of(self.words, self.hashes)
        new = runs(places) if len(starts) else starts
        self.first, self.anchor = starts[new], anchors[new]
        self.last = starts[np.concatenate((new[1:], [len(places)])) - 1] if len(starts) else starts
        self.text = self.words.owner[self.first] if len(starts) else starts

    def of(self, wanted: Wanted, name: str) -> np.ndarray:
        return np.flatnonzero(wanted.find(self.part, self.text, self.anchor, name))

    def windows(self, some: np.ndarray) -> np.ndarray:
        """First words of all windows of some runs."""
        if not len(some):
            return some
        count = self.last[some] - self.first[some] + 1
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.first[some], count) + offset

    def names(self) -> np.ndarray:
        """Hash of the window that begins at each word."""
        return rolling(self.hashes, WINDOW).view(np.int64)


def _window_batches(sent):
    """Windows of hot anchors, equal ones of a batch in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Wanted(sent)
        for batch in batches:
            for part in pieces(batch, "text"):
                found = Runs(part)
                at = found.windows(found.of(wanted, "hot"))
                if not len(at):
                    continue
                name = found.names()[at]
                # Two hashes together tell windows of a batch apart.
                other = rolling(found.hashes ^ SPREAD, WINDOW)[at]
                text = found.words.owner[at]
                ids = part.column("id").to_numpy(zero_copy_only=False)[text]
                order = np.lexsort((at, ids, other, name))
                at, name, other, text, ids = (x[order] for x in (at, name, other, text, ids))
                new = np.flatnonzero(np.concatenate((
                    [True], (name[1:] != name[:-1]) | (other[1:] != other[:-1]))))
                words = [found.words.run(a, a + WINDOW) for a in at[new].tolist()]
                yield pa.record_batch(
                    [pa.array(name[new]), pa.array(words, pa.binary()), pa.array(ids[new]),
                     part.column("mark").take(pa.array(text[new])),
                     pa.array(at[new] - found.words.first[text[new]]),
                     pa.array(np.maximum.reduceat(ids, new)),
                     pa.array(np.diff(np.concatenate((new, [len(at)]))))],
                    names=["window", "words", "id", "mark", "start", "high", "n"])

    return run


def _stretch_batches(sent, busy_sent):
    """What goes to shards, and the covers that the broadcast automaton finds (no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, busy = Wanted(sent), references(busy_sent)
        for batch in batches:
            for part in pieces(batch, "text"):
                rows = stretches(Runs(part), wanted, busy)
                text, shard, start, stop, found = list(zip(*rows)) or [()] * 5
                at = pa.array(text, pa.int64())
                yield pa.record_batch(
                    [pa.array(shard, pa.int64()), part.column("id").take(at),
                     part.column("mark").take(at), pa.array(start, pa.int64()),
                     pa.array(stop, pa.int64()), pa.array(found, pa.binary())],
                    names=["shard", "id", "mark", "start", "stop", "words"])

    return run


def stretches(found: Runs, wanted: Wanted, busy: References) -> list[tuple]:
    """(text, shard, first word, end, words) of stretches for shards and of covers."""
    words = found.words
    cold = found.of(wanted, "cold")
    text, first, last = found.text[cold], found.first[cold], found.last[cold]
    columns = (c.tolist() for c in (text, found.anchor[cold], first, last, words.first[text]))
    out = [
        (t, s, a - o, b + WINDOW - o, words.run(a, b + WINDOW)) for t, s, a, b, o in zip(*columns)
    ]
    at = found.windows(found.of(wanted, "hot"))
    if not len(at):
        return out
    names = found.names()
    is_busy = among(busy.names, names[at])
    alone = at[~is_busy].tolist()
    at = at[is_busy]
    if len(at):
        # Neighbouring windows of one text are streamed as one passage.
        owner = words.owner[at]
        cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner) != 0)) + 1
        ids = found.part.column("id").to_numpy(zero_copy_only=False)
        # Covers only pass through on their way; by document, so that no task has those of
        # a passage that very many documents share.
        with np.errstate(over="ignore"):
            lanes = (ids.astype(np.uint64) * STEP).view(np.int64)
        for some in np.split(at, cuts):
            a, b = int(some[0]), int(some[-1])
            t = int(words.owner[a])
            o = int(words.first[t])
            covers, unknown = busy.covers(words.run(a, b + WINDOW).split(b" "), int(ids[t]))
            out += [(t, int(lanes[t]), a - o + x, a - o + y, None) for x, y in covers]
            alone += [a + x for x in unknown]
    for a in alone:
        t = int(words.owner[a])
        o = int(words.first[t])
        out.append((t, int(names[a]), a - o, a - o + WINDOW, words.run(a, a + WINDOW)))
    return out


class SuffixAutomaton:
    """Suffix automaton over words, of several stretches parted by marks."""

    def __init__(self):
        self.moves: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.last = 0
        self.parts = 0
        self.origin: list[int | None] = [None]

    def add(self, words: list[bytes]) -> None:
        for word in words:
            self._extend(word)
        self.parts += 1
        self._extend(self.parts)  # a number is no word, so nothing matches across

    def _extend(self, word) -> None:
        moves, link, size = self.moves, self.link, self.size
        new = len(moves)
        moves.append({})
        link.append(0)
        size.append(size[self.last] + 1)
        self.origin.append(None)
        at = self.last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = link[at]
        if at >= 0:
            to = moves[at][word]
            if size[at] + 1 == size[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                self.origin.append(to)
                while at >= 0 and moves[at].get(word) == to:
                    moves[at][word] = copy
                    at = link[at]
                link[to] = link[new] = copy
        self.last = new

    def covers(self, words: list[bytes], least: int = WINDOW) -> list[tuple[int, int]]:
        """Maximal spans of words covered by matches of at least ``least`` words."""
        moves, link, size = self.moves, self.link, self.size
        out: list[tuple[int, int]] = []
        at = length = 0
        for i, word in enumerate(words):
            while at and word not in moves[at]:
                at = link[at]
                length = size[at]
            if word in moves[at]:
                at = moves[at][word]
                length += 1
            if length >= least:
                start = i + 1 - length
                if out and start <= out[-1][1]:
                    out[-1] = (min(out[-1][0], start), i + 1)
                else:
                    out.append((start, i + 1))
        return out


class References:
    """The automaton of all busy passages; each state knows a document it comes from.

    A busy window has one first document, and all passages it occurs in are that one's.
    """

    def __init__(self, names: np.ndarray, passages: list[tuple[int, bytes]]):
        self.names = names
        self.automaton = SuffixAutomaton()
        owners: list[int] = [0]
        for number, words in passages:
            before = len(self.automaton.moves)
            self.automaton.add(words.split(b" "))
            owners += [number] * (len(self.automaton.moves) - before)
        # A state that was split off has the document of the longer one it came from.
        for state, longer in enumerate(self.automaton.origin):
            if longer is not None:
                owners[state] = owners[longer]
        self.owners = owners

    def covers(self, words: list[bytes], number: int) -> tuple[list[tuple[int, int]], list[int]]:
        """Spans covered by documents before ``number``, and starts of unknown windows."""
        moves, link, size = self.automaton.moves, self.automaton.link, self.automaton.size
        spans: list[tuple[int, int]] = []
        unknown = []
        at = length = 0
        for i, word in enumerate(words):
            while at and word not in moves[at]:
                at = link[at]
                length = size[at]
            if word in moves[at]:
                at = moves[at][word]
                length += 1
            start = i + 1 - WINDOW
            if start < 0:
                continue
            if length < WINDOW:
                unknown.append(start)
            elif self.owners[at] < number:
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
        return spans, unknown


def passages_of(windows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, bytes]]:
    """Join windows (id, mark, start, words) that follow one another in a document."""
    out: list[tuple[int, list[bytes]]] = []
    before = None
    for number, mark, start, words in sorted(windows):
        if before == (number, mark, start - 1):
            out[-1][1].append(words.rsplit(b" ", 1)[-1])
        else:
            out.append((number, [words]))
        before = (number, mark, start)
    return [(number, b" ".join(parts)) for number, parts in out]


_references: list[tuple[list, References]] = []


def references(sent) -> References:
    """This worker's automaton of the broadcast passages, the last ones it has seen."""
    names, passages = sent.value
    if not _references or _references[0][0] is not passages:
        _references[:] = [(passages, References(names, passages))]
    return _references[0][1]


class Shard:
    """Stretches of one shard so far, in the order of document ids."""

    def __init__(self):
        self.known: set[bytes] = set()
        self.waiting: list[bytes] = []
        self.automaton: SuffixAutomaton | None = None
        self.id: int | None = None
        self.added: list[bytes] = []

    def take(self, number: int, words: bytes) -> list[tuple[int, int]]:
        """Covers of a stretch by documents of smaller ids."""
        if number != self.id:
            for one in self.waiting:
                if one not in self.known:
                    self.known.add(one)
                    self.added.append(one)
            self.waiting, self.id = [], number
        if words in self.known:
            return [(0, words.count(b" ") + 1)]
        self.waiting.append(words)
        if not self.known:
            return []
        if self.automaton is None:
            self.automaton = SuffixAutomaton()
        for one in self.added:
            self.automaton.add(one.split(b" "))
        self.added = []
        return self.automaton.covers(words.split(b" "))


def _cover_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, shard = None, Shard()
    for batch in batches:
        rows = []
        columns = [c.to_pylist() for c in batch.columns]
        for name, number, mark, start, stop, words in zip(*columns):
            if words is None:
                rows.append((number, mark, start, stop))
                continue
            if name != now:
                now, shard = name, Shard()
            rows += [(number, mark, start + a, start + b) for a, b in shard.take(number, words)]
        yield pa.record_batch(
            [pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [()] * 4)],
            names=["id", "mark", "start", "stop"])


def kept_words(words: Words, text: int, spans: list[dict]) -> tuple[int, bytes]:
    """Number of words removed, and those left joined by one space."""
    first, count = int(words.first[text]), int(words.counts[text])
    out, at, gone = [], 0, 0
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if start > at:
            out.append(words.run(first + at, first + start))
        gone += max(0, stop - max(at, start))
        at = max(at, stop)
    if at < count:
        out.append(words.run(first + at, first + count))
    return gone, b" ".join(out)


def _finish(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words = words_of(
                    [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()])
                found = [
                    kept_words(words, i, spans)
                    for i, spans in enumerate(part.column("spans").to_pylist())
                ]
                columns = [
                    part.column("id"), pa.array(words.counts, pa.int64()),
                    pa.array([gone for gone, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(left).hexdigest() for _, left in found]),
                ]
                names = ["id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(
                        pa.array([left for _, left in found], pa.binary()).cast(pa.string()))
                    names.append("kept")
                yield pa.record_batch(columns, names=names)

    return run


def text_mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def remove_repeats(df: DataFrame, id_col: str, text_col: str, with_text: bool = False) -> DataFrame:
    """Columns id, n_words, n_removed, kept_sha256 and, if asked for, kept (the text)."""
    spark = df.sparkSession
    ship(spark)
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"), text_mark(text_col).alias("mark"),
        F.col(text_col).cast("string").alias("text"),
    )
    named = rows.where(F.col("id").isNotNull())
    anchors = named.select("id", "text").mapInArrow(_anchor_batches, "anchor bigint, id bigint")
    shared = stored(
        anchors.groupBy("anchor")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("anchor", (F.col("n") > HOT).alias("hot")),
        "anchors",
    )
    sent, readers = with_shared(named, shared)
    dealt = readers.mapInArrow(
        _stretch_batches(sent, busy_passages(readers, shared, sent)),
        "shard bigint, id bigint, mark bigint, start bigint, stop bigint, words binary")
    covers = (
        dealt.repartition("shard").sortWithinPartitions("shard", "id")
        .mapInArrow(_cover_batches, "id bigint, mark bigint, start bigint, stop bigint")
        .groupBy("id", "mark")
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    schema = "id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return (
        rows.join(stored(covers, "covers"), ["id", "mark"], "left")
        .select("id", "text", "spans")
        .mapInArrow(_finish(with_text), schema + (", kept string" if with_text else ""))
    )


def with_shared(named: DataFrame, shared: DataFrame):
    """Shared anchors as a broadcast, or beside each text if they are too many."""
    if shared.limit(BROADCAST_ANCHORS + 1).count() <= BROADCAST_ANCHORS:
        found = shared.orderBy("anchor").toArrow()
        anchors = found.column("anchor").to_numpy()
        hot = found.column("hot").to_numpy(zero_copy_only=False).astype(bool)
        return named.sparkSession.sparkContext.broadcast((anchors[~hot], anchors[hot])), named
    own = anchors_by_text(named).join(shared, "anchor").groupBy("id", "mark").agg(
        F.collect_list(F.expr("case when not hot then anchor end")).alias("cold"),
        F.collect_list(F.expr("case when hot then anchor end")).alias("hot"))
    return None, named.join(stored(own, "wanted"), ["id", "mark"])


def busy_passages(readers: DataFrame, shared: DataFrame, sent):
    """Broadcast (window hashes, passages) of busy windows, by their first documents."""
    context = readers.sparkSession.sparkContext
    if shared.where("hot").isEmpty():
        return context.broadcast((np.zeros(0, np.int64), []))
    windows = readers.mapInArrow(
        _window_batches(sent),
        "window bigint, words binary, id bigint, mark bigint, start bigint, high bigint, n bigint")
    busy = (
        windows.groupBy("window", "words")
        .agg(F.min(F.struct("id", "mark", "start")).alias("first"), F.max("high").alias("high"),
             F.sum("n").alias("n"))
        .where((F.col("n") > HOT) & (F.col("first.id") < F.col("high")))
        .orderBy(F.col("n").desc(), "window", "words").limit(BUSY)
        .select("window", "first.*", "words")
    )
    found = busy.collect()  # at most BUSY rows of 13 words
    names = np.array(sorted({r["window"] for r in found}), np.int64)
    rows = [(r["id"], r["mark"], r["start"], bytes(r["words"])) for r in found]
    return context.broadcast((names, passages_of(rows)))


def anchors_by_text(named: DataFrame) -> DataFrame:
    """Anchors with the id and mark of the text they are in."""
    return named.mapInArrow(
        _anchor_batches, "anchor bigint, id bigint, mark bigint").distinct()
