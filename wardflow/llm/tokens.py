"""Exact encoding with a public tokenizer, fast on large corpora.

A text is cut where the tokenizer never joins, and each distinct chunk is encoded
once per worker: chunks come back from a bounded table, so most words cost one
lookup. New chunks are normalised and split into pieces by the library as one text, and
each new piece goes to its model; chunks where that could differ go to its batch call.
Of chunks above ``LONG`` characters each piece above ``LONG`` symbols goes through
``joins.encode_long``.
Nothing is trained here.

Cuts are at a space or line feed. Where white space is kept (byte-level BPE) it must
stand alone between two other characters: a piece takes at most one leading space,
and the rule for runs of white space is not touched then. Where white space is
dropped every such place will do.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from wardflow.llm.joins import LONG, encode_long

# About 150 MB per worker when full; pieces share most of their ids with the chunks.
CHUNKS = 800_000
PIECES = 200_000
# Chunks that are split into pieces as one text.
RUN = 4096
CLOSE = re.compile(r"\s\s|\A\s|\s\Z")
LATIN = re.compile(r"[\x00-\xff]*")
MARKS = frozenset(".,;:!?")
LETTERS = frozenset(c for c in map(chr, range(256)) if c.isalpha() or "0" <= c <= "9")
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Encoder:
    """One tokenizer with its table of chunks."""

    def __init__(self, source: str):
        # Tasks share out the cores; the library's own threads would take them twice.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        parts = json.loads(source)
        self.keeps_space = parts["pre_tokenizer"]["type"] == "ByteLevel"
        # A model that marks word ends encodes the middle of a word in another way.
        self.joins = not parts["model"]["end_of_word_suffix"]
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t["content"] for t in parts["added_tokens"]]
        self.special_tokens = special
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.marked: dict[str, bytes] = {}
        self.shown = dict(enumerate(byte_alphabet()))

    def fresh(self) -> None:
        """Begin a task: a full table is emptied, so that it follows the data."""
        if len(self.chunks) >= CHUNKS:
            self.chunks.clear()
            self.pieces.clear()
            self.marked.clear()

    def model(self, symbols: str) -> list[tuple[int, str]]:
        return [(t.id, t.value) for t in self.library.model.tokenize(symbols)]

    def plain(self, text: str) -> list[int]:
        """Ids of a long text without special tokens, its long pieces in halves."""
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        out = []
        for symbols, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            long = len(symbols) > LONG and self.joins
            tokens = encode_long(symbols, self.model) if long else self.model(symbols)
            out += [i for i, _ in tokens]
        return out

    def long_chunk(self, text: str) -> list[int]:
        """Ids of a long chunk; special tokens in it part it, as in the library."""
        out, at = [], 0
        for match in self.special.finditer(text):
            out += [*self.plain(text[at:match.start()]), self.library.token_to_id(match[0])]
            at = match.end()
        return out + self.plain(text[at:])

    def cut(self, text: str) -> list[str]:
        """Chunks of a text."""
        if not self.keeps_space:
            # Latin-1 letters have one lower case each, which the tokenizer takes anyway.
            low = text.lower() if text.isascii() or LATIN.fullmatch(text) else text
            # The library looks for special tokens before, so none may come or go by it.
            if any(low.count(t) != text.count(t) for t in self.special_tokens):
                low = text
            return low.replace("\n", " ").split(" ")
        if CLOSE.search(text):
            return SAFE.split(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return [first, *[p if p[0] == "\n" else " " + p for p in rest]]

    def library_ids(self, chunks: list[str]) -> dict[str, bytes]:
        found, runs, alone = {}, [], []
        keeps_space, model, shown = self.keeps_space, self.library.model, self.shown
        for chunk in chunks:
            # Latin letters, here with the space before them, are one piece.
            inner = chunk[1:] if keeps_space and chunk[:1] == " " else chunk
            if len(chunk) > LONG:
                found[chunk] = array("I", self.long_chunk(chunk)).tobytes()
            elif inner.isalpha() and (inner.isascii() or LATIN.fullmatch(inner)):
                symbols = chunk if keeps_space else chunk.lower()
                if keeps_space or not inner.isascii():
                    symbols = symbols.encode().decode("latin-1").translate(shown)
                found[chunk] = array("I", [t.id for t in model.tokenize(symbols)]).tobytes()
            elif self.joinable(chunk):
                runs.append(chunk)
            else:
                alone.append(chunk)
        for at in range(0, len(runs), RUN):
            self.add_run(runs[at:at + RUN], alone, found)
        for at in range(0, len(alone), 4096):
            some = alone[at:at + 4096]
            encodings = self.library.encode_batch_fast(some, add_special_tokens=False)
            for chunk, encoding in zip(some, encodings):
                found[chunk] = array("I", encoding.ids).tobytes()
        return found

    def joinable(self, chunk: str) -> bool:
        """Whether a chunk's pieces are the same when it stands among others in one text."""
        if not chunk or self.special.search(chunk):
            return False
        if not self.keeps_space:
            return len(chunk.split()) == 1 and not (chunk[0].isspace() or chunk[-1].isspace())
        inner = chunk[1:] if chunk[0] in " \n" else chunk
        return bool(inner) and not (inner[0].isspace() or inner[-1].isspace())

    def add_run(self, chunks: list[str], alone: list[str], found: dict[str, bytes]) -> None:
        """Ids of chunks that are split into pieces as one text, so each piece costs one call.

        Where white space is kept, a line feed parts chunks that begin with a letter: between
        two letters it is a piece of its own, which is left out. Should normalising change
        the number of chunks, they go to the library one by one.
        """
        if self.keeps_space:
            parts = [c if c[0] in " \n" else "\n" + c for c in chunks]
            skip = [p is not c for p, c in zip(parts, chunks)]
            text = "".join(parts)
        else:
            text = " ".join(chunks)
            if self.library.normalizer is not None:
                text = self.library.normalizer.normalize_str(text)
            parts = [p + " " for p in text.split(" ")]
            skip = [False] * len(parts)
            if len(parts) != len(chunks):
                alone += chunks
                return
        starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
        pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
        places = np.array([a for _, (a, _) in pieces])
        owners = (np.searchsorted(starts, places, "right") - 1).tolist()
        first = (places == starts[owners]).tolist()
        out: list[list[bytes]] = [[] for _ in chunks]
        known, model = self.pieces, self.library.model
        for (symbols, _), owner, begins in zip(pieces, owners, first):
            if begins and skip[owner]:
                continue
            ids = known.get(symbols)
            if ids is None:
                ids = array("I", [t.id for t in model.tokenize(symbols)]).tobytes()
                if len(known) < PIECES:
                    known[symbols] = ids
            out[owner].append(ids)
        for chunk, ids in zip(chunks, out):
            found[chunk] = ids[0] if len(ids) == 1 else b"".join(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, as the library's encode without special tokens added."""
        known = self.chunks
        cuts = [self.cut(t) for t in texts]
        found = [list(map(known.get, parts)) for parts in cuts]
        missing, extra = set(), {}
        for parts, ids in zip(cuts, found):
            if None in ids:
                missing.update([p for p, f in zip(parts, ids) if f is None])
        # A closing mark behind a letter is a piece of its own: only the rest is new.
        wanted, marked, remembered = set(), [], self.marked
        for part in missing:
            ids = remembered.get(part)
            if ids is not None:
                extra[part] = ids
            elif part[-1:] in MARKS and part[-2:-1] in LETTERS:
                core = part[:-1]
                marked.append((part, core, part[-1]))
                if core not in known:
                    wanted.add(core)
                if part[-1] not in known:
                    wanted.add(part[-1])
            else:
                wanted.add(part)
        new = self.library_ids(list(wanted))
        extra.update(new)
        for part, core, mark in marked:
            ids = (known.get(core) or new[core]) + (known.get(mark) or new[mark])
            extra[part] = ids
            if len(remembered) < PIECES:
                remembered[part] = ids
        out = [
            b"".join(ids if None not in ids else
                     [extra[p] if f is None else f for p, f in zip(parts, ids)])
            for parts, ids in zip(cuts, found)
        ]
        room = CHUNKS - len(known)
        for part, ids in new.items():
            if room > 0 and len(part) <= LONG:
                known[part] = ids
                room -= 1
        return [np.frombuffer(ids, np.uint32) for ids in out]

    def byte_table(self) -> list[bytes]:
        """The bytes each id stands for."""
        back = {c: b for b, c in enumerate(byte_alphabet())}
        table = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            known = all(c in back for c in token)
            table[i] = bytes(back[c] for c in token) if known else token.encode()
        return table


def byte_alphabet() -> str:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer's file, the default of ``path`` arguments."""
    import public_tokenizers

    return public_tokenizers.path(name)


def share(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file for the executors; it has a fixed size of a few MB."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


_encoders: dict[int, tuple[str, Encoder]] = {}


def encoder(shared: Broadcast) -> Encoder:
    """This worker's encoder of a shared tokenizer."""
    source = shared.value
    key = hash(source)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = (source, Encoder(source))
    found = _encoders[key][1]
    found.fresh()
    return found


def strings(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as empty."""
    return [value or "" for value in column.to_pylist()]
