"""Words of many texts at once, as places in one buffer, and their hashes.

Words are runs of anything but space and the control characters 9 to 13.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

SEED = 42

# Fixed values of XXH64.
P1, P2, P3, P4, P5 = (
    np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9),
    np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5),
)
SPACED = bytes.maketrans(bytes(range(9, 14)), b" " * 5)
LOWERED = bytes.maketrans(
    bytes(range(65, 91)) + bytes(range(9, 14)), bytes(range(97, 123)) + b" " * 5)


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(state, lane):
    return _rotl(state + lane * P2, 31) * P1


def xxh64_spans(data: bytes, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many spans of one buffer; all spans take each step together."""
    n = len(data)
    padded = data + bytes(16)
    at8 = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    at4 = np.ndarray((n + 8,), "<u4", padded, strides=(1,))
    at1 = np.frombuffer(padded, np.uint8)
    with np.errstate(over="ignore"):
        h = np.uint64(seed) + P5 + lengths.astype(np.uint64)
        place = starts.copy()
        left = lengths.copy()
        wide = np.flatnonzero((lengths >= 32) & (lengths < 64))
        if len(wide):
            s = starts[wide]
            zero = np.uint64(seed)
            v = [_round(zero + first, at8[s + 8 * i])
                 for i, first in enumerate((P1 + P2, P2, np.uint64(0), np.uint64(0) - P1))]
            mixed = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                mixed = (mixed ^ _round(np.uint64(0), x)) * P1 + P4
            h[wide] = mixed + lengths[wide].astype(np.uint64)
            place[wide] += 32
            left[wide] -= 32
        left[lengths >= 64] = 0
        while len(some := np.flatnonzero(left >= 8)):
            h[some] = _rotl(h[some] ^ _round(np.uint64(0), at8[place[some]]), 27) * P1 + P4
            place[some] += 8
            left[some] -= 8
        some = np.flatnonzero(left >= 4)
        h[some] = _rotl(h[some] ^ (at4[place[some]].astype(np.uint64) * P1), 23) * P2 + P3
        place[some] += 4
        left[some] -= 4
        while len(some := np.flatnonzero(left > 0)):
            h[some] = _rotl(h[some] ^ (at1[place[some]].astype(np.uint64) * P5), 11) * P1
            place[some] += 1
            left[some] -= 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(lengths >= 64):
        s = int(starts[i])
        h[i] = xxhash.xxh64_intdigest(data[s:s + int(lengths[i])], seed)
    return h


@dataclass(frozen=True)
class Words:
    """Words of some texts: ``data`` has them with one space between.

    Word i is data[starts[i]:ends[i]] and belongs to the text ``owner[i]``, whose words
    are ``first[t]`` up to ``first[t] + counts[t]``.
    """

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    def run(self, a: int, b: int) -> bytes:
        """The words a up to b, all of one text, joined by one space."""
        return self.data[self.starts[a]:self.ends[b - 1]] if b > a else b""


def words_of(texts: list[bytes], table: bytes = SPACED) -> Words:
    """Words of texts after translation by ``table``, which must map white space to space."""
    raw = b" ".join(texts).translate(table)
    letters = np.frombuffer(raw, np.uint8) != 32
    before = np.concatenate(([False], letters[:-1])) if len(letters) else letters
    word_at = np.flatnonzero(letters & ~before)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_at = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(texts) else sizes
    owner = np.searchsorted(text_at, word_at, "right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(texts) else counts
    # Keep letters and the first space behind a word.
    keep = letters | before
    data = raw if keep.all() else np.frombuffer(raw, np.uint8)[keep].tobytes()
    letters = np.frombuffer(data, np.uint8) != 32
    edges = np.diff(np.concatenate(([0], letters.view(np.int8), [0])))
    return Words(
        data, np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), owner, first, counts)
