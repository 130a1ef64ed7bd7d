"""Tree concatenation of byte-pair encodings.

A long unsplit text is halved down to leaves, the leaves are encoded side by side, and
the encodings of two neighbours are joined by encoding a window around the seam
anew: the last k tokens of the left side and the first k of the right. When the
window's first token is the left side's and its last token the right side's, both
sides agree and the window replaces them; otherwise k doubles.

This is exact: a row of tokens is the encoding of its text if every two adjacent
tokens are the encoding of theirs. Adjacent pairs outside the window come from an
encoding, those inside too, and the pairs at the window's ends are unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

LONG = 256
LEAF = 128
WORKERS = 2

Token = tuple[int, str]
Encode = Callable[[str], list[Token]]


def join(left: list[Token], right: list[Token], encode: Encode) -> list[Token]:
    """Encoding of two adjacent parts from theirs, as (id, symbols)."""
    k = 1
    while True:
        a, b = max(0, len(left) - k), min(k, len(right))
        window = encode("".join(s for _, s in left[a:]) + "".join(s for _, s in right[:b]))
        agrees_left = a == 0 or window[0] == left[a]
        agrees_right = b == len(right) or window[-1] == right[b - 1]
        if agrees_left and agrees_right:
            return left[:a] + window + right[b:]
        k *= 2


def encode_long(symbols: str, encode: Encode, leaf: int = LEAF) -> list[Token]:
    """Encoding of a long piece; ``encode`` takes a short one. An empty piece has no tokens."""
    if not symbols:
        return []
    leaves = [symbols[i:i + leaf] for i in range(0, len(symbols), leaf)]
    with ThreadPoolExecutor(WORKERS) as pool:
        level = list(pool.map(encode, leaves))
        while len(level) > 1:
            pairs = [level[i:i + 2] for i in range(0, len(level), 2)]
            level = list(pool.map(lambda p: join(*p, encode) if len(p) == 2 else p[0], pairs))
    return level[0]
