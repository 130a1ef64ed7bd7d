"""Secret scans: all rules in one combined deterministic automaton.

The rules, reversed, are compiled into one automaton that may begin anywhere. One
pass over the bytes, from last to first, marks every place where a match of any
rule may start. From the leftmost such place of a kind that rule's own automaton is
read forwards for the longest match, if there is one; the next place considered is
the first one behind it. That gives leftmost, non-overlapping matches of each kind; matches that fail
the rule's test are then dropped.

For these rules the longest match is the greedy one: each has a single way to
match from a given start, up to the end of its closing run; only ``private_key`` has
two, of which the longer one is meant. For runs with a least
length (``hex``, ``access``) the length stands in the pattern, since a run that is
too short holds no longer one; ``assign`` is tested afterwards, because a match that
fails still covers its text.

Defined results: null text is empty and has no spans. Spans count code points, end
exclusive, and are ordered by start, then by kind as listed. Repeated rows give
repeated results, an empty table an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.automaton import compile_rules, run
from wardflow.llm.common import pieces, ship, unused

# Kinds and patterns.
BASE_RULES = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""),
    ("access", r"AKIA[A-Z0-9]{12,}"),
    ("hex", r"[0-9a-f]{32,}"),
)
# The header and what is behind it: up to the END line when that is there, else as far as
# header fields and runs of a key's characters go, the last line with them. Line breaks
# may be written as in a JSON text.
BREAK = r"([ \t\r\n]|\\[rnt])"
PRIVATE_KEY = (
    r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----("
    r"(-{0,4}[A-Za-z0-9+/=:, \t\r\n\\])*-----END ([A-Z]+ )*PRIVATE KEY-----"
    rf"|({BREAK}*((Proc-Type|DEK-Info): [A-Za-z0-9,-]+|[A-Za-z0-9+/=]{{16,}}))+({BREAK}+[A-Za-z0-9+/=]{{1,15}})?"
    r")?"
)
MORE_RULES = (
    ("private_key", PRIVATE_KEY),
    ("host_token", r"(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("service_key", r"(sk|rk)_live_[A-Za-z0-9]{16,}"),
    ("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES
KINDS = [kind for kind, _ in RULES]
BASE_KINDS = [kind for kind, _ in BASE_RULES]
MIN_ASSIGNED = 8


@cache
def automata():
    return compile_rules([pattern for _, pattern in RULES])


def long_enough(match: bytes) -> bool:
    """An assignment's value has at least ``MIN_ASSIGNED`` characters."""
    mark = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[mark + 1:].lstrip(b" ")
    if value[:1] in (b'"', b"'"):
        value = value[1:]
    return len(value) >= MIN_ASSIGNED


def find_spans(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind number, end) in bytes of each text, ordered."""
    backward, forward = automata()
    # A byte that no rule takes parts the texts, so no match crosses.
    joined = b"\x00".join(texts)
    reverse = np.frombuffer(joined, np.uint8)[::-1]
    accepted = backward.accepts[run(backward, reverse)][::-1]
    places = np.flatnonzero(accepted)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_at = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    owner = np.searchsorted(text_at, places, "right") - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for kind, name in enumerate(KINDS):
        behind = 0
        chosen = (accepted[places] >> kind & 1).astype(bool)
        for at, text in zip(places[chosen].tolist(), owner[chosen].tolist()):
            if at < behind:
                continue
            end = forward[kind].longest(joined, at)
            if end <= at:
                continue
            behind = end
            if name != "assign" or long_enough(joined[at:behind]):
                base = int(text_at[text])
                found[text].append((at - base, kind, behind - base))
    return [sorted(spans) for spans in found]


def to_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans counted in code points."""
    if text.isascii() or not spans:
        return spans
    data = np.frombuffer(text, np.uint8)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(before[a]), kind, int(before[b])) for a, kind, b in spans]


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            counts, base, every = [], [], []
            for text, spans in zip(texts, find_spans(texts)):
                spans = to_code_points(text, spans)
                first = [s for s in spans if s[1] < len(BASE_RULES)]
                counts.append([sum(s[1] == k for s in first) for k in range(len(BASE_RULES))])
                base.append(hashlib.sha256(span_text(first).encode()).hexdigest())
                every.append(span_text(spans))
            numbers = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.record_batch(
                [part.column("id"), *numbers, pa.array(base), pa.array(every)],
                names=["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"],
            )


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns id, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    return rows.mapInArrow(_scan, f"id bigint, {counts}, base_sha256 string, spans string")


def redact_text(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """Put the kind in place of each span; of overlapping spans the first one names it."""
    out, behind = [], 0
    for start, kind, end in spans:
        if start >= behind:
            out += [text[behind:start], f"[{KINDS[kind]}]".encode()]
        behind = max(behind, end)
    return b"".join(out) + text[behind:]


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.num_columns - 1
        for part in pieces(batch, batch.schema.names[at]):
            texts = part.column(at).cast(pa.binary()).to_pylist()
            spans = find_spans([t or b"" for t in texts])
            clean = [t if not s else redact_text(t, s) for t, s in zip(texts, spans)]
            text = pa.array(clean, pa.binary()).cast(pa.string())
            yield pa.record_batch([*part.columns[:at], text], names=part.schema.names)


def redact(df: DataFrame, text_col: str, length_col: str | None = None) -> DataFrame:
    """The rows of ``df`` with secrets replaced; ``length_col`` counts the new text.

    Rows without a secret, null texts among them, are unchanged.
    """
    ship(df.sparkSession)
    text = unused(df, "_clean")
    rows = df.withColumn(text, F.col(text_col))
    clean = rows.mapInArrow(_redact, rows.schema)
    changed = ~F.col(text).eqNullSafe(F.col(text_col))
    columns = []
    for name in df.columns:
        value = F.col(name)
        if name == text_col:
            value = F.col(text)
        elif name == length_col:
            size = F.length(text).cast(df.schema[name].dataType)
            value = F.when(changed, size).otherwise(F.col(name))
        columns.append(value.alias(name))
    return clean.select(*columns)
