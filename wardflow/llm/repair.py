"""Repair of conversation structure by secondary-sorted streaming.

A repaired conversation alternates user and assistant turns, from a user's turn to an
assistant's, behind at most one system turn, or is empty. Edits are Keep, Rerole (to user
or assistant), Delete and Insert (an empty turn of user or assistant); the cheapest ones
are chosen, of equally cheap ones those whose initials, in order, are least in ASCII.

Rows are dealt out by conversation and sorted within their task by Spark, which spills:

1. By conversation and content, where a row number tells repeated turns from first ones.
2. By conversation, phase and turn. Every row goes twice: first as a code (kind of
   role and fault, no text), then with its text. So the stream has seen all codes of a
   conversation before its first text, and no text is ever held.

Codes are one byte a row. Behind the last one a pass from the end to the start replaces
each by its backpointers, two bits for each of the four states that a repaired prefix can
be in; the texts then walk through them. Codes and backpointers of a conversation are
kept in memory up to ``CHUNK`` rows; those of a giant one are spilled, like a sort's, to
an unnamed file that only its task sees and that ends with it. State is carried from
batch to batch, so a conversation may span any number of them.

Going backwards, costs to the end differ between the states by a few units only, so that
(differences, code) has few values; each is worked out once and remembered.

Defined results: null roles and texts are one space. A null conversation is a
conversation, a null turn comes before all others. Rows of one turn are ordered by role and
SHA-256 of their content. Equal turns after the first, wherever they are, are duplicates.
Gaps beyond 64 bits are the largest number of 64 bits. Extra columns are not looked at;
an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import ship

CHUNK = 1 << 20

# States of a repaired prefix: nothing yet, system turn, ends with user, ends with assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Kinds of a role, by its initial; faults of a row.
KINDS = "sua"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
ABSENT = 16
DELETE, INSERT, KEEP, REROLE = range(4)
INITIALS = b"DIKR"
# The state behind a new turn, and behind a kept one of each kind.
ALTERNATE = (USER, USER, ASSISTANT, USER)
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None),
        (None, USER, None, None))
NAMES = {USER: "user", ASSISTANT: "assistant"}
AT_END = (0, 10, 5, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}
LARGEST = (1 << 63) - 1

SPACE = r"\x20\x09-\x0D"


def space_if_null(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows conv, turn, role, text, gone with faults put in by a checksum of conversation and turn.

    Of twenty rows one is gone, one loses its text, one its closing marks, one is there
    twice, and one becomes the user's.
    """
    fate = F.crc32(F.concat_ws(":", space_if_null(conv), space_if_null(turn)).cast("binary")) % 20
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), space_if_null(role).alias("role"),
        space_if_null(text).alias("text"), fate.alias("fate"),
    )
    number = F.when(F.col("fate") == 3, 2).otherwise(1)
    return rows.select(
        "conv", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("fate") == 0).alias("gone"), F.explode(F.sequence(F.lit(1), number)).alias("copy"),
    ).drop("copy")


class Ledger:
    """One byte per row, read and rewritten in chunks; all but a chunk of it may be on disk."""

    def __init__(self):
        self.tail = bytearray()
        self.file = None
        self.chunks = 0

    def add(self, byte: int) -> None:
        self.tail.append(byte)
        if len(self.tail) >= CHUNK:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.chunks += 1
            self.tail = bytearray()

    def rewrite(self, change) -> None:
        """Replace chunks by what ``change`` makes of them, the last one first."""
        self.tail = change(self.tail)
        for i in range(self.chunks - 1, -1, -1):
            self.file.seek(i * CHUNK)
            new = change(self.file.read(CHUNK))
            self.file.seek(i * CHUNK)
            self.file.write(new)

    def read(self) -> Iterator[int]:
        if self.file is not None:
            self.file.seek(0)
            for _ in range(self.chunks):
                yield from self.file.read(CHUNK)
            self.file.close()
        yield from self.tail


def step(costs: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, int]:
    """Costs from before a row to the end, given those behind it.

    Returns their differences to the least, the least, and the backpointers.
    """
    kind, fault = code & 3, code >> 2
    more = 5 if fault == TRUNCATED else 0
    deletable_only = fault in (BLANK, DUPLICATE)
    ways = []
    for state in STATES:
        here = {DELETE: 2 + costs[state]}
        if not deletable_only:
            here[REROLE] = 1 + more + costs[ALTERNATE[state]]
            if KEPT[state][kind] is not None:
                here[KEEP] = more + costs[KEPT[state][kind]]
        ways.append(here)
    plain = [min(w.values()) for w in ways]
    # More than two turns are never inserted in one place.
    best = [
        min(plain[s], 5 + plain[ALTERNATE[s]], 10 + plain[ALTERNATE[ALTERNATE[s]]])
        for s in STATES
    ]
    pointers = 0
    for state in STATES:
        ways[state][INSERT] = 5 + best[ALTERNATE[state]]
        edit = min(e for e, cost in ways[state].items() if cost == best[state])
        pointers |= edit << 2 * state
    least = min(best)
    return tuple(b - least for b in best), least, pointers


_steps: dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], int, int]] = {}


class Repair:
    """One conversation: all its codes, then all its texts."""

    def __init__(self, conv):
        self.conv = conv
        self.ledger = Ledger()
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.kind: int | None = None
        self.first = self.turn = None
        self.turns = 0
        self.solved = False
        self.audit = bytearray()
        self.sha = hashlib.sha256()
        self.cost = self.kept = 0
        self.state = NONE
        self.turns_out: list[tuple] | None = None

    def note(self, turn: str | None, code: int) -> None:
        """Take in the code of the next row."""
        if code == ABSENT:
            return
        kind = code & 3
        self.counts[code >> 2] += 1
        self.illegal += self.kind is not None and (self.kind, kind) not in LEGAL
        self.kind = kind
        if turn is not None:
            if self.first is None:
                self.first = int(turn)
            if turn != self.turn:
                self.turns += 1
                self.turn = turn
        self.ledger.add(code)

    def solve(self) -> None:
        """Turn codes into backpointers."""
        costs, total = AT_END, 0

        def change(codes: bytes) -> bytearray:
            nonlocal costs, total
            out = bytearray(len(codes))
            for i in range(len(codes) - 1, -1, -1):
                key = (costs, codes[i])
                found = _steps.get(key)
                if found is None:
                    found = _steps[key] = step(*key)
                costs, least, out[i] = found
                total += least
            return out

        self.ledger.rewrite(change)
        self.cost = total + costs[NONE]
        self.pointers = self.ledger.read()
        self.solved = True

    def put(self, edit: int, role: str | None, text: str | None) -> None:
        self.audit.append(INITIALS[edit])
        if role is not None:
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            self.sha.update(b"\n" + line if self.kept else line)
            self.kept += 1
        if self.turns_out is not None:
            self.turns_out.append((self.conv, len(self.audit), chr(INITIALS[edit]), role, text))

    def insert(self) -> None:
        self.state = ALTERNATE[self.state]
        self.put(INSERT, NAMES[self.state], "")

    def take(self, role: str, text: str) -> None:
        """Take in the text of the next row, in the order of its code."""
        if not self.solved:
            self.solve()
        pointers = next(self.pointers)
        while (edit := pointers >> 2 * self.state & 3) == INSERT:
            self.insert()
        if edit == DELETE:
            self.put(DELETE, None, None)
        elif edit == KEEP:
            kind = KINDS.find(role[0]) if role else -1
            self.state = KEPT[self.state][kind]
            self.put(KEEP, role, text)
        else:
            self.state = ALTERNATE[self.state]
            self.put(REROLE, NAMES[self.state], text)

    def finish(self) -> tuple:
        """The conversation's row of the report."""
        if not self.solved:
            self.solve()
        while self.state in (SYSTEM, USER):
            self.insert()
        gaps = 0 if self.first is None else min(LARGEST, int(self.turn) - self.first + 1 - self.turns)
        return (self.conv, gaps, *self.counts[1:], self.illegal, self.cost,
                self.audit.decode(), self.sha.hexdigest())


REPORT = {
    "conv": "string", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint",
    "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
    "repaired_sha256": "string",
}
TURNS = {"conv": "string", "place": "bigint", "edit": "string", "role": "string", "text": "string"}


def _frames(report: bool):
    names = list(REPORT if report else TURNS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: Repair | None = None
        for frame in frames:
            out: list[tuple] = []
            rows = zip(*(frame[c].tolist() for c in ("conv", "phase", "turn", "role", "code", "text")))
            for conv, phase, turn, role, code, text in rows:
                if now is None or conv != now.conv:
                    if now is not None:
                        row = now.finish()
                        if report:
                            out.append(row)
                    now = Repair(conv)
                    now.turns_out = None if report else out
                if phase == 0:
                    now.note(turn, code)
                else:
                    now.take(role, text)
            yield pd.DataFrame(out, columns=names)
            if now is not None and not report:
                now.turns_out = []
        if now is not None:
            row = now.finish()
            yield pd.DataFrame([row] if report else now.turns_out, columns=names)

    return run


def sorted_phases(df: DataFrame) -> DataFrame:
    """Codes and then texts of every conversation, in the order of turns."""
    there = ~F.col("gone")
    digest = F.unhex(F.sha2(F.concat(
        F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = df.withColumn("digest", F.when(there, digest)).repartition("conv")
    same = Window.partitionBy("conv", "digest").orderBy(F.col("turn").asc_nulls_first())
    kind = F.coalesce(
        F.nullif(F.instr(F.lit(KINDS), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    # An empty role is found everywhere, but it has no initial.
    kind = F.when(F.length("role") == 0, 3).otherwise(kind)
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK)
        .when(F.col("again") > 1, DUPLICATE)
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED)
        .otherwise(0)
    )
    code = F.when(there, kind + fault * 4).otherwise(ABSENT).cast("int")
    both = F.array(
        F.struct(F.lit(0).alias("phase"), F.lit(None).cast("string").alias("text")),
        F.struct(F.lit(1).alias("phase"), F.col("text").alias("text")),
    )
    return (
        rows.withColumn("again", F.row_number().over(same))
        .select("conv", "turn", "role", "digest", code.alias("code"),
                F.explode(F.when(there, both).otherwise(F.slice(both, 1, 1))).alias("p"))
        .select("conv", "p.phase", "turn", "role", "digest", "code", "p.text")
        .sortWithinPartitions(
            "conv", "phase", F.col("turn").asc_nulls_first(), "role", "digest", "code")
    )


def _stream(df: DataFrame, report: bool) -> DataFrame:
    ship(df.sparkSession)
    kind = df.schema["conv"].dataType
    rows = sorted_phases(df.select(
        "conv", F.col("turn").cast("bigint").alias("turn"), space_if_null("role").alias("role"),
        space_if_null("text").alias("text"), F.coalesce("gone", F.lit(False)).alias("gone")))
    # As texts, so that pandas keeps nulls and all digits.
    texts = rows.select(
        F.col("conv").cast("string").alias("conv"), "phase",
        F.col("turn").cast("string").alias("turn"), "role", "code", "text")
    columns = REPORT if report else TURNS
    schema = ", ".join(f"{n} {t}" for n, t in columns.items())
    return texts.mapInPandas(_frames(report), schema).withColumn("conv", F.col("conv").cast(kind))


def repair_report(df: DataFrame) -> DataFrame:
    """One row per conversation of ``df`` (conv, turn, role, text, gone).

    Rows that are gone only say that there is a conversation. gaps are the turns missing
    between the first and the last; blank, duplicate and truncated count each row's first
    fault, illegal the adjacent turns that may not follow one another; cost, audit and
    repaired_sha256 (of role:text lines) are of the repair.
    """
    return _stream(df, True)


def repaired_turns(df: DataFrame) -> DataFrame:
    """Every edit of every conversation: conv, place, edit, and role and text if it stays."""
    return _stream(df, False)
