import hashlib
import random
import re
import zlib

import pytest

from tests.conftest import plan_text
from wardflow.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gone string, phase int"
SHAPE = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        fate = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) over all ways to edit; rows are (role, text, fault)."""
    best = None

    def go(i, cost, audit, initials, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            ends = [(cost, audit, initials, lines)]
            for names in (["user"], ["assistant"], ["user", "assistant"]):
                ends.append((cost + 5 * len(names), audit + "I" * len(names),
                             initials + "".join(n[0] for n in names), lines + [n + ":" for n in names]))
            for c, a, s, ls in ends:
                if SHAPE.fullmatch(s) and (best is None or (c, a) < best[:2]):
                    best = (c, a, ls)
            return
        role, text, fault = rows[i]
        for names in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
            base = (cost + 5 * len(names), audit + "I" * len(names),
                    initials + "".join(n[0] for n in names), lines + [n + ":" for n in names])
            go(i + 1, base[0] + 2, base[1] + "D", base[2], base[3])
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            go(i + 1, base[0] + more, base[1] + "K", base[2] + (role[:1] or "?"), base[3] + [f"{role}:{text}"])
            for name in ("user", "assistant"):
                go(i + 1, base[0] + 1 + more, base[1] + "R", base[2] + name[0], base[3] + [f"{name}:{text}"])

    go(0, 0, "", "", [])
    return best


def order(row):
    role, text = row[2:]
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (row[1] is not None, row[1] or 0, role, digest)


def brute(rows, damaged=None):
    damaged = brute_damage(rows) if damaged is None else damaged
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv), key=order)
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        out.append((conv, min(gaps, 2**63 - 1), *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, out))


def conversations(seed, n=260):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "a. b", " ", "", None, "é?\t\n", "x .\x1c", "line.\nnext", "\x0b\r", "ok. "]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "Sys", "unknown"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 6)):
            odd = rng.choice((None, turn + 3, 0)) if rng.random() < 0.05 else turn
            rows.append((conv, odd, rng.choice(roles), rng.choice(texts), "x", 7))
    return rows + [(None, 3, "user", "Null.", None, None), (None, None, "assistant", "Null!", None, None),
                   (900, -2**63, "user", "Far.", "", 0), (900, 2**63 - 1, "assistant", "Away.", "", 0)]


@pytest.mark.parametrize("chunk", [1 << 20, 2])
def test_report_equals_brute_force(frame, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = conversations(chunk)
    damaged = repair.damage(frame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    assert sorted(str(tuple(r)[:4]) for r in damaged.where("not gone").collect()) == sorted(map(str, brute_damage(rows)))
    got = repair.repair_report(damaged).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_turns_are_those_of_the_report(frame):
    rows = conversations(5, 60)
    damaged = repair.damage(frame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    report = {r.conv: r for r in repair.repair_report(damaged).collect()}
    turns = {}
    for r in repair.repaired_turns(damaged).collect():
        turns.setdefault(r.conv, []).append(r)
    for conv, r in report.items():
        mine = sorted(turns.get(conv, []), key=lambda t: t.place)
        assert "".join(t.edit for t in mine) == r.audit
        lines = "\n".join(f"{t.role}:{t.text}" for t in mine if t.role is not None)
        assert hashlib.sha256(lines.encode()).hexdigest() == r.repaired_sha256


def test_a_giant_conversation_spills_and_streams(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 1000)
    n = 25_000
    df = spark.range(n).selectExpr(
        "7L as conv", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
        "concat('text ', id, if(id % 5000 = 77, '', '.')) as text", "false as gone")
    row = repair.repair_report(df).first()
    # Of a truncated turn and a neighbour both go: 4, against 5 for keeping it.
    assert (row.conv, row.gaps, row.truncated, row.illegal, row.cost) == (7, 0, 5, 0, 20)
    assert len(row.audit) == n and row.audit.count("D") == 10
    kept = [i for i in range(n) if row.audit[i] == "K"]
    lines = "\n".join(f"{('user', 'assistant')[i % 2]}:text {i}." for i in kept)
    assert hashlib.sha256(lines.encode()).hexdigest() == row.repaired_sha256


def test_rows_without_gone_text_or_conversation(frame):
    none = hashlib.sha256(b"").hexdigest()
    schema = "conv bigint, turn bigint, role string, text string, gone boolean"
    only = frame([(4, 1, "user", "x.", True), (5, 1, None, None, None)], schema)
    got = sorted(tuple(r) for r in repair.repair_report(only).collect())
    assert got == [(4, 0, 0, 0, 0, 0, 0, "", none), (5, 0, 1, 0, 0, 0, 2, "D", none)]
    assert repair.repair_report(frame([], schema)).count() == 0
    assert repair.repaired_turns(frame([], schema)).count() == 0


def test_rows_are_dealt_out_once(frame):
    damaged = repair.damage(frame(conversations(1, 5), SCHEMA), "conv_id", "turn", "role", "text")
    assert plan_text(repair.repair_report(damaged), "simple").count("Exchange") == 1
