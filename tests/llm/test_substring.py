import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from wardflow.llm import substring

SCHEMA = "doc_id bigint, text string, mark string, id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    texts = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    first = {}
    for i, words in texts:
        if i is None:
            continue
        for s in range(len(words) - 12):
            key = tuple(words[s:s + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for s in range(len(words) - 12):
            if i is not None and first[tuple(words[s:s + 13])] < i:
                gone.update(range(s, s + 13))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


def corpus(seed, vocabulary, n=70):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(vocabulary)]
    shared = [rng.choices(words, k=k) for k in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(n):
        parts = rng.choices(words, k=rng.randrange(0, 50))
        for passage in rng.sample(shared, rng.randrange(3)):
            cut = rng.randrange(0, 4)
            parts += passage[cut:] + rng.choices(words, k=rng.randrange(0, 6))
        rows.append((rng.randrange(10_000), rng.choice((" ", "\n\t", "  ")).join(parts), "m", 0))
    rows += [rows[3], (rows[5][0], rows[9][1], "m", 1), (None, rows[8][1], None, None), (-4, None, "", 0),
             (-5, "", "", 0), (20_000, rows[11][1], "", 0), (20_001, "a " * 3000, "", 0), (20_002, "a " * 20, "", 0)]
    return rows


@pytest.mark.parametrize("vocabulary", [3, 40, 4000])
@pytest.mark.parametrize("hot,limit,busy", [(2000, 10**6, 10), (2, 10**6, 10**5), (2, 10**6, 3), (2, 0, 50)])
def test_equals_brute_force(frame, monkeypatch, vocabulary, hot, limit, busy):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "BUSY", busy)
    monkeypatch.setattr(substring, "BROADCAST_ANCHORS", limit)
    rows = corpus(vocabulary, vocabulary)
    got = substring.remove_repeats(frame(rows, SCHEMA), "doc_id", "text", with_text=True).collect()
    assert sorted(str(tuple(r)[:4]) for r in got) == brute(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=12), min_size=1, max_size=4),
       st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14), st.integers(1, 4))
def test_automaton_covers_what_occurs(references, words, least):
    automaton = substring.SuffixAutomaton()
    for r in references:
        automaton.add(r)
    grams = {tuple(r[i:i + least]) for r in references for i in range(len(r) - least + 1)}
    expected = {j for i in range(len(words) - least + 1) if tuple(words[i:i + least]) in grams
                for j in range(i, i + least)}
    got = [set(range(a, b)) for a, b in automaton.covers(words, least)]
    assert set().union(*got) == expected and sum(map(len, got)) == len(expected)


def test_windows_the_references_do_not_know_are_told():
    """A window that only shares its hash with a busy one must go to a shard."""
    words = [b"w%d" % x for x in range(16)]
    passages = substring.passages_of([(5, 0, j, b" ".join(words[j:j + 13])) for j in range(4)])
    assert passages == [(5, b" ".join(words))]
    references = substring.References(np.zeros(0, np.int64), passages)
    assert references.covers(words + [b"no"] * 3, 9) == ([(0, 16)], [4, 5, 6])
    assert references.covers(words, 5) == ([], [])


def test_every_state_knows_its_document():
    rng = random.Random(3)
    passages = [(n, b" ".join(rng.choices([b"a", b"b"], k=30))) for n in range(6)]
    kept = []
    seen = set()
    for n, words in passages:  # every window once, by its first document
        parts = words.split(b" ")
        for j in range(len(parts) - 12):
            key = tuple(parts[j:j + 13])
            if key not in seen:
                kept.append((n, 0, j, b" ".join(key)))
            seen.add(key)
    first = {}
    for n, _, j, words in kept:
        first[words] = n
    references = substring.References(np.zeros(0, np.int64), substring.passages_of(kept))
    for words, n in first.items():
        parts = words.split(b" ")
        assert references.covers(parts, n + 1) == ([(0, 13)], [])
        assert references.covers(parts, n) == ([], [])


def test_empty_table(frame):
    assert substring.remove_repeats(frame([], SCHEMA), "doc_id", "text").count() == 0
