import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from wardflow.llm import simhash, words
from wardflow.llm.components import components

SCHEMA = "doc_id bigint, text string, mark string, F0 int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, width=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(pairs, linked):
    """pairs: (id, value); smallest id reachable over links of values."""
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if linked(pairs[i][1], pairs[j][1]):
                parent[root(i)] = root(j)
    least = {}
    for i, (number, _) in enumerate(pairs):
        if number is not None:
            least[root(i)] = min(least.get(root(i), number), number)
    return [least.get(root(i)) for i in range(len(pairs))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c aBé漢'", max_size=60), max_size=6))
def test_fingerprints_equal_brute_force(texts):
    got = simhash.fingerprints([t.encode() for t in texts], 3)
    assert got.tolist() == [brute_print(t) for t in texts]


def test_hash_of_all_lengths():
    data = bytes(random.Random(1).randbytes(400))
    lengths = np.arange(0, 200)
    starts = np.full(200, 7)
    expected = [xxhash.xxh64_intdigest(data[7:7 + n], 42) for n in lengths]
    assert words.xxh64_spans(data, starts, lengths).tolist() == expected


def varied(seed, n=150):
    rng = random.Random(seed)
    known = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(known, k=rng.choice((2, 8, 60, 90)))) for _ in range(12)]
    rows = [(1, None, "m", 1), (2, "", "m", 1), (None, "solo", "m", 1), (None, base[0], "m", 1)]
    for i in range(n):
        parts = rng.choice(base).split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            parts[rng.randrange(len(parts))] = rng.choice(known)
        rows.append((10 + i, " ".join(parts), "m", 1))
    return rows + rows[5:8] + [(500, "x " * 60_000, None, None)]


@pytest.mark.parametrize("block", [8, 2048])
def test_groups_equal_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = varied(3)
    got = simhash.near_groups(frame(rows, SCHEMA), "doc_id", "text").collect()
    prints = [(r[0], brute_print(r[1])) for r in rows]
    expected = brute_groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(str((r.id, r.f0 % 2**64, r.component)) for r in got) == sorted(
        str((i, p, c)) for (i, p), c in zip(prints, expected))


def test_links_in_units_of_several_rows_and_tiles(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = np.random.default_rng(5)
    prints = (rng.integers(0, 2, 60).astype(np.uint64) * np.uint64(2**40)
              ^ (np.uint64(1) << rng.integers(0, 12, 60).astype(np.uint64)))
    for same in (True, False):
        links = simhash.Links(60)
        left, right = (np.arange(60),) * 2 if same else (np.arange(30), np.arange(30, 60))
        simhash.compare(prints, left, right, same, 1, links)
        pairs = [(int(i), int(j)) for i in left for j in right
                 if (not same or i < j) and int(prints[i] ^ prints[j]).bit_count() <= 1]
        assert all((i, j) in pairs or (j, i) in pairs for i, j in links.edges)
        root = list(range(60))
        for i, j in pairs:
            root = [root[i] if r == root[j] else r for r in root]
        label = links.label
        for i in range(60):
            for j in range(60):
                assert (label[i] == label[j]) == (root[i] == root[j])


def within_two(a, b):
    return (a ^ b).bit_count() <= 2


def test_near_dedup_keeps_the_smallest_id_of_each_group(frame):
    rows = [r for r in varied(9) if r[0] is not None]
    rows += [(900, "", "m", 0), (901, " \n", "m", 0)]
    groups = brute_groups([(r[0], brute_print(r[1])) for r in rows], within_two)
    expected = sorted(str(r) for r, g in zip(rows, groups) if r[0] == g)
    kept = simhash.near_dedup(frame(rows, SCHEMA), "doc_id", "text")
    assert kept.columns == ["doc_id", "text", "mark", "F0"]
    assert sorted(str(tuple(r)) for r in kept.collect()) == expected
    assert 20 < len(expected) < len(rows) - 20


def test_near_dedup_of_rows_without_id_and_of_repeated_rows(frame):
    rows = [(None, "a b c d", "m", 0), (3, "a b c d", "m", 0), (3, "a b c d", "n", 1), (5, "a b c d", "m", 0)]
    kept = simhash.near_dedup(frame(rows, SCHEMA), "doc_id", "text").collect()
    assert sorted(str(tuple(r)) for r in kept) == sorted(map(str, rows[:3]))


def test_empty_table(frame):
    assert simhash.near_groups(frame([], SCHEMA), "doc_id", "text").count() == 0
    assert simhash.near_dedup(frame([], SCHEMA), "doc_id", "text").count() == 0


def test_components_of_chains_and_stars(spark, frame):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500 + i, 499) for i in range(50)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    links = chain + star + loose + [(7, 7), (None, 3), (100, 101)]
    rng.shuffle(links)
    got = dict(map(tuple, components(frame(links, "a bigint, b bigint"), "a", "b").collect()))
    label = {x: x for e in links for x in e if x is not None}
    for _ in range(len(label)):
        changed = False
        for a, b in links:
            if a is None or b is None or label[a] == label[b]:
                continue
            label[a] = label[b] = min(label[a], label[b])
            changed = True
        if not changed:
            break
    linked = {x for a, b in links if a != b and a is not None for x in (a, b)}
    assert got == {x: label[x] for x in linked}
