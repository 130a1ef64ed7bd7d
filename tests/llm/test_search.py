import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from wardflow.llm import search

SCHEMA = "doc_id bigint, text string, item int, score string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t, *_ in docs]
    bags = [(i, b) for i, b in bags if b]
    number, length = len(bags), sum(sum(b.values()) for _, b in bags)
    holding = Counter(t for _, b in bags for t in b)
    out = []
    for item, text, *_ in items:
        asked = set(terms(text))
        found = []
        for i, bag in bags:
            m = 50 + (50 * sum(bag.values()) * number) // length
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * holding[t] + 1)))
                * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in asked if t in bag)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(map(str, out))


def tables(seed, n=300, vocabulary=60):
    rng = random.Random(seed)
    words = [rng.choice(("w", "É", "漢", "9x")) + str(i) for i in range(vocabulary)]
    share = [1 / (i + 1) for i in range(vocabulary)]
    def text(k):
        return rng.choice((" ", ", ", "\x00\n", "-")).join(rng.choices(words, share, k=k))
    docs = [(i * 7 % 1000, text(rng.randrange(0, 40)), 0, "s") for i in range(n)]
    docs += [docs[3], docs[3], (None, docs[4][1], None, None), (5000, None, None, None), (5001, " .,-", 1, ""),
             (5002, "W1 w1 " * 3000, 0, ""), (5003, docs[9][1], 0, "")]
    docs += [(6000 + i, "one very common passage w1 w2 É3", 0, "") for i in range(80)]
    items = [(i, text(rng.randrange(1, 9)), 0, "") for i in range(30)]
    items += [items[2], (None, "w1 w2", 0, ""), (90, None, 0, ""), (91, "", 0, ""), (92, "absent", 0, ""),
              (93, "Common PASSAGE. w7 w7 w7", None, None)]
    return docs, items


@pytest.mark.parametrize("block,few,seed,group", [(2048, 4, 8192, 1024), (16, 1, 0, 1024), (40, 2, 60, 7)])
def test_equals_brute_force(frame, monkeypatch, block, few, seed, group):
    for name, value in (("BLOCK", block), ("FEW", few), ("SEED", seed), ("ITEMS", group)):
        monkeypatch.setattr(search, name, value)
    docs, items = tables(block)
    got = search.ranked(
        frame(docs, SCHEMA).repartition(3), "doc_id", "text", frame(items, SCHEMA), "doc_id", "text", 10)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, items, 10)


def test_empty_tables(frame):
    docs, items = tables(2, 20)
    none = frame([], SCHEMA)
    for d, i in ((none, frame(items, SCHEMA)), (frame(docs, SCHEMA), none), (none, none)):
        assert search.ranked(d, "doc_id", "text", i, "doc_id", "text").count() == 0


def test_bounds_hold_for_every_node_and_skip_work(monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary, n = 300, 1500
    weights = np.sort(rng.integers(1, 9000, vocabulary))
    items = search.Items(
        list(range(20)), [rng.choice(vocabulary, 8, replace=False).tolist() for _ in range(20)], weights)
    rows = [np.unique(np.minimum(rng.geometric(0.02, 30) - 1, vocabulary - 1)) for _ in range(n)]
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    tree = search.Tree(np.arange(n), rng.integers(50, 200, n), ends, np.concatenate(rows), rng.integers(1, 4, ends[-1]))
    scores = np.array([tree.bounds(i, i + 1, items) for i in range(n)])

    def check(lo, hi):
        assert (scores[lo:hi].max(axis=0) <= tree.bounds(lo, hi, items)).all()
        parts = tree.children(lo, hi) if hi - lo > 1 else []
        assert not parts or (parts[0][0], parts[-1][1]) == (lo, hi)
        for child in parts:
            check(*child)

    check(0, n)
    opened = []
    real = search.Tree.bounds
    monkeypatch.setattr(search.Tree, "bounds", lambda t, lo, hi, i: opened.append(hi - lo) or real(t, lo, hi, i))
    best = search.Best(5, np.zeros(20))
    tree.search(items, best)
    assert opened.count(1) < 0.85 * n
    for i, heap in enumerate(best.heaps):
        expected = sorted((-s, d) for s, d in zip(scores[:, i], tree.ids) if s > 0)[:5]
        assert sorted((-s, -d) for s, d in heap) == expected


def test_m_of_very_long_documents_in_very_large_tables():
    n = np.array([0, 1, 10**6, 10**8])
    for documents, length in ((3, 10**9), (10**12, 3 * 10**14)):
        expected = [50 + 50 * int(x) * documents // length for x in n]
        assert search.lengths_to_m(n, documents, length).tolist() == expected
    assert search.lengths_to_m(n[:0], 10**12, 1).tolist() == []
