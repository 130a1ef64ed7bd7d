import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, score int"


def brute(rows, k, single=np.float32):
    good = [(i, [math.floor(256 * Fraction(float(single(x)))) for x in v]) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50:
            continue
        found = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, max(-2**63, min(2**63 - 1, -s))) for r, (s, i) in enumerate(found)]
    return sorted(out)


def vectors(n, size, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) * rng.gamma(spread, size=(n, 1)) * (np.arange(size, 0, -1) / size)
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    rows += [(i, rows[7][1], 0) for i in range(n, n + 60)]  # one very common vector
    return rows + [
        (5000, None, 0), (5050, [None] + [1.0] * (size - 1), 0), (5100, [math.inf] * size, 0),
        (5150, [math.nan] * size, 0), (5200, [], 0), (5250, [1.0], 0), (None, [1.0] * size, 0),
        (5300, [0.0] * size, 0), (50, rows[50][1], 0), (5400, [-1.0] * size, 1),
    ]


@pytest.mark.parametrize("head,rows,block", [(16, 40, 4), (2048, 8192, 1024)])
@pytest.mark.parametrize("spread", [0.5, 50.0])
def test_equals_brute_force(frame, monkeypatch, head, rows, block, spread):
    monkeypatch.setattr(topk, "HEAD", head)
    monkeypatch.setattr(topk, "RANGE_ROWS", rows)
    monkeypatch.setattr(topk, "QUERY_ROWS", block)
    data = vectors(400, 12, 3, spread)
    got = topk.top_k(frame(data, SCHEMA), "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == brute(data, 5)


@pytest.mark.parametrize("blocks", [(64, 4096), (2, 5)])
def test_large_components_and_several_dimensions(frame, monkeypatch, blocks):
    monkeypatch.setattr(topk, "LONG_QUERIES", blocks[0])
    monkeypatch.setattr(topk, "LONG_ROWS", blocks[1])
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        v = rng.normal(size=(3, 8)[i % 2]) * 10.0 ** rng.choice((0, 2, 6, 7, 9, 15, 30))
        rows.append((5 * i, [float(x) for x in v], 0))
    rows += [(3000, [2.0**20, 0.0, 1.0], 0), (3001, [2.0**20, 1.0, 0.0], 0), (3050, [3e38] * 3, 0),
             (3051, [-3e38] * 3, 0), (3051, [-3e38] * 3, 0), (3100, [1.0], 0), (3150, [2.0], 0), (3200, [1.0] * 5, 0)]
    near = float(2**20 - 1)  # 256 components just below the old limit
    rows += [(4000, [near] * 256, 0), (4001, [near] * 256, 0), (4002, [-near] * 256, 0), (4050, [1.0] * 256, 0)]
    query = F.col("vec_id") % 50 == 0
    got = topk.top_k(frame(rows, SCHEMA), "vec_id", "embedding", query).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)
    rows += [(0, [1e308, 1.0, -1e308], 0), (1, [1e307, 0.25, 1e308], 0)]
    wide = frame(rows, SCHEMA.replace("float", "double"))
    got = topk.top_k(wide, "vec_id", "embedding", query).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, float)


def test_few_rows_and_empty_tables(frame):
    query = F.col("vec_id") % 50 == 0
    two = [(0, [1.0, 2.0], 0), (1, [0.5, -1.0], 0)]
    got = topk.top_k(frame(two, SCHEMA), "vec_id", "embedding", query).collect()
    assert [tuple(r) for r in got] == brute(two, 5)
    assert topk.top_k(frame([], SCHEMA), "vec_id", "embedding", query).count() == 0
    assert topk.top_k(frame([(1, [1.0], 0)], SCHEMA), "vec_id", "embedding", query).count() == 0


def test_bounds_skip_work(monkeypatch):
    rng = np.random.default_rng(1)
    scale = np.exp(-np.arange(32) / 4) * 2000
    x = np.floor(rng.normal(size=(4000, 32)) * scale).astype(np.int64)
    turn = np.linalg.svd(x.astype(float), full_matrices=False)[2].T
    scored = []
    real = np.einsum
    monkeypatch.setattr(topk.np, "einsum", lambda e, a, b: scored.append(len(a)) or real(e, a, b))
    best = topk.Best(40, 5, np.full(40, topk.EMPTY_SCORE))
    topk.search(topk.Block(x[:40], turn), np.arange(40), topk.Block(x, turn), np.arange(4000), best)
    exact = x[:40] @ x.T
    exact[np.arange(40), np.arange(40)] = topk.EMPTY_SCORE
    assert (np.sort(exact, axis=1)[:, ::-1][:, :5] == best.scores).all()
    assert sum(scored) < 0.6 * 40 * 4000
