"""Linear-chain conditional random field with two labels and binary features.

A chain's score is the sum of its ones' features and of the transitions between
neighbours, with states before the first and behind the last item. Training maximises
the likelihood of labelled chains by AdaGrad with forward-backward marginals; decoding is
Viterbi's. Ties go to label 0.
"""

from __future__ import annotations

import random

import numpy as np

RATE, DECAY, EPOCHS = 0.3, 1e-5, 12
Model = dict[str, float]
# Names of the transition weights, from label to label; b and e are the chain's ends.
STEPS = ("b0", "b1", "00", "01", "10", "11", "0e", "1e")


def train(chains: list[tuple[list[list[str]], list[int]]], seed: int = 1) -> Model:
    """Weights from (features of each item, label of each item)."""
    names: dict[str, int] = {}
    packed = []
    for items, labels in chains:
        if items:
            rows = [np.array(sorted({names.setdefault(f, len(names)) for f in item}), np.int64)
                    for item in items]
            packed.append((rows, np.array(labels)))
    weights, squares = np.zeros(len(names)), np.full(len(names), 1e-6)
    steps, step_squares = np.zeros(8), np.full(8, 1e-6)
    order = list(range(len(packed)))
    for _ in range(EPOCHS):
        random.Random(seed).shuffle(order)
        for c in order:
            rows, labels = packed[c]
            lengths = np.array([len(r) for r in rows])
            flat = np.concatenate(rows)
            owner = np.repeat(np.arange(len(rows)), lengths)
            scores = np.bincount(owner, weights[flat], len(rows))
            ones, pairs = marginals(scores, steps)
            truth = np.zeros(8)
            truth[labels[0]] += 1
            truth[6 + labels[-1]] += 1
            for a, b in zip(labels, labels[1:]):
                truth[2 + 2 * a + b] += 1
            found = np.unique(flat)
            slope = np.bincount(flat, (labels - ones)[owner], len(names))[found]
            slope -= DECAY * weights[found]
            squares[found] += slope * slope
            weights[found] += RATE * slope / np.sqrt(squares[found])
            change = truth - pairs
            step_squares += change * change
            steps += RATE * change / np.sqrt(step_squares)
    model = {name: float(weights[i]) for name, i in names.items() if weights[i]}
    return model | {f"step:{n}": float(w) for n, w in zip(STEPS, steps)}


def marginals(scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 for each item, and expected number of each transition."""
    n = len(scores)
    among = np.exp(steps[2:6].reshape(2, 2))
    emit = np.stack([np.zeros(n), scores], axis=1)
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = np.exp(steps[:2]) * emit[0]
    ahead[0] /= ahead[0].sum()
    for i in range(1, n):
        ahead[i] = (ahead[i - 1] @ among) * emit[i]
        ahead[i] /= ahead[i].sum()
    behind[-1] = np.exp(steps[6:])
    behind[-1] /= behind[-1].sum()
    for i in range(n - 2, -1, -1):
        behind[i] = among @ (behind[i + 1] * emit[i + 1])
        behind[i] /= behind[i].sum()
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    moves = ahead[:-1, :, None] * among[None] * (behind[1:] * emit[1:])[:, None, :]
    moves /= moves.sum(axis=(1, 2), keepdims=True)
    expected = np.concatenate((both[0], moves.sum(axis=0).reshape(-1), both[-1]))
    return both[:, 1], expected


def decode(scores: list[float], model: Model) -> list[int]:
    """The best labels for the summed feature weights of each item."""
    if not scores:
        return []
    first0, first1, t00, t01, t10, t11, last0, last1 = (model.get(f"step:{n}", 0.0) for n in STEPS)
    zero, one = first0, first1 + scores[0]
    came: list[tuple[int, int]] = []
    for score in scores[1:]:
        a, b = zero + t00, one + t10
        c, d = zero + t01, one + t11
        came.append((int(b > a), int(d > c)))
        zero, one = max(a, b), max(c, d) + score
    label = int(one + last1 > zero + last0)
    out = [label]
    for back in reversed(came):
        label = back[label]
        out.append(label)
    return out[::-1]
