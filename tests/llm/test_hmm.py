"""The hidden Markov model against plain recursions and a planted model."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from tests.llm import brute
from tidecast.llm import hmm


def model(rng, states=3, classes=5):
    x = [rng.random(size) + 0.05 for size in (states, (states, states), (states, classes))]
    return hmm.Model(*[a / a.sum(-1, keepdims=True) for a in x])


def paths(m, seen):
    """Probability of each way through the states."""
    for way in itertools.product(range(len(m.start)), repeat=len(seen)):
        p = m.start[way[0]] * m.emit[way[0], seen[0]]
        for a, b, x in zip(way, way[1:], seen[1:]):
            p *= m.move[a, b] * m.emit[b, x]
        yield way, p


def texts(rng, classes=5):
    return [rng.integers(0, classes, n) for n in (4, 1, 6, 4, 2)]


def test_forward_sums_all_paths():
    rng = np.random.default_rng(1)
    m, arrays = model(rng), texts(rng)
    for group in hmm.groups(arrays, tokens=9):  # several groups
        got = hmm.forward(m, *hmm.padded(arrays, group), keep=False)[0]
        for k, score in zip(group, got):
            assert score == pytest.approx(math.log(sum(p for _, p in paths(m, arrays[k]))), abs=1e-10)


def test_expected_counts_are_those_of_all_paths():
    rng = np.random.default_rng(2)
    m, arrays = model(rng), texts(rng)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for seen in arrays:
        ways = list(paths(m, seen))
        total = sum(p for _, p in ways)
        for way, p in ways:
            start[way[0]] += p / total
            for a, b in zip(way, way[1:]):
                move[a, b] += p / total
            for s, x in zip(way, seen):
                emit[s, x] += p / total
    got = hmm.expected_counts(m, arrays)
    assert got == pytest.approx(np.concatenate([start, move.ravel(), emit.ravel()]), abs=1e-9)


def planted(rng, n):
    """Texts of three states that stay for a while; each has words of its own
    and some that all share."""
    words = [[f"{name}{i}" for i in range(30)] for name in "abc"]
    out = []
    for _ in range(n):
        state, text = rng.randrange(3), []
        for _ in range(rng.randrange(20, 60)):
            if rng.random() < 0.1:
                state = rng.randrange(3)
            text.append(f"s{rng.randrange(10)}" if rng.random() < 0.2 else rng.choice(words[state]))
        out.append(" ".join(text))
    return out


def test_states_are_learnt(spark):
    """Held-out texts score above the base that knows no states, and the
    score is the words' part plus the exact likelihood of the states'."""
    docs = list(enumerate(planted(random.Random(3), 700)))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in hmm.score_documents(rows, states=6, classes=128).collect()}
    want = brute.language(docs)
    held = [d for d, w in want.items() if w[0]]
    tokens = sum(want[d][1] for d in held)
    gain = sum(got[d]["score"] - got[d]["base_score"] for d in held) / tokens
    assert len(held) > 50 and gain > 0.1  # log10 a token; three equal states: 0.48 at most
    assert sum(got[d]["score"] > got[d]["base_score"] for d in held) > 0.9 * len(held)
    for d in held:
        assert got[d]["base_score"] == pytest.approx(want[d][4], rel=1e-9)


def test_untrained_states_score_like_the_classes(spark):
    docs = [(i, t) for i, t in enumerate(planted(random.Random(4), 40))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = hmm.score_documents(rows, states=1, classes=32, rounds=1).collect()
    assert all(r["score"] < 0 and r["state_score"] < 0 for r in got)
    mean = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert abs(mean) < 0.05  # one state: no more than smoothing apart
