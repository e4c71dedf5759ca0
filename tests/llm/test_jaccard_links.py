"""The number of links of every document, in branches of every size."""

from __future__ import annotations

import random

from tests.llm import brute
from tidecast.llm import jaccard_join


def degrees(docs, k, num, den):
    """[(doc_id, n_links)] by comparing all pairs."""
    sets = []
    for _, text in docs:
        w = brute.WORDS.findall(brute.lower(text))
        sets.append({tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    return [(d, sum(i != j and bool(a) and den * (n := len(a & b)) >= num * (len(a) + len(b) - n)
                    for j, b in enumerate(sets))) for i, ((d, _), a) in enumerate(zip(docs, sets))]


def family(rng, name, size, edits):
    out = []
    for _ in range(size):
        words = [f"{name}{i}" for i in range(90)]
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(words))
    return out


def test_every_link_is_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 32)
    rng = random.Random(7)
    texts = family(rng, "w", 150, 4) + family(rng, "v", 12, 4) + family(rng, "u", 40, 3)
    texts += [texts[0]] * 3 + [texts[155]] * 2 + ["", None, "one", "one", " ".join(f"z{i}" for i in range(50))]
    docs = list(enumerate(texts))
    twice = spark.createDataFrame([*docs, docs[3]], "doc_id long, text string")
    got = {tuple(r) for r in jaccard_join.jaccard_links(twice, 4, 85, 100).collect()}
    want = degrees(docs, 4, 85, 100)
    parts = brute.near(docs, 4, 85, 100)
    assert got == {(*part, n) for part, (_, n) in zip(parts, want)}
    assert max(n for _, n in want) > jaccard_join.FEW
