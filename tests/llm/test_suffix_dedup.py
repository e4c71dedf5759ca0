"""Byte-exact deduplication against a plain count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidecast.llm import common, suffix_dedup
from tidecast.llm.queries import QUERIES


def plain(texts, span=200):
    """[(n_bytes, [(a, z)], kept)] by counting every window of every text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - span + 1):
            if count[d[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        spans, kept, at = [], bytearray(), 0
        while at < len(d):
            end = at
            while end < len(d) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append((at, end))
            else:
                kept += d[at:end]
            at = end
        out.append((len(d), spans, bytes(kept)))
    return out


def made(seed=1):
    """Copies, shared passages of every length around 200 bytes with different
    sides, overlaps, repeats inside a text, junk, texts around the limit."""
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefgh ijkl éü. ") for _ in range(n))

    base = prose(3000)
    texts = [None, "", "x", prose(199), base, base, base[:1500] + "#" + base[1500:], "z" * 1200, "ab" * 500,
             prose(50) + "z" * 200, "z" * 199, "line of some words\n" * 40, prose(300) * 3]
    for n in range(190, 215, 2):
        a = rng.randrange(2500)
        texts.append(prose(rng.randrange(300)) + base[a:a + n] + prose(rng.randrange(300)))
    for _ in range(30):  # families that share parts of each other
        a, b = sorted(rng.sample(range(3000), 2))
        w = list(base[a:b])
        for _ in range(rng.randrange(4)):
            if w:
                w[rng.randrange(len(w))] = rng.choice("#$%")
        texts.append(prose(rng.randrange(100)) + "".join(w) + prose(rng.randrange(100)))
    return texts


def result(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect())


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for extra in ("row", "place", "bucket", "n", "spans", "text_key", "packed"):
        docs = docs.withColumn(extra, F.lit(1))
    return docs.repartition(4)


@pytest.mark.parametrize("hot", [False, True])
def test_families(spark, monkeypatch, hot):
    texts = made()
    if hot:
        monkeypatch.setattr(common, "HOT_LEAST", 2)
    rows = [*enumerate(texts), (None, texts[4]), (None, None), (5, texts[5])]  # null ids and a repeated row
    want = plain([t for _, t in rows])
    got = result(suffix_dedup.remove_repeated_bytes(frame(spark, rows)))
    assert got == sorted((str(d), *w) for (d, _), w in zip(rows, want))


def test_long_text_in_slices(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("abcd") for _ in range(5000))
    text = text + text[100:900] + "y" * 700

    def rows_of(t):
        _, own, found = suffix_dedup._marks([t])
        windows = set()
        for _, _, place, _ in zip(*[x.tolist() for x in found[0]]):
            windows.update(range(place >> 17, (place >> 17) + (place >> 9 & 255)))
        for a, z in zip(*[x.tolist() for x in own[0]]):
            windows.update(range(a, z - 199))
        return windows

    assert rows_of(text) == set(range(len(text) - 199))
    monkeypatch.setattr(suffix_dedup, "LONGEST", 700)
    assert rows_of(text) == set(range(len(text) - 199))


def test_equal_windows_choose_the_same_place():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 100, 260).astype(np.uint8)
    places = []
    for _ in range(20):
        left, right = (rng.integers(97, 100, rng.integers(1, 400)).astype(np.uint8) for _ in range(2))
        t = np.concatenate([left, shared, right])
        _, _, start, n, offset = suffix_dedup.positions(t, np.array([0]), np.array([len(t)]))
        chosen = {w: s + o for s, k, o in zip(start, n, offset) for w in range(s, s + k)}
        places.append([int(chosen[len(left) + i] - len(left)) for i in range(61)])
    assert all(p == places[0] for p in places)


@pytest.mark.parametrize("which", ["made", "given"])
def test_query(spark, tmp_path, which):
    folder = SF_SMALL
    if which == "made":
        folder = str(tmp_path)
        frame(spark, list(enumerate(made(9)))).write.parquet(f"{folder}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = [(d, n, sum(z - a for a, z in spans), len(spans), hashlib.sha256(kept).hexdigest())
            for (d, _), (n, spans, kept) in zip(docs, plain([t for _, t in docs]))]
    got = QUERIES["op13_suffix_dedup"](spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).count() == 0
