"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidecast.llm import periodic_runs
from tidecast.llm.queries import QUERIES


def plain(w):
    """(runs by start and period, words that stay) by trying every period."""
    runs = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                runs.setdefault((i, j + q), q)
            i = max(j, i + 1)
    runs = sorted((a, b - a, q) for (a, b), q in runs.items())
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    return runs, " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return [x.decode() for x in w]


def test_random_texts():
    rng = random.Random(3)
    for _ in range(150):
        docs = []
        for _ in range(rng.randrange(1, 8)):
            size, k = rng.randrange(rng.choice([5, 30, 200])), rng.choice([1, 2, 2, 3, 5, 50])
            w = [f"w{rng.randrange(k)}" for _ in range(size)]
            if size and rng.random() < 0.6:
                a = rng.randrange(size)
                p = 1 + (size - a) // (3 + rng.randrange(8))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(size)]
            docs.append(w)
        for w, got in zip(docs, periodic_runs.detect([" ".join(w) for w in docs])):
            assert got == (*plain(w), len(w))


def test_long_texts():
    thue = " ".join("ab"[i.bit_count() % 2] for i in range(20000))
    same, twice = "long " * 30000, " ".join(f"w{i % 5000}" for i in range(10000))
    four = " ".join(f"w{i % 1000}" for i in range(4000)) + " end"
    got = periodic_runs.detect([thue, same, twice, four])
    assert [x[0] for x in got] == [[], [(0, 30000, 1)], [], [(0, 4000, 1000)]]
    assert got[1][1] == "long" and got[3][1].split()[-2:] == ["w999", "end"]


def test_parts_do_not_matter(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(30)]
    whole = periodic_runs.detect(texts)
    monkeypatch.setattr(periodic_runs, "PART_WORDS", 50)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 7)
    assert periodic_runs.detect(texts) == whole


def test_hashes_that_meet_are_found_out(monkeypatch):
    monkeypatch.setattr(periodic_runs._Words, "equal", lambda self, a, b, size: a >= 0, raising=True)
    w = ["a", "b"] * 2 + ["a", "c"]
    ids = periodic_runs.np.array([0, 1, 0, 1, 0, 2] * 3)
    first = periodic_runs._crossing(periodic_runs._Words(ids, 0), *[periodic_runs.np.array([x]) for x in (0, 9, 18)])
    assert w and not all(periodic_runs._exact(ids, 0, 18, a, b, q) for a, b, q in first[1:].T)


ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "a b " * 4), (7, "A a " * 4),
        (None, "x y z " * 5 + "x"), (9, "x y z " * 5 + "x"), (9, "x y z " * 5 + "x"), (10, "p " * 6 + "q " * 6)]


def test_defined_results(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for extra in ("periodic", "runs", "start", "length", "period", "n_words"):
        docs = docs.withColumn(extra + "_", F.lit(1)).withColumn(extra.upper() + "x", F.lit("x"))
    found = periodic_runs.with_runs(docs.withColumn("runs", F.lit(5)))
    assert found.columns == [*docs.columns, "runs", "periodic"]
    got = sorted((str(r["doc_id"]), str(r["text"]), [tuple(x) for x in r["periodic"]["runs"]], r["periodic"]["collapsed"],
                  r["periodic"]["n_words"]) for r in found.collect())
    want = [(str(d), str(t), *plain((t or "").split()), len((t or "").split())) for d, t in ROWS]
    assert got == sorted(want)
    assert periodic_runs.with_runs(docs.where("false")).count() == 0


@pytest.mark.parametrize("which", ["hard", "given"])
def test_query(spark, tmp_path, which):
    folder = SF_SMALL
    if which == "hard":
        folder = str(tmp_path)
        rng = random.Random(8)
        rows = [*ROWS, *[(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(80)))) for i in range(60)]]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("periodic", F.lit(1))
        docs.withColumn("start", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = []
    for d, t in docs:
        runs, kept = plain(planted(d, t))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        want.append((d, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    got = QUERIES["op12_periodic_runs"](spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_periodic_runs"](spark, str(tmp_path)).count() == 0
