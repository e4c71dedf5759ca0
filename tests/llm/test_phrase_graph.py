"""Phrase collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from tidecast.llm import phrase_graph as pg
from tidecast.llm.queries import QUERIES


def pieces(docs):
    for text, lang in docs:
        for part in re.split("[.,;:!?\n-\r]", brute.lower(text)):
            words = re.findall("[^\x20\t]+", part)
            if words:
                yield "und" if lang is None else lang, words


def plain(docs, least, top=None):
    """[(lang, rank, phrase, a, l, r, n, score)] by counting every gram."""
    f, n = Counter(), Counter()
    for lang, w in pieces(docs):
        n[lang] += len(w)
        for k in range(1, 6):
            f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    f = {g: c for g, c in f.items() if c >= least}
    out = []
    for (lang, p), a in f.items():
        inside = any(g[0] == lang and len(g[1]) > len(p) and c >= a
                     and any(g[1][i:i + len(p)] == p for i in range(len(g[1]))) for g, c in f.items())
        if len(p) < 2 or inside:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r, n[lang]))
    ranked, rank = [], Counter()
    for lang, score, a, p, l, r, n_ in sorted(out):
        rank[lang] += 1
        if top is None or rank[lang] <= top:
            ranked.append((lang, rank[lang], p.decode(), -a, l, r, n_, -score))
    return ranked


def made(seed=2):
    rng = random.Random(seed)
    docs = [(None, "a"), ("", "b"), (" \t.\n,", None), ("one. two, three", "x\ty\\\n")]
    line = "the very same line of words stands here again and again. so it does"
    for i in range(60):
        text = " ".join(rng.choice("ABCdef") + rng.choice(["", "", "", ".", ",\n"]) for _ in range(rng.randrange(60)))
        docs.append((f"{text} {line}" if i % 2 else text, rng.choice(["a", "b", None, "x\ty\\\n"])))
    docs.append(("round and " * 40, "b"))
    docs.append(("é\x85ü É\xa0x " * 9, "a"))
    return docs


def frame(spark, docs):
    rows = spark.createDataFrame(docs, "text string, lang string")
    for extra in ("k", "f", "part", "n", "phrase", "words"):
        rows = rows.withColumn(extra, F.lit(1))
    return rows.repartition(3)


@pytest.mark.parametrize("share,chunk", [(None, 10**6), (0.02, 10**6), (0.001, 150), (0.3, 40)])
def test_counts(spark, share, chunk):
    docs = made()
    graph = pg.phrase_graph(frame(spark, docs), min_count=4, share=share, chunk_words=chunk)
    found = pg.top_collocations(pg.collocations(graph), 30)
    got = [tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == plain(docs, 4, 30)


def test_repeated_rows_count(spark):
    docs = [("alpha beta gamma", "a")] * 5 + [("alpha beta", None)] * 3
    graph = pg.phrase_graph(frame(spark, docs), min_count=2)
    got = {(r["lang"], r["phrase"]): r["f"] for r in graph.grams.collect()}
    assert got["a", "alpha beta gamma"] == 5 and got["und", "alpha beta"] == 3
    assert [(r["lang"], r["phrase"]) for r in pg.collocations(graph).orderBy("lang").collect()] == [
        ("a", "alpha beta gamma"), ("und", "alpha beta")]


def test_paths(spark):
    long = " ".join(f"p{i}" for i in range(40))
    docs = [(long, "a")] * 6 + [(long + " more of it all here", "b")] * 3 + [(long, "b")] * 2 + [("r s t u v w " * 9, "c")]
    graph = pg.phrase_graph(frame(spark, docs), min_count=2)
    got = {(r["lang"], r["phrase"]): (r["step"], r["n_words"]) for r in pg.unary_paths(graph).collect()}
    word = long.split()
    for i in range(36):
        assert got["a", " ".join(word[i:i + 5])] == (i, 40)
        # In b the last words end five times and go on three times.
        assert got["b", " ".join(word[i:i + 5])] == (i, 40)
    assert got["b", "p39 more of it all"] == (3, 9) and got["b", "p36 p37 p38 p39 more"] == (0, 9)
    assert {v for (lang, _), v in got.items() if lang == "c"} <= {(i, n) for n in range(5, 12) for i in range(7)}


def test_cycle_has_no_path(spark):
    # Every node of the ring is entered and left by one edge that carries it all.
    rows = [(f"w{i % 7}", f"w{(i + 1) % 7}") for i in range(7)]
    ring = [" ".join(f"w{(i + j) % 7}" for j in range(5)) for i in range(len(rows))]
    nodes = [" ".join(f"w{(i + j) % 7}" for j in range(4)) for i in range(len(rows))]
    grams = spark.createDataFrame([("a", 5, p, 3, p.split()) for p in ring] + [("a", 4, p, 3, p.split()) for p in nodes],
                                  "lang string, k int, phrase string, f long, words array<string>")
    got = pg.unary_paths(pg.PhraseGraph(grams, None, 2)).collect()
    assert sorted((r["phrase"], r["head"], r["step"], r["n_words"]) for r in got) == sorted((p, p, 0, 5) for p in ring)


def test_query(spark, tmp_path):
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op11_phrase_collocations"](spark, SF_SMALL)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == plain(docs, 100, 2000)
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_phrase_collocations"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 51, 211])
def test_every_partition_gets_one_part(spark, parts):
    labels = pg.part_labels(spark, parts)
    assert len(set(labels)) == parts
    rows = spark.createDataFrame([(x,) for x in labels], "part int").repartition(parts, "part")
    assert rows.groupBy(F.spark_partition_id().alias("p")).count().where("count = 1").count() == parts
