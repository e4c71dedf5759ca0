"""Sentence spans against a plain version, and every query on tables without
rows, with null ids, repeated rows and clashing columns."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.test_contracts import BENCH
from tidecast.llm import substring_dedup
from tidecast.llm.queries import QUERIES, vocabulary

DROPS = {"op2_packing": "pieces", "op11_phrase_collocations": "phrases"}


def cut(text):
    """[(start, end)] of the sentences: at line breaks and after . ! ? before
    white space; sixteen words at most."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] != "\n" and not (
                text[end] in ".!?" and re.match("[.!?]*[\x20\x09-\x0d]", text[end:])):
            end += 1
        if end < len(text) and text[end] != "\n":
            while text[end] in ".!?":
                end += 1
            stop = end
        else:
            stop = end
            end += 1
        words = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", text[:stop]) if m.start() >= at]
        out += [(words[i][0], words[min(i + 15, len(words) - 1)][1]) for i in range(0, len(words), 16)]
        at = end
    return out


def plain(docs, least_sentences=3, least_words=24):
    """doc_id -> (text left, sentences, ranges gone) with the first span of each
    run of sentences kept, documents in the order of their ids."""
    runs, seen, gone = {}, {}, {d: set() for d, _ in docs}
    for d, text in sorted(docs):
        found = cut(text or "")
        said = [" ".join(w for w in re.split("[\x20\x09-\x0d]+", text[a:b].lower()) if w) for a, b in found]
        runs[d] = found
        for i in range(len(found)):
            j, words = i, 0
            while j < len(found) and (j - i < least_sentences or words < least_words):
                words += len(said[j].split(" "))
                j += 1
            if j - i < least_sentences or words < least_words:
                break
            first = seen.setdefault(tuple(said[i:j]), (d, i))
            if first != (d, i):
                gone[d].update(range(i, j))
    out = {}
    for d, text in docs:
        keep, at = [], 0
        for k, (a, b) in enumerate(runs[d]):
            if k in gone[d]:
                keep.append(text[at:a])
                at = b
        out[d] = ("".join(keep) + text[at:] if gone[d] else text, len(runs[d]), len(gone[d]))
    return out


def test_sentence_spans_against_a_plain_version(spark):
    rng = random.Random(11)
    pool = [" ".join(f"{rng.choice('abcde')}{rng.randrange(40)}" for _ in range(rng.randrange(3, 40))) for _ in range(30)]
    docs = [(0, None), (1, ""), (2, " \n . ? "), (3, "One. two! three?")]
    for d in range(4, 60):
        texts = [rng.choice(pool) + rng.choice([". ", "! ", "?\n", "\n", ".. ", ".x "]) for _ in range(rng.randrange(12))]
        if d % 4 == 0:
            a = rng.randrange(20)
            texts += [f"{p.upper() if d % 8 else p}. " for p in pool[a:a + 7]]
        docs.append((d, "".join(texts)))
    docs.append((60, "The same words again here. And once more they come now. So they do and do again. " * 6))
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cover", F.lit(1)).repartition(3)
    got = {r["doc_id"]: (r["clean"]["text"], r["clean"]["n_sentences"], r["clean"]["n_removed"])
           for r in substring_dedup.remove_repeats(rows).collect()}
    assert got == plain(docs)
    assert sum(n > 0 for _, _, n in got.values()) > 10


EDGES = [(None, None), (None, "Null id. With a text of its own. And a passage. " + BENCH), (1, "a b c"), (1, "a b c"),
         (2, "a b c"), (None, "a b c"), (3, ""), (4, "word " * 700), (4, "word " * 700),
         (5, "password=abcdefghijkl MIT License " + "x y z " * 60)]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("edges")
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    for extra in ("v", "row", "rank", "place", "shard", "spans", "n", "c", "tok", "words", "size", "place_"):
        docs = docs.withColumn(extra, F.lit("x"))
    for name, rows in (("full", docs), ("none", docs.where("false"))):
        rows.repartition(2).write.parquet(f"{base}/{name}/documents.parquet")
        spark.createDataFrame([(1, BENCH), (None, "a b c")], "item_id long, text string").write.parquet(
            f"{base}/{name}/benchmark.parquet")
    return base


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_tables_at_the_edge(spark, folders, name):
    assert vocabulary()
    empty = QUERIES[name](spark, f"{folders}/none")
    assert empty.count() == 0
    full = QUERIES[name](spark, f"{folders}/full")
    assert full.columns == empty.columns
    rows = full.collect()
    if name not in DROPS:
        assert len(rows) == len(EDGES)
        assert sum(r["doc_id"] is None for r in rows) == 3
    elif name == "op2_packing":
        assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5}
    else:
        assert {r["lang"] for r in rows} == {"und"}
    if name == "op13_suffix_dedup":
        assert sorted((r["doc_id"], r["n_removed"]) for r in rows if r["n_removed"]) == [
            (4, 3500), (4, 3500), (5, next(r["n_removed"] for r in rows if r["doc_id"] == 5))]
