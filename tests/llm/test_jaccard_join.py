"""The trie and the whole join on families of near copies."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from tidecast.llm import jaccard_join


def test_trie_finds_every_pair():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 40, 120))
    sets = []
    for _ in range(60):
        gone = rng.choice(base, rng.integers(0, 25), replace=False)
        sets.append(np.unique(np.concatenate([np.setdiff1d(base, gone), rng.integers(0, 1 << 40, rng.integers(0, 12))])))
    p, s = jaccard_join.Trie(85, 100).links(sets, sets)
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
            if 100 * (n := len(np.intersect1d(a, b))) >= 85 * (len(a) + len(b) - n)}
    assert set(zip(p.tolist(), s.tolist())) == want


def test_family_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    docs = []
    for d in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        docs.append((d, " ".join(words)))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(rows, 4, 85, 100).collect())
    assert got == sorted(brute.near(docs, 4, 85, 100))


def test_texts_nobody_needs_are_not_dealt(spark, monkeypatch, capsys):
    docs = [(d, f"a b c d e f g h {d // 2}") for d in range(40)] + [(None, "one"), (50, None)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = rows.where("doc_id < 4 or doc_id is null").selectExpr("coalesce(doc_id, 99) v", "doc_id", "xxhash64(text) text_key")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join.sets_of(rows, wanted, 4)
        few = {r["v"]: sorted(r["s"]) for r in found.collect()}
        found.explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        monkeypatch.setattr(jaccard_join, "KEYS", 0)
        assert few == {r["v"]: sorted(r["s"]) for r in jaccard_join.sets_of(rows, wanted, 4).collect()} and set(few) == {0, 1, 2, 3, 99}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shingle_lists_are_dealt_once(spark, monkeypatch, capsys):
    docs = [(d, " ".join(f"w{d // 3 * 7 + i}" for i in range(20))) for d in range(60)]
    rows = spark.createDataFrame([*docs, (None, ""), (7, None)], "doc_id long, text string")
    limit, old = jaccard_join.Threshold(85, 100), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = jaccard_join.written(jaccard_join.shingles(rows, 4, limit), "t-shingles")
        first = table.where("n > 0").groupBy("digest").agg(F.min("v").alias("rep"))
        found = jaccard_join.prefixes(table, first, limit)
        found.explain()
        plan = capsys.readouterr().out
        few = sorted(tuple(r) for r in found.collect())
        assert plan.count("Exchange hashpartitioning(tok") == 1
        assert len(jaccard_join.vertices_of(table, first).collect()) == 20
        monkeypatch.setattr(jaccard_join, "KEYS", 0)
        assert few == sorted(tuple(r) for r in jaccard_join.prefixes(table, first, limit).collect()) and few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_texts_that_stay_are_not_dealt(spark, monkeypatch, capsys):
    text = lambda i: " ".join(f"w{i}_{j}" for j in range(30))
    docs = [(d, text(d)) for d in range(20)] + [(30, text(1)), (31, text(2) + " more"), (5, text(5)), (5, text(6)), (None, text(8)),
                                                (None, text(40)), (None, text(40)), (41, ""), (41, ""), (42, None), (None, None)]
    rows = spark.createDataFrame(docs, "doc_id int, text string").withColumn("key", F.lit("k")).withColumn("kept", F.lit(7))
    # The smallest id of a group stays, a null id before all others.
    want = [*[(d, text(d)) for d in range(20) if d not in (6, 8)], (5, text(6)), (None, text(8)), (None, text(40)), (41, ""), (42, None),
            (None, None)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join.drop_near_duplicates(rows, 5, 4, 5)
        found.explain()
        plan = capsys.readouterr().out
        assert "LeftAnti" in plan.splitlines()[next(i for i, x in enumerate(plan.splitlines()) if "Union" in x) + 2]
        assert found.columns == rows.columns
        got = sorted(map(str, found.collect()))
        assert got == sorted(str(r) for r in spark.createDataFrame(want, "doc_id int, text string")
                             .withColumn("key", F.lit("k")).withColumn("kept", F.lit(7)).collect())
        monkeypatch.setattr(jaccard_join, "KEYS", 0)
        few = jaccard_join.drop_near_duplicates(rows, 5, 4, 5)
        few.explain()
        assert "LeftSemi" not in capsys.readouterr().out
        assert got == sorted(map(str, few.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
