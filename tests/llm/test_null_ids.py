"""Null ids, hot ids, repeated rows and edited maps."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_contracts import BENCH
from tidecast.llm import decontaminate, sharding

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(500)) for _ in range(n))


@pytest.mark.parametrize("part_words", [10**6, 30])
def test_items_without_id_mark_words(spark, part_words):
    rng = random.Random(3)
    other = prose(rng, 20)
    docs = [(1, prose(rng, 40) + " " + BENCH), (None, BENCH + " " + other), (3, other), (3, other), (4, prose(rng, 30)),
            (5, None)]
    items = [(None, BENCH), (7, other), (None, None), (8, prose(rng, 25)), (9, prose(rng, 25))]
    found = decontaminate.find_benchmark(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame(items, "item_id long, text string"), part_words=part_words)
    got = sorted((str(r["doc_id"]), r["found"]["n_words"], r["found"]["n_hit"], r["found"]["items"])
                 for r in found.collect())
    plain = brute.decontaminated([(str(d), t) for d, t in docs], [("null" if i is None else i, t) for i, t in items])
    want = sorted((d, n, hit, ["7"] if d in ("None", "3") else []) for d, n, hit, *_ in plain)
    assert got == want
    assert {(d, hit) for d, _, hit, _ in got} >= {("1", 17), ("None", 37), ("4", 0), ("5", 0)}


def hot_docs(spark):
    """A third of the rows without id, another sixth with one and the same."""
    rng = random.Random(5)
    rows = [(None if i % 3 == 0 else 7 if i % 6 == 1 else i, prose(rng, rng.randrange(5, 60))) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).repartition(5)


def loads_of(placed):
    rows = placed.collect()
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    for s in size:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    return rows, size


def test_hot_ids_do_not_load_one_shard(spark):
    docs = hot_docs(spark)
    rows, size = loads_of(sharding.shard_documents(docs))
    mean = sum(size.values()) / 24
    assert len(rows) == 3000 and len(size) == 24
    assert max(size.values()) <= 1.05 * mean
    assert len({r["virtual_slot"] for r in rows if r["doc_id"] is None}) > 30


def test_map_is_edited_and_kept(spark):
    docs, more = hot_docs(spark), hot_docs(spark).where("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") + 10**6)
    stored = sharding.SlotMap(spark)
    loads_of(sharding.shard_documents(docs, 24, stored))
    grown = docs.unionByName(more)
    rows, size = loads_of(sharding.shard_documents(grown, 26, stored, version=2))
    first, second = stored.shards(1), stored.shards(2)
    assert set(second.values()) == set(range(26)) and set(first.values()) == set(range(24))
    stay = sum(first[s] == second[s] for s in first)
    assert stay >= 0.85 * len(first)  # two of 26 shards are filled from the others
    assert max(size.values()) <= 1.05 * sum(size.values()) / 26
    assert {r["virtual_slot"]: r["shard"] for r in rows} == second
    with pytest.raises(Exception):
        stored.store(2, second, [])  # a version is written once


def test_shards_are_written_where_the_map_says(spark, tmp_path):
    docs = hot_docs(spark).drop("shard")
    stored = sharding.SlotMap(spark)
    placed = sharding.shard_documents(docs, 24, stored)
    sharding.write_shards(docs, stored.load(1), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    want = Counter((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"]) for r in placed.collect())
    text = F.encode("text", "UTF-8")
    got = back.select("doc_id", (F.octet_length("text") + 8).alias("size"), F.crc32(text).alias("c"), "shard").collect()
    assert Counter((str(r["doc_id"]), r["size"], r["c"], r["shard"]) for r in got) == want


def test_empty_table_has_an_empty_map(spark):
    docs = hot_docs(spark).where("false")
    assert sharding.shard_documents(docs).count() == 0
