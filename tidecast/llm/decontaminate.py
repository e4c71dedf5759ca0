"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Patterns are all windows of ``window`` consecutive words of each benchmark
item (an item of fewer words is one window). Windows of one length share a
table: for each block of two words it holds how far the window may move on
when the block stands at its end. A shift of zero selects the bucket of
patterns with that last block; their words are then compared directly.

The benchmark is a stated query set. It is read in parts of at most
``part_words`` words, one at a time: each is broadcast and applied to all
documents, and what it found is written before the next one is read, so what
the driver and a task hold is bounded however large the benchmark is.

Defined results: a null or empty text has no words, no hits and is clean; an
item without words is never found; the words of an item with a null id are hit
like any others, but it is not among the items found; an id that stands on
several rows counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import alnum_words, written

WINDOW = 13
PART_WORDS = 1_000_000

HITS = "n_words long, n_hit long, spans array<struct<first:int,past:int>>, items array<string>"


class WuManber:
    """Search tables for windows that all have ``length`` words (as numbers;
    0 stands for any word that no pattern has)."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], list[str]], base: int):
        self.length, self.base = length, base
        self.block = 2 if length > 1 else 1
        self.far = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[list[int], list[str]]]] = {}
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self.key(words, end - 1)
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.bucket.setdefault(self.key(words, length - 1), []).append((list(words), items))

    def key(self, words, at: int) -> int:
        return words[at - 1] * self.base + words[at] if self.block == 2 else words[at]

    def find(self, words: list[int]) -> Iterator[tuple[int, list[str]]]:
        """First word and items of every occurrence."""
        at, n, base, length, two = self.length - 1, len(words), self.base, self.length, self.block == 2
        shift, far, bucket = self.shift.get, self.far, self.bucket
        while at < n:
            key = words[at - 1] * base + words[at] if two else words[at]
            step = shift(key, far)
            if step:
                at += step
                continue
            start = at - length + 1
            here = words[start:at + 1]
            for pattern, items in bucket[key]:
                if pattern == here:
                    yield start, items
            at += 1


class Matcher:
    """All search tables of one part of the benchmark."""

    def __init__(self, part: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for item, text in part:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in alnum_words(text)]
            if not ids:
                continue
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1):
                owners = by_length.setdefault(size, {}).setdefault(tuple(ids[k:k + size]), [])
                if item is not None and item not in owners:
                    owners.append(item)
        base = len(self.number) + 1
        self.tables = [WuManber(size, found, base) for size, found in sorted(by_length.items())]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        ids = list(map(self.number.get, words, [0] * len(words)))
        spans, items = [], set()
        for table in self.tables:
            for start, owners in table.find(ids):
                spans.append((start, start + table.length))
                items.update(owners)
        return spans, items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, past in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([first, past])
    return [tuple(x) for x in out]


#: The tables of the part in use, by its name; kept by each Python worker.
_MATCHERS: dict[str, Matcher] = {}


def _scanner(part, window: int):
    """UDF over (text, what earlier parts found) for one broadcast part."""
    name = uuid.uuid4().hex

    @F.pandas_udf(HITS)
    def scan(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        if name not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[name] = Matcher(part.value, window)
        matcher, rows = _MATCHERS[name], []
        for t, spans, items in zip(text, before["spans"], before["items"]):
            words = alnum_words(t)
            new, found = matcher.scan(words)
            old = [(s["first"], s["past"]) for s in spans] if spans is not None else []
            hit = merge(old + new)
            found.update(items if items is not None else [])
            rows.append((len(words), sum(b - a for a, b in hit),
                         [{"first": a, "past": b} for a, b in hit], sorted(found)))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "spans", "items"])

    return scan.asNondeterministic()


def benchmark_parts(benchmark: DataFrame, part_words: int = PART_WORDS) -> Iterator[list[tuple[str, str]]]:
    """The items in parts of at most ``part_words`` words (at least one item
    each), read partition by partition."""
    part: list[tuple[str, str]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text") \
        .where("text is not null")
    for row in rows.toLocalIterator():
        n = len(alnum_words(row["text"]))
        if part and size + n > part_words:
            yield part
            part, size = [], 0
        part.append((row["item_id"], row["text"]))
        size += n
    if part:
        yield part


def find_benchmark(docs: DataFrame, benchmark: DataFrame, out: str = "found", window: int = WINDOW,
                   part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit (words inside any
    occurrence), spans (word ranges hit) and items (sorted ids found)."""
    sc = docs.sparkSession.sparkContext
    nothing = F.from_json(F.lit('{"spans":[],"items":[]}'), HITS)
    docs = docs.withColumn(out, nothing)
    parts = benchmark_parts(benchmark, part_words)
    part = next(parts, [])
    while True:
        docs = docs.withColumn(out, _scanner(sc.broadcast(part), window)(F.col("text"), F.col(out)))
        part = next(parts, None)
        if part is None:
            return docs
        # One part at a time: what it found is written before the next is sent.
        docs = written(docs, "scanned")


def contaminated(found: str = "found", num: int = 1, den: int = 20) -> Column:
    """At least ``num/den`` of the words are hit, and at least one is."""
    n_hit, n_words = F.col(f"{found}.n_hit"), F.col(f"{found}.n_words")
    return (n_hit > 0) & (F.lit(den) * n_hit >= F.lit(num) * n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return find_benchmark(row, benchmark, **options).where(~contaminated()).select("row.*")
