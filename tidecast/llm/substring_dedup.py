"""Substring deduplication over sliding sentence spans.

A text is cut into sentences (at line breaks and after . ! or ? before white
space); a sentence of more than ``LONG`` words is cut further, every ``LONG``
words. From each sentence on, the shortest run of at least ``MIN_SENTENCES``
sentences with at least ``MIN_WORDS`` words is hashed (128 bits, words
lower-cased). All hashes meet in one shuffle. The first span of a hash is the
one with the smallest (doc_id, text key, place); sentences that any other
span of a repeated hash covers are removed.

A hash that very many documents share is reduced to its first span by a
partial aggregate; its spans then meet that one row, never each other. Hashes
with a large share of all spans (200 at most) are not shuffled: their first
spans are sent to all tasks instead.

Defined results: a null text stays null; a run that would reach past the end
of its document is not hashed, so short documents stay as they are; rows that
share id and text are one document and none of them is the other's copy.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import hot_keys, text_key, written

MIN_SENTENCES = 3
MIN_WORDS = 24
LONG = 16

_END = re.compile(r"[.!?]+(?=[\x20\x09-\x0d])|\n|\Z")
_WORD = re.compile("[^\x20\x09-\x0d]+")


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of words) of each sentence, in code points."""
    out, start = [], 0
    for end in _END.finditer(text):
        words = [w.span() for w in _WORD.finditer(text, start, end.end())]
        start = end.end()
        for k in range(0, len(words), LONG):
            part = words[k:k + LONG]
            out.append((part[0][0], part[-1][1], len(part)))
    return out


def runs(text: str, min_sentences: int, min_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, last sentence, hash) of every run."""
    found = sentences(text)
    digests = [hashlib.blake2b(b" ".join(text[a:b].lower().encode("utf-8").split()), digest_size=16).digest()
               for a, b, _ in found]
    out, past, words = [], 0, 0
    for first in range(len(found)):
        while past < len(found) and (past - first < min_sentences or words < min_words):
            words += found[past][2]
            past += 1
        if past - first < min_sentences or words < min_words:
            break
        out.append((first, past - 1, hashlib.blake2b(b"".join(digests[first:past]), digest_size=16).digest()))
        words -= found[first][2]
    return out


def spans(docs: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    """doc_id, text_key, place (first and last sentence in one number) and the
    hash (two numbers) of every run of every document."""
    @F.pandas_udf("array<struct<place:bigint,h1:bigint,h2:bigint>>")
    def hashed(text: pd.Series) -> pd.Series:
        return pd.Series([[{"place": a << 32 | b, "h1": int.from_bytes(h[:8], "little", signed=True),
                            "h2": int.from_bytes(h[8:], "little", signed=True)}
                           for a, b, h in runs(t, min_sentences, min_words)] if t else [] for t in text])

    return docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                       F.explode(hashed.asNondeterministic()("text")).alias("run")) \
        .select("doc_id", "text_key", "run.*")


def repeated(found: DataFrame) -> DataFrame:
    """The spans that are not the first of their hash. Both sides of the join
    come from one shuffle by hash; the spans of hot hashes stay in place."""
    key = ["h1", "h2"]
    here = F.struct("doc_id", "text_key", "place")

    def first(spans: DataFrame) -> DataFrame:
        return spans.groupBy(*key).agg(F.min(here).alias("origin"), F.max(here).alias("latest")) \
            .where(~F.col("origin").eqNullSafe(F.col("latest"))).select(*key, "origin")

    hot = hot_keys(found, "h1")
    often = F.col("h1").isin(hot)
    by_hash = (found.where(~often) if hot else found).repartition(*key)
    met = by_hash.join(first(by_hash), key)
    if hot:
        stay = found.where(often)
        met = met.unionByName(stay.join(F.broadcast(first(stay)), key))
    return met.where(~here.eqNullSafe(F.col("origin"))).select("doc_id", "text_key", "place")


def remove_repeats(docs: DataFrame, out: str = "clean", min_sentences: int = MIN_SENTENCES,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with a struct ``out``: text (without the sentences that a later
    copy of a span covers), n_sentences, n_removed and removed (their ranges
    in code points, start:end, comma-joined)."""
    found = written(spans(docs, min_sentences, min_words), "sentence-spans")
    # The covered sentences of one document: no more than it has.
    cover = repeated(found).distinct().groupBy("doc_id", "text_key") \
        .agg(F.collect_list("place").alias("cover"))

    @F.pandas_udf("text string, n_sentences int, n_removed int, removed string")
    def apply(text: pd.Series, cover: pd.Series) -> pd.DataFrame:
        rows = []
        for t, c in zip(text, cover):
            all_ = sentences(t) if t else []
            gone = {k for x in c for k in range(x >> 32, (x & 0xFFFFFFFF) + 1)} if c is not None else set()
            pieces, at, ranges = [], 0, []
            for k, (a, b, _) in enumerate(all_):
                if k in gone:
                    pieces.append(t[at:a])
                    at = b
                    if ranges and ranges[-1][2] == k - 1:
                        ranges[-1] = (ranges[-1][0], b, k)
                    else:
                        ranges.append((a, b, k))
            clean = "".join(pieces) + t[at:] if gone else t
            rows.append((clean, len(all_), len(gone), ",".join(f"{a}:{b}" for a, b, _ in ranges)))
        return pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed", "removed"])

    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_key(F.col("text")).alias("text_key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.text_key").eqNullSafe(F.col("c.text_key"))
    joined = rows.join(cover.alias("c"), same, "left").select("row", "cover")
    return joined.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != out],
                         apply.asNondeterministic()("row.text", "cover").alias(out))
