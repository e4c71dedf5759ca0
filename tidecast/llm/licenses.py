"""Licence scans by a positional rare-token index, native.

Templates are short licence notices, each with mandatory key phrases. Their
words form a positional index (word -> template, position), a fixed table of
a few hundred entries. The weight of a word is its inverse document frequency,
counted over all documents. Each template has its own anchors, its rarest
words: as many as it takes for the others to weigh less than a key phrase.
Where a key phrase of a template stands in a document, the postings of the
template's anchors propose alignments by relative position (document position
minus template position), and each is scored in place by all words of the
template. The best alignment weighs as much as the key phrase at least, so it
holds an anchor and is among them, however many notices the document has.
A template gives its label if its best score reaches ``THRESHOLD``.

Base labels come from four phrases, wherever their words stand in a row.
Documents without a licence word need no position; their words are counted
and nothing else.

Defined results: a null or empty text has no words, labels or places and
score 0; documents that share id and text get the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import LOWER, UPPER, text_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.5
#: More than the words of a text, twice over.
SPAN = 1 << 32

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Template notices (label, words, mandatory key phrases).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     ["gnu general public license version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["permission is hereby granted free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use in source and binary forms"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution license", ["creative commons attribution license"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license",
     ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose",
     ["permission to use copy modify and or distribute this software"]),
]


def normal(text: Column) -> Column:
    """A-Z lower-cased, words apart by single blanks, one blank on each side."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def word_count(norm: Column) -> Column:
    """Words of a normal text: its blanks, less the outer one."""
    blanks = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit("")))
    return F.when(norm == "  ", F.lit(0)).otherwise(blanks - 1).cast("long")


def postings() -> list[tuple[str, int, int]]:
    return [(w, t, p) for t, (_, words, _) in enumerate(TEMPLATES) for p, w in enumerate(words.split())]


def rare_anchors(t: int, weight: dict[str, float]) -> list[str]:
    """Rarest words of a template, without which no alignment reaches the
    weight of its lightest key phrase."""
    _, words, keys = TEMPLATES[t]
    left = sum(weight[w] for w in words.split())
    least = min(sum(weight[w] for w in key.split()) for key in keys)
    out = []
    for w in sorted(set(words.split()), key=lambda w: (-weight[w], w)):
        if left < least - 1e-6:
            break
        out.append(w)
        left -= weight[w] * words.split().count(w)
    return out


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each document: n_words, n_base, first_word, last_word, base_labels,
    labels, score, and the best alignment (template number, word offset)."""
    spark = docs.sparkSession
    vocabulary = sorted({w for w, _, _ in postings()} | {w for p in PHRASES for w in p.split()})
    one_of = F.array(*[F.lit(w) for w in vocabulary])
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), normal(F.col("text")).alias("norm"))

    # How many documents hold each word of the index: one row for each word.
    words = F.split(F.trim("norm"), " ")
    holding = {r["word"]: r["n"] for r in rows.select(F.explode(F.array_intersect(one_of, words)).alias("word"))
               .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_docs = docs.count()
    weight = {w: _idf(n_docs, holding.get(w, 0)) for w in vocabulary}

    # Documents worth a look: those with a key phrase's rarest word.
    anchors = sorted({max(p.split(), key=lambda w: (weight[w], w))
                      for p in [*PHRASES, *[k for _, _, keys in TEMPLATES for k in keys]]})
    hinted = F.col("norm").rlike(" (?:" + "|".join(anchors) + ") ")
    base = rows.withColumn("n_words", word_count(F.col("norm")))
    hits = base.where(hinted).withColumn("words", words)

    # Base phrases: every place, by word number.
    places = F.sequence(F.lit(0), F.size("words") - 1)

    def stands(phrase: str):
        def at_place(i: Column) -> Column:
            same = F.lit(True)
            for k, w in enumerate(phrase.split()):
                same = same & F.coalesce(F.get(F.col("words"), i + k) == w, F.lit(False))
            return same

        return at_place

    for k, phrase in enumerate(PHRASES):
        found = F.filter(places, stands(phrase))
        hits = hits.withColumn(f"at{k}", F.when(F.contains(F.col("norm"), F.lit(f" {phrase} ")), found)
                               .otherwise(F.array().cast("array<int>")))
    at = [F.col(f"at{k}") for k in range(len(PHRASES))]
    labels = F.array_compact(F.array(*[F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, PHRASES.values())]))
    hits = hits.withColumn("all_at", F.concat(*at)).withColumn("base_set", labels)

    # Templates with a key phrase in the document.
    verified = [F.lit(False)] * len(TEMPLATES)
    for t, (_, _, keys) in enumerate(TEMPLATES):
        for key in keys:
            verified[t] = verified[t] | F.contains(F.col("norm"), F.lit(f" {key} "))
    hits = hits.withColumn("verified", F.array(*verified))

    # Anchors of the verified templates with their positions; their postings
    # propose alignments (template * SPAN + shift + SPAN / 2, a plain number).
    n = range(len(TEMPLATES))
    rare = {t: rare_anchors(t, weight) for t in n}
    looked_up = F.array_distinct(F.flatten(F.array(*[
        F.when(verified[t], _strings(rare[t])).otherwise(_strings([])) for t in n])))
    hits = hits.withColumn("rare", looked_up)
    positions = F.filter(F.transform(places, lambda i: F.struct(i.alias("at"), F.get(F.col("words"), i).alias("word"))),
                         lambda s: F.array_contains(F.col("rare"), s["word"]))
    entries = {w: [t * SPAN + SPAN // 2 - p for v, t, p in postings() if v == w and w in rare[t]]
               for w in sorted({w for t in n for w in rare[t]})}
    index = F.map_from_arrays(_strings(list(entries)), F.array(*[F.array(*map(F.lit, e)).cast("array<bigint>")
                                                                 for e in entries.values()]))
    proposed = F.flatten(F.transform(positions, lambda s: F.transform(
        F.element_at(index, s["word"]), lambda e: e + s["at"])))
    # (The condition also keeps "rare" and "verified" from being made anew at
    # each position: what is used once moves into the lambda.)
    proposed = F.array_distinct(F.filter(
        proposed, lambda e: F.get(F.col("verified"), F.floor(e / SPAN).cast("int"))))
    hits = hits.withColumn("proposed", F.when((F.size("rare") > 0) & F.array_contains("verified", True), proposed)
                           .otherwise(F.array().cast("array<bigint>")))

    # Each proposed alignment, by all words of its template in place.
    parts = F.array(*[F.array(*[F.struct(F.lit(p).alias("place"), F.lit(w).alias("word"), F.lit(weight[w]).alias("weight"))
                                for p, w in enumerate(words.split())]) for _, words, _ in TEMPLATES])
    total = [sum(weight[w] for w in words.split()) for _, words, _ in TEMPLATES]
    totals = F.array(*[F.lit(float(x) or 1.0) for x in total])

    def scored(e: Column) -> Column:
        t = F.floor(e / SPAN).cast("int")
        shift = (e - t.cast("long") * SPAN - SPAN // 2).cast("int")
        got = F.aggregate(F.get(parts, t), F.lit(0.0), lambda x, s: x + F.when(
            F.get(F.col("words"), shift + s["place"]) == s["word"], s["weight"]).otherwise(0.0))
        return F.struct((got / F.get(totals, t)).alias("share"), t.alias("template"), (-shift).alias("back"))

    hits = hits.withColumn("scores", F.transform("proposed", scored))

    def best(t: int) -> Column:
        return F.array_max(F.filter("scores", lambda s: s["template"] == t))

    hits = hits.withColumn("tops", F.transform(F.array_compact(F.array(*map(best, n))), lambda s: F.struct(
        s["share"].alias("share"), s["template"].alias("template"), (-s["back"]).alias("shift"))))
    return _assemble(base, hits, threshold)


def _strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)).cast("array<string>")


def _assemble(base: DataFrame, hits: DataFrame, threshold: float) -> DataFrame:
    key = ["doc_id", "text_key"]
    names = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    scored = hits.select(*key, "all_at", "base_set", F.col("tops").alias("good")).dropDuplicates(key) \
        .withColumn("taken", F.filter("good", lambda s: s["share"] >= threshold))
    label = F.transform("taken", lambda s: F.get(names, s["template"]))
    top = F.array_max("good")
    facts = scored.select(
        *key, F.size("all_at").cast("long").alias("n_base"),
        F.array_min("all_at").cast("long").alias("first_word"), F.array_max("all_at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_set")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base_set", label))), ",").alias("labels"),
        F.greatest(F.least(F.coalesce(top["share"], F.lit(0.0)), F.lit(1.0)),
                   F.when(F.size("base_set") > 0, F.lit(1.0)).otherwise(0.0)).alias("score"),
        top["template"].alias("template"), top["shift"].alias("template_at"))
    none = base.alias("d").join(facts.alias("f"), [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in key], "left")
    return none.select(
        F.col("d.doc_id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        "template", "template_at")


def _idf(docs: int, holding: int) -> float:
    """Smoothed inverse document frequency, rounded so that every engine and
    partitioning gives the same weight."""
    import math

    return round(math.log((docs + 1) / (holding + 1)) + 1e-3, 6)
