"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and words; everything is counted within a language.
Nodes are grams of ``ORDER - 1`` words, edges the grams of ``ORDER`` words that
lead from one node to the next, weighted by their occurrences.

1. **Edges.** From every word one edge starts: the gram of ``ORDER`` words, or,
   less than that before the end of the piece, what is left of it, closed by an
   end mark. Each task sums equal edges of about ``CHUNK_WORDS`` words in
   numpy; what it sends are blocks of sorted, compressed rows, one for each
   part of the graph, with the words they use.
2. **Flow.** An edge goes to the part of its first word, so one shuffle brings
   together all that a count needs: the flow out of a gram is the sum of the
   edges that begin with it, and the edges closed by an end mark are the
   correction for occurrences at the ends of pieces. All levels, from
   ``ORDER`` words down to one, follow from one sorted pass.
3. **Hot prefixes.** A first pass finds the prefixes of edges that hold more
   than a share of all words (a bound on their number; counts in tasks of at
   least half the share). Edges go by their shortest prefix that is not hot, so
   no part holds much more than its share; the flow of a hot prefix, split over
   parts, is summed from at most one row for each part.
4. **Paths.** Where all occurrences of a node come by one edge and leave by one
   edge, the two are one path. Unary paths are compacted by pointer doubling.

Candidates are frequent grams of two words or more; each is cut in two where
the pointwise information is least (exact decimal arithmetic), and dropped if
all its occurrences lie inside a longer candidate.

Defined results: a null or empty text has no words; a null language counts as
``und``; an empty table gives empty tables; rows that repeat count as often as
they stand there; ties go by count and phrase. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import written

ORDER = 5
MIN_COUNT = 100
#: Words whose edges a task sums at once: pair codes then stay below 2**20 and
#: an edge fits one 63-bit key.
CHUNK_WORDS = 1_000_000
#: A prefix is hot from a quarter of the share of one part on.
HOT = 4

_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)

_BLOCKS = "part int, n int, words binary, rows binary"
_HEAVY = "level int, h bigint, n bigint"
_GRAMS = "lang string, k int, phrase string, f bigint, partial boolean"


class _Numbers:
    """Numbers of (language, word); 0 is the end of a piece."""

    def __init__(self):
        self.by_lang: dict[str, dict[bytes, int]] = {}
        self.names: list[bytes] = [b""]

    def codes(self, text: str, lang: str | None) -> np.ndarray:
        """Numbers of the words of ``text``, 0 after each piece."""
        lang = "und" if lang is None else lang
        known = self.by_lang.setdefault(lang, {b"": -1, b"\n": 0})
        tokens = text.encode("utf-8").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        new = set(tokens).difference(known)
        if new:
            # The language stands before the word; neither tab nor line feed is in either.
            mark = lang.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n").encode("utf-8") + b"\t"
            for w in new:
                known[w] = len(self.names)
                self.names.append(mark + w)
        codes = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        return codes[codes >= 0]


def _language(mark: bytes) -> str:
    out, it = [], iter(mark.decode("utf-8"))
    for c in it:
        out.append({"t": "\t", "n": "\n"}.get(d := next(it), d) if c == "\\" else c)
    return "".join(out)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(codes, names of the codes) of about ``most`` words at a time. Longer
    texts are cut; the words after the cut are given to look ahead."""
    numbers, parts, size = _Numbers(), [], 0

    def flush():
        nonlocal numbers, parts, size
        codes, names = np.concatenate([*parts, np.zeros(ORDER, np.int64)]), numbers.names
        numbers, parts, size = _Numbers(), [], 0
        for a in range(0, len(codes) - ORDER, most):
            here = codes[a:a + most + ORDER]
            if len(here) < len(codes):  # part of a long run: only the words in use
                used = np.unique(np.concatenate([[0], here]))
                yield np.searchsorted(used, here), [names[i] for i in used.tolist()]
            else:
                yield here, names

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                codes = numbers.codes(text, lang)
                if size and size + len(codes) > most:
                    yield from flush()
                    codes = numbers.codes(text, lang)
                parts.append(codes)
                size += len(codes)
    if size:
        yield from flush()


def _hashes(names: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in names), np.uint64, len(names))


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of prefixes with one word more."""
    h = (h ^ (h >> np.uint64(31))) * _ODD + word
    return h ^ (h >> np.uint64(29))


def _edges(codes: np.ndarray, n_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct edges (``ORDER`` numbers, 0 from the end of the piece on) that
    start at any word but the last ``ORDER`` codes, in the order of their
    numbers, and their weights."""
    every = np.flatnonzero(codes[:-1])
    pairs, code = np.unique(codes[every] * n_words + codes[every + 1], return_inverse=True)
    pair_at = np.zeros(len(codes), np.int64)
    pair_at[every] = code + 1
    at = np.flatnonzero(codes[:-ORDER])
    third = np.where(codes[at + 1] > 0, codes[at + 2], 0)
    fourth = np.where(third > 0, codes[at + 3], 0)
    fifth = np.where(fourth > 0, codes[at + 4], 0)
    b = len(pairs) + 1
    keys = np.sort((pair_at[at] * b + np.where(third > 0, pair_at[at + 2], 0)) * n_words + fifth)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    weight = np.diff(np.concatenate([first, [len(keys)]]))
    rest, fifth = np.divmod(keys[first], n_words)
    b12, b34 = np.divmod(rest, b)
    pairs = np.concatenate([[0], pairs])
    return [*np.divmod(pairs[b12], n_words), *np.divmod(pairs[b34], n_words), fifth], weight


def heavy_prefixes(texts: DataFrame, share: float, chunk_words: int = CHUNK_WORDS) -> dict[int, list[int]]:
    """Hashes of the prefixes of 1 to ``ORDER - 1`` words with at least
    ``share`` of all words (and some with half of it or more): at most
    2 / share of each length, whatever the texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, names in _chunks(batches, chunk_words):
            words, at = _hashes(names), np.flatnonzero(codes[:-ORDER])
            least = max(1, share / 2 * len(at))
            level, found, n = [0], [0], [len(at)]
            counts = np.bincount(codes[at], minlength=len(names))
            often = counts >= least
            level += [1] * int(often.sum())
            found += words[often].view(np.int64).tolist()
            n += counts[often].tolist()
            at = at[often[codes[at]]]
            last, h = codes[at], words[codes[at]]
            for k in range(2, ORDER):
                last = np.where(last > 0, codes[at + k - 1], 0)
                h = _extended(h, words[last])
                keys, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
                often = counts >= least
                level += [k] * int(often.sum())
                found += keys[often].view(np.int64).tolist()
                n += counts[often].tolist()
                stay = often[inverse]
                at, last, h = at[stay], last[stay], h[stay]
            yield pa.RecordBatch.from_pydict({"level": pa.array(level, pa.int32()), "h": pa.array(found, pa.int64()),
                                              "n": pa.array(n, pa.int64())})

    counts = written(texts.mapInArrow(count, _HEAVY).groupBy("level", "h").agg(F.sum("n").alias("n")), "prefixes")
    total = counts.where("level = 0").agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("level") > 0) & (F.col("n") >= F.lit(share / 2 * total))).collect()
    return {k: sorted(r["h"] for r in hot if r["level"] == k) for k in range(1, ORDER)}


def _pack(columns: list[np.ndarray], names: list[bytes]) -> tuple[bytes, bytes]:
    """Words in use and rows (numbers of these words, weight, depth), compressed."""
    used = np.zeros(len(names), bool)
    used[0] = True
    for c in columns[:ORDER]:
        used[c] = True
    number = np.cumsum(used) - 1
    table = np.stack([*(number[c] for c in columns[:ORDER]), *columns[ORDER:]]).astype("<u4")
    planes = np.ascontiguousarray(table.view(np.uint8).reshape(*table.shape, 4).transpose(0, 2, 1))
    press = zstandard.ZstdCompressor(level=1)
    return (press.compress(b"\n".join([names[i] for i in np.flatnonzero(used).tolist()])),
            press.compress(planes.tobytes()))


def _unpack(n: int, words: bytes, rows: bytes) -> tuple[list[bytes], np.ndarray]:
    press = zstandard.ZstdDecompressor()
    planes = np.frombuffer(press.decompress(rows), np.uint8).reshape(ORDER + 2, 4, n)
    table = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(ORDER + 2, n)
    return press.decompress(words).split(b"\n"), table


def part_labels(spark: SparkSession, parts: int) -> list[int]:
    """A number for each part such that a shuffle of ``parts`` partitions by
    these numbers gives each partition one part (numbers dealt out by hash
    would leave some without and give others several)."""
    number = F.col("id").cast("int")
    found = spark.range(32 * parts).groupBy(F.pmod(F.hash(number), F.lit(parts)).alias("partition")) \
        .agg(F.min(number).alias("label")).collect()
    labels = {r["partition"]: r["label"] for r in found}
    return [labels.get(p, 32 * parts + p) for p in range(parts)]


def edge_blocks(texts: DataFrame, parts: int, hot: dict[int, list[int]],
                chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Blocks of summed edges, by part of the graph."""
    labels = part_labels(texts.sparkSession, parts)
    hot_hashes = [np.array(hot.get(k, []), np.int64).view(np.uint64) for k in range(1, ORDER)]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, names in _chunks(batches, chunk_words):
            columns, weight = _edges(codes, len(names))
            if not len(weight):
                continue
            hashes = _hashes(names)
            route, depth = hashes[columns[0]], np.ones(len(weight), np.int64)
            burning, h = np.arange(len(weight)), route
            for k, known in enumerate(hot_hashes):
                hot_here = np.isin(h, known)
                burning, h = burning[hot_here], h[hot_here]
                if not len(burning):
                    break
                h = _extended(h, hashes[columns[k + 1][burning]])
                route[burning] = h
                depth[burning] = k + 2
            part = ((route ^ (route >> np.uint64(33))) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            columns = [c[order] for c in (*columns, weight, depth)]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                a, z = cuts[p], cuts[p + 1]
                words, rows = _pack([c[a:z] for c in columns], names)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([labels[p]], pa.int32()), "n": pa.array([z - a], pa.int32()),
                    "words": pa.array([words], pa.binary()), "rows": pa.array([rows], pa.binary())})

    return texts.mapInArrow(blocks, _BLOCKS)


def _flow(min_count: int):
    """Counts of all grams of one part from its edges: grams of at least
    ``min_count``, sums of hot prefixes that other parts hold too (partial), and
    the number of words of each language (k = 0, partial)."""
    def sums(table: pa.Table) -> pa.Table:
        known, names, tables = {b"": 0}, [b""], []
        for n, words, rows in zip(*(table.column(c).to_pylist() for c in ("n", "words", "rows"))):
            own, got = _unpack(n, words, rows)
            for w in set(own).difference(known):
                known[w] = len(names)
                names.append(w)
            number = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
            tables.append((number[got[:ORDER]].astype(np.uint32), got[ORDER:]))
        edges = np.concatenate([t[0] for t in tables], axis=1)
        weight, depth = np.concatenate([t[1] for t in tables], axis=1)
        del tables
        wide = edges.astype(np.uint64)
        if len(names) < 1 << 21:  # then three numbers fit a sort key
            order = np.lexsort((wide[2] << np.uint64(42) | wide[3] << np.uint64(21) | wide[4],
                                wide[0] << np.uint64(21) | wide[1]))
        else:
            order = np.lexsort((wide[4], wide[2] << np.uint64(32) | wide[3], wide[0] << np.uint64(32) | wide[1]))
        edges, weight, depth = edges[:, order], weight[order].astype(np.int64), depth[order]
        del wide, order
        out: dict[str, list] = {"lang": [], "k": [], "phrase": [], "f": [], "partial": []}

        def add(lang, k, phrase, f, partial):
            for name, value in zip(out, (lang, k, phrase, f, partial)):
                out[name].append(value)

        new = np.zeros(len(weight), bool)
        new[:1] = True
        marks = [names[i].split(b"\t", 1) if i else (b"", b"") for i in range(len(names))]
        totals: dict[bytes, int] = {}
        for k in range(1, ORDER + 1):
            new[1:] |= edges[k - 1, 1:] != edges[k - 1, :-1]
            first = np.flatnonzero(new)
            f = np.add.reduceat(weight, first)
            partial = depth[first] > k
            if k == 1:
                for w, c in zip(edges[0, first].tolist(), f.tolist()):
                    totals[marks[w][0]] = totals.get(marks[w][0], 0) + c
            wanted = (edges[k - 1, first] > 0) & (partial | (f >= min_count))
            for row, c, part in zip(edges[:k, first[wanted]].T.tolist(), f[wanted].tolist(), partial[wanted].tolist()):
                add(_language(marks[row[0]][0]), k, b" ".join([marks[w][1] for w in row]).decode("utf-8"), c, part)
        for mark, c in totals.items():
            add(_language(mark), 0, "", c, True)
        return pa.table([pa.array(out["lang"], pa.string()), pa.array(out["k"], pa.int32()),
                         pa.array(out["phrase"], pa.string()), pa.array(out["f"], pa.int64()),
                         pa.array(out["partial"], pa.bool_())], names=list(out))

    return sums


@dataclass
class PhraseGraph:
    """``grams(lang, k, phrase, words, f)``: all grams of 1 to ``ORDER`` words
    with ``f`` of at least ``min_count``; ``totals(lang, n)``: words of a language."""

    grams: DataFrame
    totals: DataFrame
    min_count: int


def phrase_graph(docs: DataFrame, min_count: int = MIN_COUNT, share: float | None = None,
                 chunk_words: int = CHUNK_WORDS) -> PhraseGraph:
    """Counts of all frequent grams of the texts of ``docs(text, lang)``.
    ``share`` of all words makes a prefix hot (default: half of a part's)."""
    spark = docs.sparkSession
    texts = docs.select("text", F.col("lang").cast("string").alias("lang"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = heavy_prefixes(texts, share or 1 / (HOT * parts), chunk_words)
    blocks = edge_blocks(texts, parts, hot, chunk_words)
    found = written(blocks.groupBy("part").applyInArrow(_flow(min_count), _GRAMS), "flow")
    split = found.where("partial and k > 0").groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")) \
        .where(F.col("f") >= min_count)
    grams = found.where("not partial").select("lang", "k", "phrase", "f").unionByName(split)
    totals = found.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return PhraseGraph(written(grams.withColumn("words", F.split("phrase", " ")), "grams"),
                       written(totals, "totals"), min_count)


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def unary_paths(graph: PhraseGraph) -> DataFrame:
    """(lang, phrase, head, step, n_words): every edge with the first edge of
    its path, its place there (from 0) and the words of the whole path.

    Edge a leads on to edge b if both carry all occurrences of the node
    between them. ``up`` points at an earlier edge of the path and doubles its
    reach every round, so the rounds are the logarithm of the longest path;
    the edges of a cycle, which has no first edge, stay paths of their own."""
    edges = written(graph.grams.where(F.col("k") == ORDER).select(
        F.monotonically_increasing_id().alias("id"), "lang", "phrase", "f",
        _joined(F.slice("words", 1, ORDER - 1)).alias("tail"), _joined(F.slice("words", 2, ORDER - 1)).alias("head")),
        "edges")
    nodes = graph.grams.where(F.col("k") == ORDER - 1).select("lang", F.col("phrase").alias("node"), "f")
    into = edges.select("lang", F.col("head").alias("node"), "f", F.col("id").alias("a"))
    out = edges.select("lang", F.col("tail").alias("node"), "f", F.col("id").alias("b"))
    links = nodes.join(into, ["lang", "node", "f"]).join(out, ["lang", "node", "f"]).where("a <> b").select("a", "b")
    up = written(edges.select("id").join(links.select(F.col("b").alias("id"), F.col("a").alias("up")), "id", "left")
                 .select("id", F.coalesce("up", "id").alias("up"), F.col("up").isNotNull().cast("long").alias("step")),
                 "paths")
    moving = None
    while True:
        above = up.select(F.col("id").alias("up"), F.col("up").alias("top"), F.col("step").alias("more"))
        now = up.join(above, "up").select("id", F.col("top").alias("up"), (F.col("step") + F.col("more")).alias("step"),
                                          (F.col("more") > 0).alias("moved"))
        now = written(now, "paths")
        left = now.where("moved").count()
        up = now.drop("moved")
        if left in (0, moving):  # on a path some edge arrives in every round
            break
        moving = left
    if left:
        cyclic = now.where("moved").select("id")
        up = up.join(cyclic, "id", "left_anti").unionByName(
            cyclic.select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("step")))
    up = up.withColumnRenamed("up", "head_id")
    size = up.groupBy("head_id").agg((F.max("step") + ORDER).alias("n_words"))
    first = edges.select(F.col("id").alias("head_id"), F.col("phrase").alias("path_head"))
    return edges.select("id", "lang", "phrase").join(up, "id").join(size, "head_id").join(first, "head_id") \
        .select("lang", "phrase", F.col("path_head").alias("head"), "step", "n_words")


def collocations(graph: PhraseGraph) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of the candidates that no longer
    candidate holds wherever they stand."""
    grams = graph.grams
    found = grams.where("k >= 2")
    # One word more is enough: in between, counts can only be equal.
    longer = found.where("k >= 3")
    inside = longer.select("lang", "f", _joined(F.slice("words", 1, F.col("k") - 1)).alias("phrase")).unionByName(
        longer.select("lang", "f", _joined(F.slice("words", 2, F.col("k") - 1)).alias("phrase"))).distinct()
    kept = found.join(inside, ["lang", "phrase", "f"], "left_anti")
    cuts = kept.select("lang", "phrase", "k", "words", F.col("f").alias("a"),
                       F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"first": _joined(F.slice("words", F.lit(1), F.col("cut"))),
                             "rest": _joined(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")))})
    left = grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole = [F.col(c).cast("decimal(19,0)").alias(c) for c in ("a", "n", "l", "r")]
    scored = cuts.drop("words").join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(graph.totals, "lang") \
        .select("lang", "phrase", "k", "cut", *whole) \
        .withColumn("score", F.expr("(1000 * a * n) div (l * r)"))
    best = scored.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in (
        "a", "best.l", "best.r", "n", "best.score")])


#: Slices of a language that are ranked by themselves first.
SLICES = 64


def top_collocations(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each language by score and count, falling, then
    phrase: ranked in slices first, so that no task sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    sliced = found.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    first = sliced.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order)))
    best = first.where(F.col("_at") <= limit).drop("_at", "_slice")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= limit)
