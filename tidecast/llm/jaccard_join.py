"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets.

Every set is put in one global order, rarest shingles first, so that sets
above the threshold share a shingle among their first few (the prefix). A
branch of the tree is one prefix shingle with the sets that hold it there.

1. Sets with the same shingles are one vertex (by a 128-bit digest).
2. Order: shingles in the lower ``LOW`` part of the hash range come first, by
   document frequency and hash; the others follow by hash. Frequencies are
   counted for that part only, over all documents; any fixed order gives
   whole results, a rare-first one gives small branches. Shingles of
   frequency one are never sent back to their documents.
3. In a branch of at most ``FEW`` vertices all pairs meet. Length and position
   bounds drop hopeless ones; the rest meet their whole sets, exactly once.
4. Vertices of larger branches are cut into blocks of bounded size, those with
   the same largest branch together, and each vertex goes with its block, not
   with each of its branches. Pairs of blocks that share a branch are joined in
   a trie of the ordered sets: a node's overlap with every probe is its
   parent's plus one column, so a shared path is walked once; subtrees whose
   remaining length cannot reach the overlap asked for are pruned. A task finds
   all links of its blocks; what leaves it is their number for each vertex and
   the stars that connect the same vertices. A pair whose blocks meet is not
   met again in 3.
5. Connected components give the classes, the numbers of links the degrees.

Nothing is dropped: every pair above the threshold shares a branch, and each
pair of a branch meets in 3 or in 4, and is counted there once.

Defined results: a text without words has the empty set and links with
nothing; rows that share id and text are one document; a null id belongs to
its component but does not name it; a document links with its exact copies
(another id) and not with itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import lower_words, text_key, written
from tidecast.llm.components import components

#: Part of the hash range whose shingles come first in the order.
LOW = 0.25
#: Vertices of a branch that meet each other without a trie.
FEW = 32
#: Vertices and shingles in a block, about.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 400_000
KEEP_WORDS = 250_000
#: Most numbers that are broadcast to leave out rows before they are dealt by
#: a key: copies of a vertex, texts no vertex needs. Beyond that all are dealt.
KEYS = 4_000_000
#: Most cells in a table of shingles and probes; probes are taken in parts.
CELLS = 32_000_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_HASHES = _Hashes()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the runs of ``k`` words (A-Z
    lower-cased); a shorter text is one run."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.int64)
    if len(_HASHES) > KEEP_WORDS:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    x = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):  # a mixing step for each word
        x = (x ^ h[i:len(h) - width + 1 + i]) * _MIX[0]
        x ^= x >> np.uint64(29)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    x ^= x >> np.uint64(31)
    return np.unique(x >> np.uint64(1)).astype(np.int64)


class Threshold:
    """Similarity of ``num/den`` or more, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n: Column) -> Column:
        """First shingles of a set of n among which a partner shares one."""
        return n - F.ceil(F.lit(self.num) * n / F.lit(self.den)) + F.lit(1)

    def first(self, n: int) -> int:
        """The same for one set."""
        return n + self.num * n // -self.den + 1

    def overlap(self, a, b):
        """Shared shingles that sets of a and b need, at least."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def reaches(self, shared: Column, a: Column, b: Column) -> Column:
        return F.lit(self.den) * shared >= F.lit(self.num) * (a + b - shared)

    def possible(self, n: Column, pos: Column, m: Column, place: Column) -> Column:
        """Length and position bounds of a pair that shares the shingles at
        ``pos`` and ``place`` of their orders."""
        most = F.least(pos, place) + 1 + F.least(n - pos - 1, m - place - 1)
        return (F.lit(self.den) * F.least(n, m) >= F.lit(self.num) * F.greatest(n, m)) & self.reaches(most, n, m)


# ------------------------------------------------------------------ the sets

def shingles(docs: DataFrame, k: int, limit: Threshold) -> DataFrame:
    """v (row number), doc_id, text_key, n, digest, low, high: all rows; of the
    upper hash range only what the prefix of a set short of low ones needs."""
    edge = int(LOW * 2**63)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, k) for t in batch.column("text").to_pylist()]
            cuts = [int(np.searchsorted(s, edge)) for s in found]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found]
            high = [s[c:max(c, limit.first(len(s)))] for s, c in zip(found, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in found], pa.int64()),
                 pa.array(digests, pa.binary()), _lists([s[:c] for s, c in zip(found, cuts)]), _lists(high)],
                names=["doc_id", "text_key", "n", "digest", "low", "high"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(sets, "doc_id long, text_key long, n long, digest binary, low array<long>, high array<long>") \
        .withColumn("v", F.monotonically_increasing_id())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def vertices_of(table: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of the table that stand for their sets. The copies, which are
    fewer, are told by number, so that no lists of shingles are dealt."""
    rows, reps = table.where("n > 0"), first.select(F.col("rep").alias("v"))
    copies = written(rows.select("v").join(reps, "v", "left_anti"), "copies")
    if copies.count() <= KEYS:
        return rows.join(F.broadcast(copies), "v", "left_anti")
    return rows.join(reps, "v")


def prefixes(table: DataFrame, first: DataFrame, limit: Threshold) -> DataFrame:
    """tok, v, n, pos: prefix shingles that may have partners."""
    vertices = vertices_of(table, first)
    # Counted where they stand: a join with the counts would deal the rows twice.
    df = F.count(F.lit(1)).over(Window.partitionBy("tok"))
    shared = vertices.select("v", F.explode("low").alias("tok")).withColumn("df", df).where("df > 1")
    # The shared low shingles of one document: no more than its set.
    lists = shared.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("known"))
    info = vertices.select("v", "n", F.size("low").alias("n_low"), "high") \
        .withColumn("p", limit.prefix(F.col("n")).cast("int"))
    joined = info.join(lists, "v", "left") \
        .withColumn("known", F.coalesce("known", F.array().cast("array<struct<df:bigint,tok:bigint>>"))) \
        .withColumn("alone", F.col("n_low") - F.size("known")).where("alone < p")
    low = F.transform(F.slice("known", F.lit(1), F.col("p") - F.col("alone")),
                      lambda s, i: F.struct(s["tok"].alias("tok"), (F.col("alone") + i).alias("pos")))
    high = F.transform(F.slice("high", F.lit(1), F.greatest(F.col("p") - F.col("n_low"), F.lit(0))),
                       lambda t, i: F.struct(t.alias("tok"), (F.col("n_low") + i).alias("pos")))
    return joined.select("v", "n", F.explode(F.concat(low, high)).alias("x")).select("x.tok", "v", "n", "x.pos")


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """v, s: whole sets of the ``wanted(v, doc_id, text_key)`` vertices, made
    from the texts again rather than kept for all documents. Texts that no
    vertex needs are left out before the rest is dealt by its keys."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), _lists([shingle_set(t, k) for t in batch.column("text").to_pylist()])],
                names=["v", "s"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_key") == F.col("w.text_key"))
    if wanted.count() <= KEYS:
        rows = rows.join(F.broadcast(wanted.select("text_key").distinct()), "text_key", "left_semi")
    found = rows.alias("d").join(wanted.alias("w"), same).select("w.v", "d.text")
    return found.mapInArrow(sets, "v long, s array<long>").dropDuplicates(["v"])


def verified(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) above the threshold, by their whole sets."""
    met = pairs.join(sets.select(F.col("v").alias("b"), F.col("s").alias("sb")), "b") \
        .join(sets.select(F.col("v").alias("a"), F.col("s").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return met.where(limit.reaches(shared, F.size("sa"), F.size("sb"))).select("a", "b")


# ------------------------------------------------------------------ the trie

class Trie:
    """Join of two blocks of ordered sets."""

    def __init__(self, num: int, den: int):
        self.limit = Threshold(num, den)

    def links(self, probes: list[np.ndarray], sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of probes and of sets that link."""
        tokens, counts = np.unique(np.concatenate([*probes, *sets]), return_counts=True)
        common = tokens[counts > 1]
        step = max(1, CELLS // (len(common) + 1))
        found = [(p + k, s) for k in range(0, len(probes), step)
                 for p, s in [self._walk(probes[k:k + step], sets, common)]]
        return np.concatenate([p for p, _ in found]), np.concatenate([s for _, s in found])

    def _walk(self, probes: list[np.ndarray], sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for some probes; ``common`` has every shared shingle."""
        limit, width = self.limit, len(common)

        def number(a: np.ndarray) -> np.ndarray:
            """Row of each shingle in the table; the last row is all zero."""
            at = np.searchsorted(common, a)
            return np.where((at < width) & (common[np.minimum(at, max(width - 1, 0))] == a), at, width) \
                if width else np.full(len(a), 0)

        kind = np.int16 if max(map(len, probes)) < 1 << 15 else np.int32
        holds = np.zeros((width + 1, len(probes)), np.int8)
        for j, p in enumerate(probes):
            at = number(p)
            holds[at[at < width], j] = 1
        sizes = np.array([len(s) for s in sets])
        asked = np.array([len(p) for p in probes])
        depth = int(sizes.max(initial=0))
        flat, begins = np.concatenate(sets), np.cumsum(sizes) - sizes

        # Level by level: each node's overlaps come from its parent's.
        live = np.arange(len(sets))
        node = np.zeros(len(sets), np.int64)
        overlap = np.zeros((1, len(probes)), kind)
        out_p, out_s = [], []
        for level in range(depth):
            ended = sizes[live] == level
            self._report(live[ended], node[ended], overlap, asked, sizes, out_p, out_s)
            live, node = live[~ended], node[~ended]
            if not len(live):
                break
            step = flat[begins[live] + level]
            order = np.lexsort((step, node))
            s_node, s_step = node[order], step[order]
            new = np.concatenate([[True], (s_node[1:] != s_node[:-1]) | (s_step[1:] != s_step[:-1])])
            child = np.cumsum(new) - 1
            overlap = overlap[s_node[new]] + holds[number(s_step[new])]
            live, node = live[order], child
            starts = np.flatnonzero(new)
            left = np.maximum.reduceat(sizes[live], starts) - level - 1
            least = np.minimum.reduceat(sizes[live], starts)
            if level % 8 == 7 or level < 8:
                need = limit.overlap(asked[None, :], least[:, None])
                fit = (overlap + left[:, None] >= need).any(axis=1)
                if not fit.all():
                    stay = fit[node]
                    renumber = np.cumsum(fit) - 1
                    live, node, overlap = live[stay], renumber[node[stay]], overlap[fit]
        self._report(live, node, overlap, asked, sizes, out_p, out_s)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *out_p]), np.concatenate([none, *out_s])

    def _report(self, ended, node, overlap, asked, sizes, out_p, out_s) -> None:
        if len(ended):
            shared = overlap[node].astype(np.int64)
            found = self.limit.den * shared >= self.limit.num * (sizes[ended][:, None] + asked[None, :] - shared)
            s, p = np.nonzero(found)
            out_s.append(ended[s])
            out_p.append(p)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smallest vertex, other vertex) with the components of the links."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            other = np.flatnonzero(label != np.arange(len(ids)))
            return ids[label[other]], ids[other]
        label = new


def block_links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """What the links in ``rows(i, j, side, v, copies, s)``, rows of a pair of
    blocks together, come to: (a, b) that connect the same vertices, and for
    each linked vertex (a, n_near), the documents it links with. A group holds
    two blocks at most."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, key, held = Trie(num, den), None, []

        def solve() -> Iterator[pa.RecordBatch]:
            inner = key[0] == key[1]
            probes = held if inner else [r for r in held if r[0] == 0]
            sets = held if inner else [r for r in held if r[0] == 1]
            if probes and sets:
                p, s = trie.links([r[3] for r in probes], [r[3] for r in sets])
                if inner:
                    p, s = p[p != s], s[p != s]
                vp, vs = np.array([r[1] for r in probes], np.int64), np.array([r[1] for r in sets], np.int64)
                near = [(vp, np.bincount(p, np.array([r[2] for r in sets])[s], len(vp)))]
                if not inner:
                    near.append((vs, np.bincount(s, np.array([r[2] for r in probes])[p], len(vs))))
                low, other = _stars(vp[p], vs[s])
                v = np.concatenate([x[n > 0] for x, n in near])
                n = np.concatenate([n[n > 0] for _, n in near]).astype(np.int64)
                if len(v):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([low, v])), pa.array([*other.tolist(), *[None] * len(v)], pa.int64()),
                         pa.array([*[None] * len(low), *n.tolist()], pa.int64())], names=["a", "b", "n_near"])

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in ("i", "j", "side", "v", "copies")]
            values, ends = batch.column("s").values.to_numpy(), batch.column("s").offsets.to_numpy()
            for r, (i, j, side, v, copies) in enumerate(zip(*cols)):
                if key is not None and key != (i, j):
                    yield from solve()
                    held = []
                key = (i, j)
                held.append((side, v, copies, np.array(values[ends[r]:ends[r + 1]])))
        if held:
            yield from solve()

    return rows.repartition("i", "j").sortWithinPartitions("i", "j") \
        .select("i", "j", "side", "v", "copies", "s").mapInArrow(join, "a long, b long, n_near long")


def blocks(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block of each vertex, pairs of blocks that share a branch) for
    ``members(tok, v, n, size)``. A vertex belongs to its largest branch; a
    branch with many such vertices is salted into blocks of its own, the
    others share blocks."""
    home = members.groupBy("v", "n").agg(F.max(F.struct("size", "tok")).alias("h")) \
        .select("v", "n", F.col("h.tok").alias("home"))
    load = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)
    homes = home.groupBy("home").agg(load.alias("load"))
    shared = homes.where("load < 0.5").agg(F.coalesce(F.ceil(F.sum("load")), F.lit(1)).alias("k")).first()["k"]
    salted = F.xxhash64("home", F.pmod(F.xxhash64("v"), F.ceil("load")))
    of = written(home.join(homes, "home").select(
        "v", F.when(F.col("load") < 0.5, F.pmod(F.xxhash64("home"), F.lit(shared))).otherwise(salted).alias("block")),
        "blocks")
    held = written(members.select("tok", "v").join(of.select("v", "block"), "v").select("tok", "block").distinct(), "held")
    pairs = held.select("tok", F.col("block").alias("i")).join(held.select("tok", F.col("block").alias("j")), "tok") \
        .where("i <= j").select("i", "j").distinct()
    return of, pairs


# ------------------------------------------------------------------ the join

def linked(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, parts, near): rows(v, doc_id, text_key, n, rep, copies) for all
    documents, parts(v, c) for the vertices linked to a smaller one, and
    near(v, n_near), the documents of other vertices that a vertex links with."""
    limit = Threshold(num, den)
    table = written(shingles(docs, k, limit), "shingles")
    first = written(table.where("n > 0").groupBy("digest").agg(
        F.min("v").alias("rep"), F.count_distinct(F.struct("doc_id", "text_key")).alias("copies")), "vertices")
    weight = first.select(F.col("rep").alias("v"), "copies")
    prefix = written(prefixes(table, first, limit), "prefixes")
    several = prefix.groupBy("tok").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(prefix.join(several, "tok"), "branches")
    active = members.select("v").distinct()
    wanted = written(table.select("v", "doc_id", "text_key").join(active, "v"), "wanted")
    sets = written(sets_of(docs, wanted, k), "sets")

    # Larger branches: the trie over blocks.
    of, meeting = blocks(members.where(F.col("size") > FEW))
    meeting = written(meeting, "meeting")
    held = of.join(sets, "v").join(weight, "v").select("block", "v", "copies", "s")
    first_side = meeting.join(held, F.col("i") == F.col("block")).select("i", "j", F.lit(0).alias("side"), "v", "copies", "s")
    second_side = meeting.where("i < j").join(held, F.col("j") == F.col("block")) \
        .select("i", "j", F.lit(1).alias("side"), "v", "copies", "s")
    found = written(block_links(first_side.unionByName(second_side), num, den), "links-trie")

    # Small branches: their pairs, without those whose blocks meet.
    few = members.where(F.col("size") <= FEW).select("tok", "v", "n", "pos")
    other = few.select("tok", *[F.col(x).alias(f"{x}2") for x in ("v", "n", "pos")])
    bounds = limit.possible(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"))
    pairs = few.join(other, "tok").where("v < v2").where(bounds) \
        .select(F.col("v").alias("a"), F.col("v2").alias("b")).distinct()
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    met = both & (F.least("x", "y") == F.col("i")) & (F.greatest("x", "y") == F.col("j"))
    pairs = pairs.join(of.select(F.col("v").alias("a"), F.col("block").alias("x")), "a", "left") \
        .join(of.select(F.col("v").alias("b"), F.col("block").alias("y")), "b", "left") \
        .join(meeting, met, "left_anti").select("a", "b")
    links = written(verified(written(pairs, "pairs"), sets, limit), "links")

    parts = components(links.unionByName(found.where("b is not null").select("a", "b")))
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v")) \
        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = ends.join(weight, "v").select(F.col("u").alias("v"), F.col("copies").alias("n_near")) \
        .unionByName(found.where("b is null").select(F.col("a").alias("v"), "n_near")) \
        .groupBy("v").agg(F.sum("n_near").alias("n_near"))
    rows = table.select("v", "doc_id", "text_key", "n", "digest").join(first, "digest", "left") \
        .withColumn("rep", F.coalesce("rep", "v")).drop("digest")
    return rows, parts, near


def _classes(rows: DataFrame, parts: DataFrame) -> DataFrame:
    return rows.join(parts.withColumnRenamed("v", "rep"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))


def _named(classes: DataFrame) -> DataFrame:
    name = classes.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return classes.join(name, "c")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id linked) of all documents."""
    rows, parts, _ = linked(docs, k, num, den)
    return _named(_classes(rows, parts)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def jaccard_links(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The same with n_links, the number of other documents above the threshold."""
    rows, parts, near = linked(docs, k, num, den)
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("n_near", F.lit(0))
    return _named(_classes(rows, parts)).join(near.withColumnRenamed("v", "rep"), "rep", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", n_links.cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document of each component, the one with the smallest id, with its
    own columns; of rows that share id and text one stays. Rows are told by
    their keys: only those whose id and text others share, or that go, are
    dealt, with their texts; the others, which are most, stay where they are."""
    classes = written(_classes(*linked(docs, k, num, den)[:2]).select("doc_id", "text_key", "c"), "classes")
    keep = classes.groupBy("c").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select("one.*").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_key(F.col("text")).alias("text_key"))
    key = F.xxhash64("doc_id", "text_key")
    counted = classes.select("doc_id", "text_key", F.lit(0).alias("kept")) \
        .unionByName(keep.withColumn("kept", F.lit(1))) \
        .groupBy("doc_id", "text_key").agg(F.sum("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    # A kept key of one row stands here twice: as a row and as kept.
    unsure = written(counted.where("kept = 0 or n > 2").select(key.alias("key")).distinct(), "unsure")
    if unsure.count() > KEYS:
        return _kept_once(rows, keep).select("row.*")
    keyed, few = rows.withColumn("key", key), F.broadcast(unsure)
    return keyed.join(few, "key", "left_anti").select("row.*").unionByName(
        _kept_once(keyed.join(few, "key", "left_semi").drop("key"), keep).select("row.*"))


def _kept_once(rows: DataFrame, keep: DataFrame) -> DataFrame:
    """Of ``rows(row, doc_id, text_key)`` one for each key that ``keep`` has.
    Rows and keys meet in one aggregate, so that texts are dealt once."""
    none = F.lit(None).cast(rows.schema["row"].dataType).alias("row")
    met = rows.withColumn("kept", F.lit(False)).unionByName(
        keep.select(none, "doc_id", "text_key", F.lit(True).alias("kept")))
    return met.groupBy("doc_id", "text_key").agg(F.first("row", True).alias("row"), F.max("kept").alias("kept")) \
        .where("kept and row is not null").select("row")
