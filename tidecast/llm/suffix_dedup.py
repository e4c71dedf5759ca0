"""Byte-exact substring deduplication by bucket-pointer refinement.

Every byte goes that a string of ``SPAN`` bytes covers which also starts
somewhere else, in the same text or another. Suffixes are not sorted byte by
byte: they stand in buckets of equal beginnings, and buckets are refined by the
bucket identifiers of later offsets.

* **Identifiers.** The bucket of the first 2k bytes at a position is named by
  the buckets of the first k bytes there and k bytes later; the names of one
  round are reused by the next (1, 2, 4 ... 128 bytes; longer strings by
  overlapping blocks of 128). Inside a text all positions are named in numpy.
* **Positions.** Each window of ``SPAN`` bytes is looked at from one position:
  the q-gram of smallest identifier in it (leftmost on ties). Equal windows
  choose the same place, and neighbours mostly agree on it, so about one
  position in 85 stands for all windows that chose it.
* **Refinement.** Round 1: positions meet by their initial bucket, the q-gram.
  Alone in it: no window of this position repeats. Members whose whole contexts
  (all bytes of all their windows) are equal: all their windows repeat. What is
  left goes on with longer strings: round 2 has buckets of 32 windows with
  the bytes common to them, round 3 has single windows. A context that repeats
  sends one member on, as a witness for contexts that share only a part of it.

A round is one shuffle of fixed-width rows by bucket; buckets with a large share
of all rows (a sketch names at most 200) are counted by partial aggregates and
joined back under adaptive skew handling, so copies in a third of all rows meet
in no single task. Only texts' identifiers and undecided contexts (at most 368
bytes) are shuffled, and the compressed texts when contexts are read and when
bytes are cut. Repeats inside one text are settled there.

Names are 64 bits, a bucket and a context under two independent functions: two
different contexts would have to agree in both to be taken for equal.

Defined results: a null or empty text, or one below ``SPAN`` bytes, loses
nothing; a repeated row is a text of its own, so both lose all their windows;
null ids are ids like any other; only ``doc_id`` and ``text`` are read, so other
columns of any name do no harm; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecast.llm.common import hot_keys, text_key, written
from tidecast.operators.joins import null_safe_join

SPAN = 200
#: Bytes of the initial buckets.
Q = 32
#: Places that a window can choose.
CHOICES = SPAN - Q + 1
#: Windows of one bucket of the second round, and the bytes they share.
CELL = 32
CORE = SPAN - CELL + 1
BLOCK = 128
#: Bytes of texts that numpy names at once; longer texts are cut (with overlap).
PART = 1 << 18
LONGEST = 1 << 22

#: Fixed odd multipliers of the two naming functions.
_A = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_B = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0x94D049BB133111EB))


def _named(first: np.ndarray, later: np.ndarray, by) -> np.ndarray:
    """The name of a bucket from those at its beginning and at a later offset."""
    x = first * by[0]
    x += later
    x ^= x >> np.uint64(32)
    x *= by[1]
    return x


def names(t: np.ndarray, by, size: int) -> np.ndarray:
    """Names of the strings of ``size`` (a power of two) bytes at all positions."""
    x = _named((np.arange(256, dtype=np.uint64) + np.uint64(1)) * by[1], np.full(256, size > 0, np.uint64), by)[t]
    k = 1
    while k < size:
        x = _named(x[:-k], x[k:], by)
        k *= 2
    return x


def _blocks(x: np.ndarray, start, length, by) -> np.ndarray:
    """Names of strings of BLOCK to 3 * BLOCK bytes: their first, middle and last block."""
    out = _named(x[start], x[start + (length - BLOCK) // 2], by)
    return _named(_named(out, x[start + length - BLOCK], by), np.asarray(length).astype(np.uint64), by)


def positions(t: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(bucket, context, first window, windows, offset of the position in it) of
    every position that windows of the texts [starts, ends) of ``t`` choose."""
    empty = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(t) < SPAN:
        return empty
    bucket = names(t, _A, Q)
    best = ((bucket * _B[0]) >> np.uint64(24) << np.uint64(24)) | np.arange(len(bucket), dtype=np.uint64)
    k = 1
    while 2 * k <= CHOICES:
        best = np.minimum(best[:-k], best[k:])
        k *= 2
    best = np.minimum(best[:len(best) - (CHOICES - k)], best[CHOICES - k:])
    chosen = (best & np.uint64((1 << 24) - 1)).astype(np.int64)
    edge = np.zeros(len(t) + 1, np.int64)
    whole = ends - starts >= SPAN
    np.add.at(edge, starts[whole], 1)
    np.add.at(edge, ends[whole] - SPAN + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:len(chosen)]))
    if not len(window):
        return empty
    at = chosen[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate([first, [len(window)]]))
    at, start = at[first], window[first]
    context = _named(_blocks(names(t, _B, BLOCK), start, n - 1 + SPAN, _B), (at - start).astype(np.uint64), _B)
    return bucket[at].view(np.int64), context.view(np.int64), start, n, at - start


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal ones."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.concatenate([first[1:], [len(end)]]) - 1] if len(end) else end


def _spans(counts: list[int], start: np.ndarray, end: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["a", "z"]))


_SPANS = "array<struct<a:bigint,z:bigint>>"


def _schema(df: DataFrame, kept: int, added: str) -> StructType:
    """The first ``kept`` columns of ``df`` and those ``added``."""
    return StructType([*df.schema.fields[:kept], *StructType.fromDDL(added).fields])


#: place: first window << 17 | windows << 9 | offset of the position << 1.
_PLACE = "bucket:bigint,context:bigint,place:bigint,n:int"


def _marks(texts: list[str | None]) -> tuple[list[int], list[tuple], list[tuple]]:
    """For each text: bytes, merged spans that repeat inside it, and its
    positions (one for each distinct bucket and context, with n = 2 if the text
    has it twice)."""
    data = [t.encode("utf-8") if t else b"" for t in texts]
    own, found = [None] * len(data), [None] * len(data)

    def settle(i: int, rows) -> None:
        bucket, context, start, n, offset = rows
        order = np.lexsort((context, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (bucket[order][1:] != bucket[order][:-1]) | (context[order][1:] != context[order][:-1])
        first = np.flatnonzero(new)
        uses = np.diff(np.concatenate([first, [len(order)]]))
        again = order[np.repeat(uses > 1, uses)]
        own[i] = merged(start[again], start[again] + n[again] - 1 + SPAN)
        rep = order[first]
        found[i] = (bucket[rep], context[rep], start[rep] << 17 | n[rep] << 9 | offset[rep] << 1, np.minimum(uses, 2))

    def name_all(part: list[int]) -> None:
        ends = np.cumsum([len(data[i]) for i in part])
        starts = ends - [len(data[i]) for i in part]
        rows = positions(np.frombuffer(b"".join([data[i] for i in part]), np.uint8), starts, ends)
        cuts = np.searchsorted(rows[2], np.concatenate([starts, ends[-1:]]))
        for k, i in enumerate(part):
            mine = [x[cuts[k]:cuts[k + 1]] for x in rows]
            mine[2] = mine[2] - starts[k]
            settle(i, mine)

    part, size = [], 0
    for i, d in enumerate(data):
        if len(d) > LONGEST:  # windows of one slice after the other
            slices = []
            for a in range(0, len(d) - SPAN + 1, LONGEST):
                t = np.frombuffer(d[a:a + LONGEST + SPAN - 1], np.uint8)
                rows = list(positions(t, np.array([0]), np.array([len(t)])))
                rows[2] = rows[2] + a
                slices.append(rows)
            settle(i, [np.concatenate(x) for x in zip(*slices)])
            continue
        if part and size + len(d) > PART:
            name_all(part)
            part, size = [], 0
        part.append(i)
        size += len(d)
    if part:
        name_all(part)
    return [len(d) for d in data], own, found


def marks(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, own, positions) of every text: ``row`` numbers
    the rows, ``own`` holds the spans that repeat inside the text."""
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                        text_key(F.col("text")).alias("text_key"), "text")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, own, found = _marks(batch.column(3).to_pylist())
            spans = _spans([len(a) for a, _ in own], *[np.concatenate([x[k] for x in own]) for k in (0, 1)])
            flat = [np.concatenate([x[k] for x in found]) for k in range(4)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]), pa.int32())
            rows = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                [pa.array(flat[k], pa.int32() if k == 3 else pa.int64()) for k in range(4)],
                ["bucket", "context", "place", "n"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), spans, rows],
                                             ["row", "doc_id", "text_key", "own", "positions"])

    return keyed.mapInArrow(name, _schema(keyed, 3, f"own {_SPANS}, positions array<struct<{_PLACE}>>"))


def refined(rows: DataFrame) -> DataFrame:
    """One round. ``rows(bucket, context, row, place, n)`` -> those that are not
    alone in their bucket, with ``again`` (the context repeats), ``open``
    (the bucket has other contexts) and ``lead`` (first of its context)."""
    here = F.struct("row", "place")
    hot = hot_keys(rows, "bucket")
    often = F.col("bucket").isin(hot)
    bucket = Window.partitionBy("bucket")
    context = Window.partitionBy("bucket", "context")
    cold = (rows.where(~often) if hot else rows).repartition("bucket") \
        .withColumn("same", F.sum("n").over(context)).withColumn("first", F.min(here).over(context)) \
        .withColumn("total", F.sum("n").over(bucket))
    if hot:
        hot_rows = rows.where(often)
        same = hot_rows.groupBy("bucket", "context").agg(F.sum("n").alias("same"), F.min(here).alias("first"))
        total = same.groupBy("bucket").agg(F.sum("same").alias("total"))  # at most 200 buckets
        counted = same.join(F.broadcast(total), "bucket")
        cold = cold.unionByName(hot_rows.join(counted, ["bucket", "context"]).select(*cold.columns))
    return cold.where("total > 1").select("row", "place", "n", (F.col("same") > 1).alias("again"),
                                          (F.col("total") > F.col("same")).alias("open"),
                                          (here == F.col("first")).alias("lead"))


def _onward(found: DataFrame) -> DataFrame:
    """What the next round looks at: contexts that are alone, and one witness of
    each that repeats, where the bucket has others."""
    return found.where("open and (not again or lead)") \
        .withColumn("n", F.when(F.col("again"), 2).otherwise(1))


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, packed): texts compressed, for shuffles."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = [press.compress((t or "").encode("utf-8")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                                             ["doc_id", "text_key", "packed"])

    return keyed.mapInArrow(press, _schema(keyed, 2, "packed binary"))


_CONTEXTS = "row bigint, place bigint, n int, bytes binary"


def contexts(docs: DataFrame, ids: DataFrame, found: DataFrame) -> DataFrame:
    """The bytes of the windows of each undecided position."""
    wanted = found.groupBy("row").agg(F.collect_list(F.struct("row", "place", "n")).alias("wanted"))
    wanted = wanted.join(ids, "row").groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("wanted")).alias("wanted"))
    met = null_safe_join(packed(docs), wanted, ["doc_id", "text_key"], "inner").select("packed", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for data, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = press.decompress(data)
                for x in wanted:
                    start, n = x["place"] >> 17, x["place"] >> 9 & 255
                    out.append((x["row"], x["place"], x["n"], data[start:start + n - 1 + SPAN]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["row", "place", "n", "bytes"])

    return met.mapInArrow(cut, _CONTEXTS)


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and value of every element of the ranges [first, first + count)."""
    which = np.repeat(np.arange(len(first)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]


_ROWS = "bucket bigint, context bigint, row bigint, place bigint, n int"


def _emit(bucket, context, row, place, n) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    columns = (bucket.view(np.int64), context.view(np.int64), row, place, n)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)],
                                      ["bucket", "context", "row", "place", "n"])


def _buffers(batch: pa.RecordBatch):
    """Row, place, n and beginning of each context in one buffer of all."""
    data = batch.column("bytes").to_pylist()
    ends = np.cumsum([len(d) for d in data])
    row, place, n = (batch.column(c).to_numpy() for c in ("row", "place", "n"))
    return np.frombuffer(b"".join(data), np.uint8), ends - [len(d) for d in data], row, place, n


def cells(held: DataFrame) -> DataFrame:
    """Rows of the second round: the windows of a position in cells of ``CELL``
    by their distance d to it; bucket: the bytes that all of a cell share;
    context: all bytes of the position's own windows in the cell. A place is
    now first window of the position << 17 | windows before the cell << 9 |
    windows of the cell."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t, base, row, place, weight = _buffers(batch)
            start, n, offset = place >> 17, place >> 9 & 255, place >> 1 & 255
            low = offset - n + 1  # distances of the last window and the first
            which, cell = _ranges(low // CELL, offset // CELL - low // CELL + 1)
            near = np.maximum(low[which], cell * CELL)
            far = np.minimum(offset[which], cell * CELL + CELL - 1)
            at = base[which] + offset[which]  # of the position
            a, b = names(t, _A, BLOCK), names(t, _B, BLOCK)
            core = at - cell * CELL
            bucket = _named(_named(a[core], a[core + CORE - BLOCK], _A), cell.astype(np.uint64), _A)
            length = far - near + SPAN
            context = _named(_blocks(b, at - far, length, _B), (far << 8 | near).astype(np.uint64), _B)
            within = start[which] << 17 | (offset[which] - far) << 9 | far - near + 1
            yield _emit(bucket, context, row[which], within, weight[which])

    return held.mapInArrow(name, _ROWS)


def windows(held: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the third round: every window of the undecided cells. A place is
    window << 17."""
    start = F.shiftright("place", 17).alias("start")
    wanted = found.groupBy("row", start).agg(F.collect_list(F.struct(
        F.expr("shiftright(place, 9) & 255").alias("before"), F.expr("place & 511").alias("size"), "n")).alias("wanted"))
    met = held.withColumn("start", start).join(wanted, ["row", "start"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t, base, row, place, _ = _buffers(batch)
            of, before, size, n = np.array([
                (k, x["before"], x["size"], x["n"])
                for k, wanted in enumerate(batch.column("wanted").to_pylist()) for x in wanted], np.int64).T
            which, window = _ranges(before, size)
            of = of[which]
            at = base[of] + window
            a, b = names(t, _A, BLOCK), names(t, _B, BLOCK)
            yield _emit(_named(a[at], a[at + SPAN - BLOCK], _A), _named(b[at], b[at + SPAN - BLOCK], _B),
                        row[of], (place[of] >> 17) + window << 17, n[which].astype(np.int32))

    return met.mapInArrow(name, _ROWS)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): the byte spans [a, z) of every text that has
    any, as found by the rounds (they may overlap)."""
    marked = written(marks(docs), "marks")
    ids = marked.select("row", "doc_id", "text_key")
    first = written(refined(marked.select("row", F.explode("positions").alias("p")).select("row", "p.*")), "round")
    held = written(contexts(docs, ids, _onward(first)), "contexts")
    second = written(refined(written(cells(held), "cells")), "round")
    third = refined(written(windows(held, _onward(second)), "windows"))
    at, middle = F.shiftright("place", 17), F.expr("shiftright(place, 9) & 255")

    def settled(found: DataFrame, start: Column, count: Column) -> DataFrame:
        span = F.struct(start.alias("a"), (start + count - 1 + SPAN).alias("z")).alias("span")
        return found.where("again").select("row", span)

    spans = settled(first, at, middle).unionByName(settled(second, at + middle, F.expr("place & 511"))) \
        .unionByName(settled(third, at, F.lit(1))).groupBy("row").agg(F.collect_list("span").alias("spans"))
    own = marked.where(F.size("own") > 0).select("row", F.col("own").alias("spans"))
    return spans.unionByName(own).join(ids, "row").groupBy("doc_id", "text_key") \
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): of every text the maximal removed runs
    [a, z) and the remaining bytes. ``kept`` is binary, as a cut may fall inside
    a character."""
    met = null_safe_join(packed(docs), repeated_spans(docs), ["doc_id", "text_key"]).select("doc_id", "packed", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, starts, ends, kept = [], [], [], []
            for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = press.decompress(data)
                spans = np.array([(x["a"], x["z"]) for x in spans or []], np.int64).reshape(-1, 2)
                a, z = merged(spans[:, 0], spans[:, 1])
                starts.append(a)
                ends.append(z)
                sizes.append(len(data))
                stay = zip([0, *z.tolist()], [*a.tolist(), len(data)])
                kept.append(b"".join([data[x:y] for x, y in stay]) if len(a) else data)
            if sizes:
                spans = _spans([len(a) for a in starts], np.concatenate(starts), np.concatenate(ends))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), spans,
                                                  pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return met.mapInArrow(cut, _schema(met, 1, f"n_bytes bigint, spans {_SPANS}, kept binary"))
