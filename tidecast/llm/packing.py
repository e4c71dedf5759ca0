"""Packing documents into sequences: cutting stock by column generation.

1. Each document becomes pieces: as many full sequences as it fills, and a
   remainder shorter than one.
2. The remainders are counted by length, rounded up to ``unit`` tokens. This
   histogram has ``capacity / unit`` rows however many documents there are.
3. On the histogram a linear program chooses patterns (how many pieces of
   which lengths fill one sequence). Columns are generated: a knapsack
   dynamic program over the dual prices finds the best new pattern until the
   bound of Farley proves the solution within ``GAP`` of the optimum.
4. Pattern counts are rounded down; the few pieces left over (at most one
   sequence for each pattern in the basis) are packed best-fit decreasing.
5. Pieces are ranked within their length, in salted groups whose size does
   not grow with the input; the rank selects pattern, copy and place by
   arithmetic. Only (length, rank) rows move, never token ids.

Defined results: a null or empty text is one piece that holds the end token;
equal rows are all packed, each on its own; an empty table packs into nothing.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import encoder, written

CAPACITY = 4096
UNIT = 8
END_ID = 2
#: The linear program stops this close to its optimum.
GAP = 0.004
#: Pieces in a ranking group, about.
GROUP_ROWS = 50_000

PIECE = "start long, length long, ids_crc32 long, ids binary"
PLAN_SCHEMA = "size int, low long, high long, each int, first_sequence long, place int"


# ------------------------------------------------------------ the histogram

def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most value that fits (each size as often as wanted), and its counts."""
    best = np.zeros(room + 1)
    taken = np.full(room + 1, -1)
    for c in range(int(sizes[0]), room + 1):
        k = int(np.searchsorted(sizes, c, side="right"))
        reach = best[c - sizes[:k]] + values[:k]
        i = int(reach.argmax())
        if reach[i] > best[c - 1]:
            best[c], taken[c] = reach[i], i
        else:
            best[c] = best[c - 1]
    counts = np.zeros(len(sizes), np.int64)
    c = room
    while c > 0:
        if taken[c] < 0 or best[c] == best[c - 1]:
            c -= 1
        else:
            counts[taken[c]] += 1
            c -= int(sizes[taken[c]])
    return float(best[room]), counts


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, by revised simplex with generated
    columns. Rounding errors cost some padding at most: ``plan`` counts the
    pieces themselves. (No threaded linear algebra: this runs on the driver.)"""
    m = len(sizes)
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    # Slightly uneven demands keep the simplex from standing still.
    demand = demand * (1 + 1e-7 * np.arange(1, m + 1) / m)
    used = np.einsum("ij,j->i", inverse, demand)
    proven = 0.0
    for _ in range(20 * m):
        prices = inverse.sum(axis=0)
        value, column = knapsack(np.maximum(prices, 0), sizes, room)
        proven = max(proven, used.sum() / value)
        if value <= 1 + 1e-9 or used.sum() <= max((1 + gap) * proven, proven + 0.5):
            break
        direction = np.einsum("ij,j->i", inverse, column.astype(float))
        ratio = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        used = used - ratio[leave] * direction
        used[leave] = ratio[leave]
        basis[:, leave] = column
        row = inverse[leave] / direction[leave]
        inverse -= direction[:, None] * row
        inverse[leave] = row
    return [(basis[:, k].astype(np.int64), float(used[k])) for k in range(m)]


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Best-fit decreasing for the pieces that rounding left over."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    for size in sorted(sizes, reverse=True):
        fit = next((r for r in range(size, room) if by_room.get(r)), None)
        if fit is None:
            bins.append([])
            at, fit = len(bins) - 1, room
        else:
            at = by_room[fit].pop()
        bins[at].append(size)
        by_room.setdefault(fit - size, []).append(at)
    return bins


def plan(histogram: dict[int, int], room: int) -> list[tuple[Counter, int]]:
    """(sizes in a sequence, number of such sequences) that together hold the
    histogram exactly. ``room`` and the sizes are in units."""
    left = {s: n for s, n in histogram.items() if n}
    out: list[tuple[Counter, int]] = []
    if left:
        sizes = np.array(sorted(left), np.int64)
        demand = np.array([left[s] for s in sizes.tolist()], float)
        for counts, times in solve(sizes, demand, room):
            times = int(times + 1e-6)
            pattern = Counter({int(s): int(c) for s, c in zip(sizes, counts) if c})
            if pattern:
                times = min([times, *(left[s] // c for s, c in pattern.items())])
            if times > 0:
                out.append((pattern, times))
                for s, c in pattern.items():
                    left[s] -= c * times
    rest = Counter(tuple(b) for b in best_fit([s for s, n in left.items() for _ in range(n)], room))
    out += [(Counter(b), n) for b, n in sorted(rest.items())]
    return out


def plan_rows(patterns: list[tuple[Counter, int]]) -> list[tuple]:
    """For each pattern and size: the ranks it takes and where they go."""
    taken: Counter = Counter()
    out, sequence = [], 0
    for pattern, times in patterns:
        place = 0
        for size, each in sorted(pattern.items(), reverse=True):
            out.append((size, taken[size], taken[size] + each * times, each, sequence, place))
            taken[size] += each * times
            place += each
        sequence += times
    return out


# -------------------------------------------------------------- on documents

def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
        keep_ids: bool = False) -> DataFrame:
    """doc_id, doc_tokens and the pieces of each document (start, length,
    ids_crc32 and, if wanted, ids: little-endian unsigned 32-bit)."""
    end = int(end_id).to_bytes(4, "little")

    @F.pandas_udf(f"array<struct<{PIECE.replace(' long', ':long').replace(' binary', ':binary').replace(', ', ',')}>>")
    def pieces(text: pd.Series) -> pd.Series:
        out = []
        for ids in encoder(vocabulary).encode(list(text)):
            ids += end
            out.append([{"start": k // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part),
                         "ids": part if keep_ids else None}
                        for k in range(0, len(ids), 4 * capacity) for part in [ids[k:k + 4 * capacity]]])
        return pd.Series(out)

    found = docs.select("doc_id", pieces.asNondeterministic()("text").alias("pieces"))
    last = F.element_at("pieces", -1)
    return found.withColumn("doc_tokens", last["start"] + last["length"]) \
        .select("doc_id", "doc_tokens", F.explode("pieces").alias("piece")) \
        .select("doc_id", "doc_tokens", "piece.*") \
        .drop(*([] if keep_ids else ["ids"]))


def _size(length: Column, unit: int) -> Column:
    return F.ceil(length / F.lit(unit)).cast("int")


def ranked(pieces: DataFrame, total: int, unit: int) -> DataFrame:
    """``pieces`` with ``size`` and ``rank`` (gapless from 0 within the size).
    Ranks are counted in salted groups and shifted by the rows of the groups
    before, so a very common size is not one task's work."""
    salts = max(1, -(-total // GROUP_ROWS))
    keyed = pieces.withColumn("size", _size(F.col("length"), unit)) \
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = keyed.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("salt")
                             .rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("size", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "start", "ids_crc32"))
    return keyed.withColumn("own", own).join(groups, ["size", "salt"]) \
        .withColumn("rank", F.col("before") + F.col("own") - 1).drop("own", "before", "salt")


def pack(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """``pieces(doc_id, start, length, ids_crc32, ...)``, which must be a
    stored table, with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    room = capacity // unit
    histogram = {r["size"]: r["n"] for r in
                 pieces.groupBy(_size(F.col("length"), unit).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(histogram.values())
    full = histogram.pop(room, 0)
    patterns = plan(histogram, room)
    if full:
        patterns.append((Counter({room: 1}), full))
    # At most a few patterns for each of the capacity / unit sizes: broadcast.
    steps = F.broadcast(spark.createDataFrame(plan_rows(patterns), PLAN_SCHEMA).withColumnRenamed("size", "step_size"))
    rows = ranked(pieces, total, unit)
    placed = rows.join(steps, (F.col("size") == F.col("step_size")) & (F.col("rank") >= F.col("low"))
                       & (F.col("rank") < F.col("high"))) \
        .withColumn("sequence_id", F.expr("first_sequence + (rank - low) div each")) \
        .withColumn("place", F.expr("place + (rank - low) % each"))
    # A sequence holds at most ``capacity`` pieces.
    so_far = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("place")
                                  .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(so_far, F.lit(0))) \
        .drop("step_size", "low", "high", "each", "first_sequence", "place", "size", "rank")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, unit: int = UNIT,
                   end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset; tokenized once."""
    return pack(written(cut(docs, vocabulary, capacity, end_id, keep_ids), "pieces"), capacity, unit)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves, padded to ``capacity``; needs ``keep_ids``.
    A group is one sequence: at most ``capacity`` ids."""
    pad = int(pad_id).to_bytes(4, "little")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")) \
        .withColumn("filled", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))")) \
        .select("sequence_id", "length",
                F.concat("filled", F.expr(f"unhex(repeat('{pad.hex()}', cast({capacity} - length as int)))")).alias("ids"))
