"""Periodic runs of words, detected on a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, MIN_EXPONENT * q)`` words that no neighbouring word extends.

1. **Grammar.** The word ids of a text are rewritten by Re-Pair in rounds: in
   each round a pair of neighbouring symbols becomes a nonterminal wherever it
   is more frequent (ties: by a mixed key) than the pairs it overlaps, if that
   leaves it two places at least; until no pair repeats. What is left is joined
   two by two, so that every text has one derivation tree of small height.
2. **Runs of a rule.** For a nonterminal X -> A B only the runs that cross the
   boundary of A and B are looked for, once, at its first place. With four
   periods or more, two of them lie on one side of the boundary: the periods to
   try are the distances from the word at the boundary to its other occurrences
   on that side for which both squares agree (prefix hashes). Both ends follow
   by longest common extensions inside X; each interval is then compared word
   by word.
3. **Derivation places.** The runs of a rule are moved to all its places. A run
   of the text lies whole in the lowest node that holds it, and crosses its
   boundary; pieces that a smaller X cut off lie inside it and are dropped:
   of each period only maximal intervals stay.

All texts of an Arrow batch (in parts of bounded size) go through numpy
together; symbols of different texts are different, so nothing crosses texts.
Work and memory are in proportion to the text times the height of its tree.

Defined results: a null or empty text has no words and no runs (``collapsed``
is the empty string); ties, repeated rows and extra columns change nothing,
as each row is judged by its own text; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_EXPONENT = 4
#: Words of one numpy part (a longer text is a part of its own).
PART_WORDS = 400_000

#: Fixed odd multipliers of the mix that breaks ties and hashes word ids.
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Two primes below 2**31: products of residues stay below 2**62. (Hashes modulo
#: a power of two fail on Thue-Morse words whatever their base.)
PRIMES = (2147483647, 2147483629)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * MIX
    x ^= x >> np.uint64(29)
    x *= ODD
    return x ^ (x >> np.uint64(32))


def _slices(first, count):
    """Index of the slice and value of every element of the slices
    [first, first + count)."""
    which = np.repeat(np.arange(len(first)), count)
    ends = np.cumsum(count)
    return which, np.arange(len(which)) - np.repeat(ends - count, count) + first[which]


class _Nodes:
    """Derivation nodes [start, boundary, end) to examine, and for each the
    places of its rule (positions where the nonterminal derives words)."""

    def __init__(self):
        self.s, self.b, self.e, self.places, self.counts = [], [], [], [], []

    def add(self, s, b, e, places, counts):
        for into, x in zip((self.s, self.b, self.e, self.places, self.counts), (s, b, e, places, counts)):
            into.append(x)

    def arrays(self):
        return [np.concatenate(x) if x else np.zeros(0, np.int64)
                for x in (self.s, self.b, self.e, self.places, self.counts)]


def repair(ids: np.ndarray, doc_ends: np.ndarray) -> _Nodes:
    """The grammar of texts set one after another: ``ids`` of all their words
    (no id is used by two texts) and the position after each text's last word.
    Returns the boundaries to examine: of each rule once, with its places."""
    nodes = _Nodes()
    n = len(ids)
    sym = ids.astype(np.int64)
    start = np.arange(n + 1)
    last = np.zeros(n, bool)
    last[doc_ends[doc_ends > 0] - 1] = True
    fresh = int(sym.max()) + 1 if n else 0
    # A pair with a word that its text has once cannot repeat.
    again = np.bincount(ids, minlength=fresh)[sym] > 1 if n else last
    active = ~last & again
    active[:-1] &= again[1:]
    while True:
        at = np.flatnonzero(active)
        if not len(at):
            break
        keys = sym[at] * fresh + sym[at + 1]
        order = np.argsort(keys)
        new = np.ones(len(at), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        first = np.flatnonzero(new)
        count = np.diff(np.concatenate([first, [len(at)]]))
        often = count >= 2
        first, count = first[often], count[often]
        # Rank of each repeated pair: by count, ties by the mixed key.
        by = np.lexsort((_mix(keys[order[first]]), count))
        rank = np.empty(len(first), np.int64)
        rank[by] = np.arange(1, len(first) + 1)
        which, place = _slices(first, count)
        level = np.zeros(len(sym) + 2, np.int32)
        level[at[order[place]] + 1] = rank[which]
        own, left, right = level[1:-1], level[:-2], level[2:]
        # Every other place of a stretch of overlapping equal pairs.
        live = np.flatnonzero(own)
        place = np.arange(len(live))
        begins = own[live] != left[live]
        offset = place - np.maximum.accumulate(np.where(begins, place, 0))
        at_chosen = live[(offset % 2 == 0) & (left[live] <= own[live]) & (right[live] <= own[live])]
        by_rank = own[at_chosen]
        uses = np.bincount(by_rank, minlength=len(rank) + 1)
        at_chosen = at_chosen[uses[by_rank] >= 2]
        active = own > 0
        if not len(at_chosen):
            break
        order = np.argsort(own[at_chosen], kind="stable")
        grouped = at_chosen[order]
        ranks = own[grouped]
        first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
        counts = np.diff(np.concatenate([first, [len(grouped)]]))
        rep = grouped[first]
        nodes.add(start[rep], start[rep + 1], start[rep + 2], start[grouped], counts)
        sym[grouped] = fresh + np.repeat(np.arange(len(rep)), counts)
        fresh += len(rep)
        last[at_chosen] = last[at_chosen + 1]
        near = np.concatenate([at_chosen, at_chosen[at_chosen > 0] - 1])
        active[near] = True
        keep = np.ones(len(sym), bool)
        keep[at_chosen + 1] = False
        sym, last, active = sym[keep], last[keep], active[keep] & ~last[keep]
        start = start[np.concatenate([keep, [True]])]
        if fresh >= 1 << 31:  # keep pair keys below 2**62
            used, sym = np.unique(sym, return_inverse=True)
            fresh = len(used)
    # What no rule covers: neighbours joined two by two, level by level.
    while len(sym) and not last.all():
        place = np.arange(len(last))
        begins = np.concatenate([[True], last[:-1]])
        offset = place - np.maximum.accumulate(np.where(begins, place, 0))
        at = np.flatnonzero((offset % 2 == 0) & ~last)
        nodes.add(start[at], start[at + 1], start[at + 2], start[at], np.ones(len(at), np.int64))
        last[at] = last[at + 1]
        keep = np.ones(len(last), bool)
        keep[at + 1] = False
        last, sym = last[keep], sym[keep]
        start = start[np.concatenate([keep, [True]])]
    return nodes


class _Words:
    """Equality of stretches of words by prefix hashes, and occurrences."""

    def __init__(self, ids: np.ndarray, attempt: int):
        self.ids, n = ids, len(ids)
        self.hashes = []
        for k, prime in enumerate(PRIMES):
            base = int(_mix(np.array([1000 * attempt + k + 1]))[0]) % (prime - 1000) + 500
            powers, size, top = np.ones(n + 1, np.int64), 1, base
            while size <= n:
                more = min(size, n + 1 - size)
                powers[size:size + more] = powers[:more] * top % prime
                size, top = size * 2, top * top % prime
            values = (_mix(ids + (1 + k)) >> np.uint64(33)).astype(np.int64) % prime
            sums = np.zeros(n + 1, np.int64)
            np.cumsum(values * powers[:n] % prime, out=sums[1:])
            self.hashes.append((prime, powers, sums % prime))
        self.order = np.argsort(ids, kind="stable")
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)

    def equal(self, a, b, size):
        """Whether [a, a+size) and [b, b+size) agree, for a <= b."""
        same = True
        for prime, powers, sums in self.hashes:
            left = (sums[a + size] - sums[a]) % prime * powers[b - a] % prime
            same = same & (left == (sums[b + size] - sums[b]) % prime)
        return same

    def forward(self, a, b, limit):
        """Length of the longest common extension of [a.. and [b.., at most limit."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(a, b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def backward(self, a, b, limit):
        """The same for stretches that end before a and b."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.equal(a - mid, b - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


#: Candidate periods that are examined together.
CANDIDATES = 500_000


def _crossing(words: _Words, s, b, e):
    """(node, left, right, period) of the runs that cross the boundary b of
    the nodes [s, e), cut to the node."""
    found = []
    n = len(words.ids)
    order, rank, ids = words.order, words.rank, words.ids
    for side in ("right", "left"):
        # Occurrences of the word at the boundary up to half the side away.
        here = b if side == "right" else b - 1
        reach = (e - b) // 2 if side == "right" else (b - s) // 2
        if side == "right":
            near = order[np.minimum(rank[here] + 1, n - 1)]
            some = np.flatnonzero((near > here) & (near <= here + reach) & (ids[near] == ids[here]))
        else:
            near = order[np.maximum(rank[here] - 1, 0)]
            some = np.flatnonzero((near < here) & (near >= here - reach) & (ids[near] == ids[here]))
        if not len(some):
            continue
        # The slice of the occurrence list: by bisection, as it is sorted.
        h, limit = here[some], reach[some]
        low, high = rank[h], (np.minimum(rank[h] + limit, n - 1) if side == "right" else np.maximum(rank[h] - limit, 0))
        step = 1 if side == "right" else -1
        inside, outside = low.copy(), high.copy()
        while True:
            open_ = np.abs(outside - inside) > 0
            if not open_.any():
                break
            mid = (inside + outside + step) // 2 if side == "right" else (inside + outside) // 2
            p = order[mid]
            good = (ids[p] == ids[h]) & (np.abs(p - h) <= limit) & ((p - h) * step >= 0)
            inside, outside = np.where(open_ & good, mid, inside), np.where(open_ & ~good, mid - step, outside)
        count = np.abs(inside - low)
        first = low + 1 if side == "right" else inside
        done = np.cumsum(count)
        part = 0
        while part < len(some):
            base = done[part - 1] if part else 0
            to = max(part + 1, int(np.searchsorted(done, base + CANDIDATES, side="right")))
            which, at = _slices(first[part:to], count[part:to])
            node = some[part:to][which]
            q = np.abs(order[at] - here[node])
            part = to
            bb, ss, ee = b[node], s[node], e[node]
            a1 = bb if side == "right" else bb - 2 * q
            # A second word first: it drops nearly all chance meetings.
            probe = np.minimum(1, q - 1)
            ok = ids[a1 + probe] == ids[a1 + q + probe]
            node, q, bb, ss, ee, a1 = (x[ok] for x in (node, q, bb, ss, ee, a1))
            ok = words.equal(a1, a1 + q, q)
            node, q, bb, ss, ee, a1 = (x[ok] for x in (node, q, bb, ss, ee, a1))
            if not len(node):
                continue
            left = a1 - words.backward(a1, a1 + q, a1 - ss)
            right = a1 + q + words.forward(a1, a1 + q, ee - a1 - q)
            ok = (right - left >= np.maximum(MIN_WORDS, MIN_EXPONENT * q)) & (left < bb) & (right > bb)
            found.append(np.stack([node[ok], left[ok], right[ok], q[ok]]))
    if not found:
        return np.zeros((4, 0), np.int64)
    found = np.concatenate(found, axis=1)
    # Multiples of a period give the same interval: the smallest is kept.
    found = found[:, np.lexsort((found[3], found[2], found[1], found[0]))]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:3, 1:] != found[:3, :-1]).any(axis=0)
    return found[:, new]


def _exact(ids, s, e, left, right, q):
    """Whether the interval has period q and ends where it says, word by word."""
    if (ids[left:right - q] != ids[left + q:right]).any():
        return False
    return (left == s or ids[left - 1] != ids[left - 1 + q]) and (right == e or ids[right] != ids[right - q])


def runs_of(ids: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period."""
    empty = (np.zeros(0, np.int64),) * 3
    if len(ids) < MIN_WORDS:
        return empty
    s, b, e, places, counts = repair(ids, doc_ends).arrays()
    if not len(s):
        return empty
    for attempt in itertools.count():
        node, left, right, q = _crossing(_Words(ids, attempt), s, b, e)
        if all(_exact(ids, s[k], e[k], l, r, p) for k, l, r, p in zip(node, left, right, q)):
            break  # else hashes met by chance: again with other bases
    if not len(node):
        return empty
    first = np.cumsum(counts) - counts
    which, at = _slices(first[node], counts[node])
    shift = places[at] - s[node[which]]
    l, r, q = left[which] + shift, right[which] + shift, q[which]
    # Maximal intervals of each period.
    order = np.lexsort((-r, l, q))
    l, r, q = l[order], r[order], q[order]
    span = len(ids) + 1
    group = np.cumsum(np.concatenate([[0], q[1:] != q[:-1]])) * span
    reach = np.maximum.accumulate(group + r)
    keep = np.ones(len(l), bool)
    keep[1:] = (group + r)[1:] > reach[:-1]
    l, r, q = l[keep], r[keep], q[keep]
    order = np.lexsort((q, l))
    return l[order], r[order], q[order]


def _part(words: list[list[bytes]]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed text of each list of words."""
    ids, ends, used = [], [], 0
    for own in words:
        number = dict.fromkeys(own)
        for k, w in enumerate(number, used):
            number[w] = k
        used += len(number)
        ids.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
        ends.append(len(own))
    ends = np.cumsum(ends, dtype=np.int64)
    l, r, q = runs_of(np.concatenate(ids) if ids else np.zeros(0, np.int64), ends)
    cuts = np.searchsorted(l, np.concatenate([[0], ends]))
    out = []
    for k, own in enumerate(words):
        a, z = cuts[k], cuts[k + 1]
        base = int(ends[k - 1]) if k else 0
        found = [(int(l[i]) - base, int(r[i] - l[i]), int(q[i])) for i in range(a, z)]
        if found:
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, [x + p for x, _, p in found], 1)
            np.add.at(edge, [x + m for x, m, _ in found], -1)
            own = [w for w, gone in zip(own, (np.cumsum(edge) > 0).tolist()) if not gone]
        out.append((found, b" ".join(own).decode("utf-8")))
    return out


def detect(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], str, int]]:
    """(runs, collapsed text, number of words) of each text, in parts of
    about ``PART_WORDS`` words."""
    out, part, size = [], [], 0
    lengths = []

    def flush():
        out.extend(_part(part))
        part.clear()

    for t in texts:
        own = t.encode("utf-8").split() if t else []
        lengths.append(len(own))
        if part and size + len(own) > PART_WORDS:
            flush()
            size = 0
        part.append(own)
        size += len(own)
    flush()
    return [(found, text, n) for (found, text), n in zip(out, lengths)]


def periodic(text: Column) -> Column:
    """Struct of the number of words, the runs by start and period, and the
    text without the words that a run holds after its first period."""
    @F.pandas_udf(f"n_words long, runs {RUNS}, collapsed string")
    def of(text: pd.Series) -> pd.DataFrame:
        found = detect([t if isinstance(t, str) else None for t in text])
        return pd.DataFrame({
            "n_words": [n for _, _, n in found],
            "runs": [[{"start": s, "length": m, "period": q} for s, m, q in runs] for runs, _, _ in found],
            "collapsed": [text for _, text, _ in found]})

    return of.asNondeterministic()(text)


def with_runs(docs: DataFrame, out: str = "periodic", text: Column | None = None) -> DataFrame:
    """``docs`` with a struct column ``out`` (see :func:`periodic`)."""
    return docs.withColumn(out, periodic(F.col("text") if text is None else text))


def best_run(runs: Column) -> Column:
    """The run with the greatest exact length / period (ties: smallest start,
    then period); null without runs."""
    def better(a: Column, b: Column) -> Column:
        x, y = b["length"] * a["period"], a["length"] * b["period"]
        # Runs come by start and period, so an equal one is no better.
        return F.when(a.isNull() | (x > y), b).otherwise(a)

    return F.reduce(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def planted(doc_id: Column, text: Column) -> Column:
    """The text as the digest of the registered query asks for it: with h the
    crc32 of the id, g = floor(h / 10), a = g % n and p = 1 + floor((n - a) /
    (3 + g % 8)), word i >= a becomes word a + (i - a) % p where h % 10 = 0."""
    @F.pandas_udf("string")
    def repeat(h: pd.Series, text: pd.Series) -> pd.Series:
        out = []
        for crc, t in zip(h, text):
            own = t.encode("utf-8").split() if isinstance(t, str) and crc % 10 == 0 else []
            if own:
                g, n = int(crc) // 10, len(own)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                t = b" ".join(own[:a] + (own[a:a + p] * (1 + (n - a) // p))[:n - a]).decode("utf-8")
            out.append(t)
        return pd.Series(out, dtype=object)

    return repeat.asNondeterministic()(F.coalesce(F.crc32(doc_id.cast("string")), F.lit(1)), text)
