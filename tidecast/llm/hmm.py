"""Hidden Markov language model, trained by Baum-Welch across partitions.

A latent state emits a class of words (``CLASSES`` classes, by a hash of the
word), and the class emits the word with the add-one estimate from the counts
of all training documents:

    P(w | state) = P(class(w) | state) * (c(w) + 1) / (N_class + V_class + 1)

so every word has a probability, unknown ones included. Each text ends with
an end token. The parameters of the states have ``STATES * CLASSES`` numbers
at every input size; the word counts grow with the input and stay on the
executors.

1. Texts are read in chunks of ``CHUNK_CHARS`` characters. A chunk numbers its
   distinct words once; its documents are kept as compressed arrays of these
   numbers and of classes (one table, written once).
2. The chunks' words meet in one shuffle: training counts of each word, sent
   back to the chunks that hold it.
3. Each Baum-Welch round reads the class arrays, runs the scaled forward and
   backward recursions for many documents at a time, and sums the expected
   counts of all tasks.
4. Chunks meet their counts again (a co-group bounded by the chunk), and the
   scaled forward recursion gives the exact likelihood of every text.

Defined results: a null or empty text is the end token alone; a null id is
the empty text for the fold; without training documents all counts are 0 and
the states stay as they began, evenly smoothed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import lower_words, written

STATES = 8
CLASSES = 4096
ROUNDS = 4
SEED = 7
CHUNK_CHARS = 24_000_000
#: Tokens (padded) whose forward variables are held at once.
GROUP_TOKENS = 1_000_000
#: Probability with which a state stays as it is, before training.
STAY = 0.8
#: Added to expected counts of classes and of transitions.
CLASS_PRIOR, MOVE_PRIOR = 0.1, 1.0
#: The end token among the words; no word is empty.
END = b""

ENCODED = ("chunk long, doc_id long, held_out boolean, n_tokens long, ids binary, classes binary, "
           "words array<binary>, counts array<long>")


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _small(values: np.ndarray, kind: str) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _large(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def encode(docs: DataFrame, classes: int = CLASSES, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Rows of two kinds: documents (``words`` null) and, for each chunk, its
    distinct words with their training counts (``ids`` null)."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, index, chars = TaskContext.get().partitionId(), 0, 0
        number: dict[bytes, int] = {}
        rows: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(number)
            class_of = np.fromiter((zlib.crc32(w) % classes for w in words), np.int64, len(words))
            counts = np.zeros(len(words), np.int64)
            for _, held, ids in rows:
                if not held:
                    np.add.at(counts, ids, 1)
            chunk = (part << 24) + index
            for k in range(0, len(rows), 500):
                some = rows[k:k + 500]
                yield pa.RecordBatch.from_pydict({
                    "chunk": [chunk] * len(some), "doc_id": [r[0] for r in some], "held_out": [r[1] for r in some],
                    "n_tokens": [len(r[2]) for r in some], "ids": [_small(r[2], "<u4") for r in some],
                    "classes": [_small(class_of[r[2]], "<u2") for r in some],
                    "words": [None] * len(some), "counts": [None] * len(some)}, schema=schema)
            yield pa.RecordBatch.from_pydict({
                "chunk": [chunk], "doc_id": [None], "held_out": [None], "n_tokens": [None], "ids": [None],
                "classes": [None], "words": [words], "counts": [counts]}, schema=schema)

        schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                            ("n_tokens", pa.int64()), ("ids", pa.binary()), ("classes", pa.binary()),
                            ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
        for batch in batches:
            for doc, held, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = lower_words(text)
                words.append(END)
                rows.append((doc, held, np.array([number.setdefault(w, len(number)) for w in words], np.int64)))
                chars += len(text or "")
                if chars >= chunk_chars:
                    yield from flush()
                    index, chars, number, rows = index + 1, 0, {}, []
        if rows:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       "text").mapInArrow(chunks, ENCODED)


def word_counts(encoded: DataFrame, classes: int = CLASSES) -> DataFrame:
    """chunk, at (the word's number there), class, n (training count over all
    documents) and own (one chunk of each word): one shuffle by word serves
    both the sum and the way back."""
    words = encoded.where("words is not null") \
        .select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")) \
        .select("chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("here")).repartition("word")
    total = words.groupBy("word").agg(F.sum("here").alias("n"), F.min("chunk").alias("owner"))
    return words.join(total, "word").select(
        "chunk", "at", (F.crc32("word") % classes).cast("int").alias("class"), "n",
        (F.col("chunk") == F.col("owner")).alias("own"))


# ------------------------------------------------------------- the recursions

class Model:
    """Start, moves and class emissions of the states."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, class_counts: np.ndarray, states: int, seed: int) -> Model:
        """Smoothed class frequencies with exponential noise, and states that
        tend to stay: from nearly equal states that move evenly, a few rounds
        of Baum-Welch would not part them."""
        rng = np.random.default_rng(seed)
        emit = (class_counts + 1.0) * rng.exponential(1.0, (states, len(class_counts)))
        move = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @classmethod
    def from_counts(cls, counts: np.ndarray, states: int, classes: int) -> Model:
        start = counts[:states] + MOVE_PRIOR
        move = counts[states:states + states * states].reshape(states, states) + MOVE_PRIOR
        emit = counts[states + states * states:].reshape(states, classes) + CLASS_PRIOR
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def groups(arrays: list[np.ndarray], tokens: int = GROUP_TOKENS) -> Iterator[np.ndarray]:
    """Numbers of arrays, longest first, in groups of bounded padded size."""
    order = np.argsort([-len(a) for a in arrays], kind="stable")
    k = 0
    while k < len(order):
        n = max(1, tokens // len(arrays[order[k]]))
        yield order[k:k + n]
        k += n


def padded(arrays: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps x documents) classes and, for each step, the documents left."""
    lengths = np.array([len(arrays[k]) for k in group])
    out = np.zeros((lengths[0], len(group)), np.int64)
    for j, k in enumerate(group):
        out[:lengths[j], j] = arrays[k]
    return out, np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


def forward(model: Model, seen: np.ndarray, left: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Log likelihood of each document; scales and forward variables if kept."""
    emit = np.ascontiguousarray(model.emit.T)
    likelihood = np.zeros(seen.shape[1])
    scales = np.ones(seen.shape)
    kept = np.zeros((*seen.shape, len(model.start))) if keep else None
    alpha = np.broadcast_to(model.start, (seen.shape[1], len(model.start)))
    for t in range(len(seen)):
        n = left[t]
        alpha = (alpha[:n] @ model.move if t else alpha[:n]) * emit[seen[t, :n]]
        scale = alpha.sum(1)
        alpha = alpha / scale[:, None]
        scales[t, :n] = scale
        if keep:
            kept[t, :n] = alpha
    for t in range(0, len(seen), 4096):
        likelihood += np.log(scales[t:t + 4096]).sum(0)
    return likelihood, scales, kept


def expected_counts(model: Model, arrays: list[np.ndarray]) -> np.ndarray:
    """Expected starts, moves and emissions, flat, over all arrays."""
    states, classes = model.emit.shape
    emit = np.ascontiguousarray(model.emit.T)
    start, move = np.zeros(states), np.zeros((states, states))
    emitted = np.zeros((states, classes))
    for group in groups(arrays):
        seen, left = padded(arrays, group)
        _, scales, alpha = forward(model, seen, left, keep=True)
        beta = np.ones((seen.shape[1], states))
        for t in range(len(seen) - 1, -1, -1):
            n = left[t]
            here = alpha[t, :n] * beta[:n]  # state probabilities at t
            if t:
                came = emit[seen[t, :n]] * beta[:n] / scales[t, :n, None]
                move += (alpha[t - 1, :n].T @ came) * model.move
                beta[:n] = came @ model.move.T
            alpha[t, :n] = here
        start += alpha[0].sum(0)
        flat = seen.ravel()
        for s in range(states):  # padding has probability 0
            emitted[s] += np.bincount(flat, weights=alpha[:, :, s].ravel(), minlength=classes)
    return np.concatenate([start, move.ravel(), emitted.ravel()])


def train(encoded: DataFrame, class_counts: np.ndarray, states: int = STATES, rounds: int = ROUNDS,
          seed: int = SEED) -> Model:
    """Baum-Welch over all training documents. A round gathers one vector of
    states * (1 + states + classes) numbers, summed over all tasks."""
    classes = len(class_counts)
    model = Model.first(class_counts, states, seed)
    sc = encoded.sparkSession.sparkContext
    seen = encoded.where("ids is not null and not held_out").select("classes")
    for _ in range(rounds):
        current = sc.broadcast((model.start, model.move, model.emit))  # states * (1 + states + classes) numbers

        def count(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            total, waiting, size = None, [], 0

            def add(total):
                counts = expected_counts(Model(*current.value), waiting)
                return counts if total is None else total + counts

            for batch in batches:
                for data in batch.column(0).to_pylist():
                    waiting.append(_large(data, "<u2"))
                    size += len(waiting[-1])
                    if size >= 2 * GROUP_TOKENS:
                        total, waiting, size = add(total), [], 0
            if waiting:
                total = add(total)
            if total is not None:
                full = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"at": pa.array(full, pa.int32()), "n": pa.array(total[full])})

        summed = seen.mapInArrow(count, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(states * (1 + states + classes))
        counts[summed["at"].to_numpy()] = summed["n"].to_numpy()
        model = Model.from_counts(counts, states, classes)
        current.unpersist()
    return model


SCORES = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, state_score double")


def score_documents(docs: DataFrame, states: int = STATES, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Scores (log10) of all documents: ``base_score`` by add-one word counts,
    ``score`` by the model, ``state_score`` the part of the latent states."""
    encoded = written(encode(docs, classes), "hmm-encoded")
    counts = written(word_counts(encoded, classes), "hmm-counts")
    by_class = np.zeros((classes, 2), np.int64)
    for r in counts.where("own").groupBy("class") \
            .agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).collect():  # ``classes`` rows
        by_class[r["class"]] = r["n"], r["v"]
    model = train(encoded, by_class[:, 0], states, rounds)
    known = encoded.sparkSession.sparkContext.broadcast((by_class, model.start, model.move, model.emit))

    def score(found: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
        by_class, *parameters = known.value
        n_all, v_all = (int(x) for x in by_class.sum(0))
        count = np.zeros(len(numbers), np.int64)
        class_of = np.zeros(len(numbers), np.int64)
        at = numbers["at"].to_numpy()
        count[at], class_of[at] = numbers["n"].to_numpy(), numbers["class"].to_numpy()
        log_count = np.log10(count + 1.0)
        log_word = log_count - np.log10(by_class.sum(1) + 1.0)[class_of]
        ids = [_large(x, "<u4") for x in found["ids"]]
        base = np.array([log_count[x].sum() for x in ids]) - np.log10(n_all + v_all + 1.0) * found["n_tokens"].to_numpy()
        words = np.array([log_word[x].sum() for x in ids])
        n_known = [int((count[x] > 0).sum()) for x in ids]
        state = np.zeros(len(ids))
        arrays = [class_of[x] for x in ids]
        for group in groups(arrays):
            seen, left = padded(arrays, group)
            state[group] = forward(Model(*parameters), seen, left, keep=False)[0] / np.log(10)
        return pd.DataFrame({"doc_id": found["doc_id"], "held_out": found["held_out"], "n_tokens": found["n_tokens"],
                             "n_known": n_known, "train_tokens": n_all, "base_score": base,
                             "score": words + state, "state_score": state})

    # The id travels as text: pandas would make a float of a null among integers.
    texts = encoded.where("ids is not null") \
        .select("chunk", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "n_tokens", "ids")
    return texts.groupBy("chunk").cogroup(counts.select("chunk", "at", "class", "n").groupBy("chunk")) \
        .applyInPandas(score, SCORES).withColumn("doc_id", F.col("doc_id").cast("long"))
