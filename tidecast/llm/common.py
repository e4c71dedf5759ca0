"""What the training-data operators share.

Conventions that every operator of this package keeps:

* Only the columns an operator names (``doc_id``, ``text``) are read by name;
  other columns are ignored by the digests and passed through untouched by
  filters, so extra columns with any name do no harm.
* A null text counts as an empty one unless an operator says otherwise.
* Rows that repeat a ``doc_id`` *and* its text are the same document and all
  get the same result; a null ``doc_id`` is an id like any other.
* Intermediate tables are Parquet below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import checkpoint_dir, scratch_path, ship_code, shuffles_removed

#: ASCII white space, the separators of words.
BLANKS = "\x20\t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows in an Arrow batch: texts can be long, so batches stay small.
ARROW_ROWS = 500

#: Byte table for words of ASCII letters, digits and anything beyond ASCII:
#: A-Z becomes a-z, every other ASCII character a blank.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def prepare(spark: SparkSession) -> None:
    """Ship this package to the executors, name the shared folder and keep
    Arrow batches small enough for long texts."""
    checkpoint_dir(spark)
    ship_code(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses
    read the files, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it holds one in ``HOT_SHARE`` of all rows (so there are at
#: most that many), and ``HOT_LEAST`` rows at least.
HOT_SHARE = 200
HOT_LEAST = 1000


def hot_keys(rows: DataFrame, *keys: str) -> list[int]:
    """Values of the ``keys`` that hold a large share of ``rows``, from a sketch
    of frequent items over all rows: at most ``HOT_SHARE`` for each column.
    The list chooses the way of a join only, never its result."""
    top = [F.expr(f"approx_top_k({k}, {HOT_SHARE}, {50 * HOT_SHARE})").alias(f"top{i}") for i, k in enumerate(keys)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *top).first()
    least = max(found["n"] / HOT_SHARE, HOT_LEAST)
    return sorted({t["item"] for i in range(len(keys)) for t in found[f"top{i}"]
                   if t["item"] is not None and t["count"] >= least})


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased (as UTF-8 bytes).
    ``bytes.lower`` and ``bytes.split`` touch ASCII only."""
    return text.encode("utf-8").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters and digits and non-ASCII characters, A-Z
    lower-cased (as UTF-8 bytes)."""
    return text.encode("utf-8").translate(ALNUM_TABLE).split() if text else []


def text_key(text: Column) -> Column:
    """Tells apart documents that share a ``doc_id``."""
    return F.xxhash64(text)


_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]?)")


class WordEncoder:
    """Token ids of whole texts, remembering the ids of each blank-separated
    chunk. The tokenizer drops white space, none of its pieces spans it, and
    its normalizer treats characters on either side of a blank apart, so the
    ids of a text are the ids of its chunks in a row.

    A chunk of plain Latin letters with at most one punctuation mark is two
    pieces: the letters in lower case (composed already) and the mark. New
    letter pieces are encoded many at a time, without the normalizer, which
    would not change them; the vocabulary marks the last token of each piece,
    so the ids can be told apart again. All other chunks are encoded one by
    one as they are.
    """

    KEEP = 800_000

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.marks = {"": b"", **{m: self._ids(m) for m in ".,!?;:"}}
        self._forget()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        simple, hard = [], []
        for c in chunks:
            m = _SIMPLE.fullmatch(c)
            if m:
                simple.append((c, m[1].lower(), m[2]))
            else:
                hard.append(c)
        for c, e in zip(hard, self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)):
            self.known[c] = np.array(e.ids, "<u4").tobytes()
        new = list({p for _, p, _ in simple}.difference(self.pieces))
        for k in range(0, len(new), 1000):
            part = new[k:k + 1000]
            ids = np.array(self.letters.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not mark the ends of pieces")
            data, start = ids.tobytes(), 0
            for p, end in zip(part, ends.tolist()):
                self.pieces[p] = data[start:end]
                start = end
        for c, p, mark in simple:
            self.known[c] = self.pieces[p] + self.marks[mark]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = []
        for t in texts:
            t = t or ""
            for blank in BLANKS[1:]:
                if blank in t:
                    t = t.replace(blank, " ")
            split.append(t.split(" "))
        if len(self.known) > self.KEEP:
            self._forget()
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(list(new))
        get = self.known.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
