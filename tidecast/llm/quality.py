"""Quality rules: repetition coverage by rolling hashes in numpy.

For each text, the share of characters inside n-grams that repeat an earlier
one (five to ten words, rolling 64-bit hashes of the word numbers) and inside
lines that repeat an earlier one; with the base counts of words, symbols,
repeated lines and words in repeated three-word windows (exact keys).

The limits are those of published repetition filters (Rae et al. 2021).
Defined results: a null or empty text has no words and fails the base rule.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import BLANKS

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = "#*$%&|<>"
#: Highest share of characters inside repeated n-grams, by words in the n-gram.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS_LIMIT = 0.20
MIN_WORDS = 50
#: The multiplier of the rolling hash, an odd number.
ROLL = np.uint64(6364136223846793005)

SIGNALS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "dup_line_chars long, dup_ngram_chars array<long>, base_failed boolean, kept boolean")


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in windows of ``width`` words that begin at ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def repeated_windows(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Places of keys that occur twice or more (with or without the first)."""
    if len(keys) < 2:
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return np.zeros(0, np.int64)
    later = np.concatenate([[False], same])
    if first_too:
        later = later | np.concatenate([same, [False]])
    return order[later]


def signals(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    word_chars = int(sizes.sum())
    n_symbols = sum(map(text.count, SYMBOLS))

    seen: set[str] = set()
    n_dup_lines = dup_line_chars = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(BLANKS):
                if line in seen:
                    n_dup_lines += 1
                    dup_line_chars += len(line)
                seen.add(line)

    number: dict[str, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    n_repeat = 0
    dup_chars = [0] * len(NGRAM_LIMITS)
    if n >= 3:
        pairs = ids[:-1] * len(number) + ids[1:]
        if len(number) >= 1 << 20:  # keep the three-word key below 2**63
            pairs = np.unique(pairs, return_inverse=True)[1]
        repeated = repeated_windows(pairs[:-1] * len(number) + ids[2:], first_too=True)
        if len(repeated):
            n_repeat = int(covered(repeated, 3, n).sum())
            codes = ids.astype(np.uint64) + np.uint64(1)
            rolled = codes
            for width in range(2, max(NGRAM_LIMITS) + 1):
                if n < width:
                    break
                rolled = rolled[:n - width + 1] * ROLL + codes[width - 1:]
                if width in NGRAM_LIMITS:
                    again = repeated_windows(rolled, first_too=False)
                    if not len(again):  # then no longer n-gram repeats either
                        break
                    dup_chars[width - min(NGRAM_LIMITS)] = int(sizes[covered(again, width, n)].sum())

    base_failed = n < MIN_WORDS or 100 * n_repeat > 50 * n
    kept = (not base_failed
            and all(c <= limit * word_chars for c, limit in zip(dup_chars, NGRAM_LIMITS.values()))
            and dup_line_chars <= LINE_CHARS_LIMIT * len(text))
    return n, word_chars, n_symbols, n_dup_lines, n_repeat, dup_line_chars, dup_chars, base_failed, kept


def quality_signals(text: Column) -> Column:
    """Struct of the signals and the verdict of each text."""
    names = [field.split()[0] for field in SIGNALS.split(", ")]

    @F.pandas_udf(SIGNALS)
    def of(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([signals(t) for t in text], columns=names)

    # Nondeterministic only for the optimizer: evaluated once, never
    # duplicated into a pushed-down filter.
    return of.asNondeterministic()(text)


def with_quality(docs: DataFrame, out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out`` of the signals and the verdict."""
    return docs.withColumn(out, quality_signals(F.col("text")))


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return with_quality(row).where("quality.kept").select("row.*")
