"""Secret scans: character Markov models by log-likelihood ratio, native.

Three base rules give spans. Every other run of identifier characters of at
least ``MIN_RUN`` is a candidate: two first-order character models, one of
random strings and one of ordinary identifiers, are compared by the mean
log-likelihood ratio of the candidate's character pairs. The models are
trained on labelled samples from the documents: values that a base rule found
(random) and runs of letters alone that no base rule touches (ordinary), at
most ``SAMPLE_RUNS`` distinct values of each, those with the smallest hash.
Candidates, spans and decisions cover all documents and whole texts.

Only DataFrame functions run on this path. Positions come from splitting a
text by the pattern: the lengths of the gaps and of the matches add up.

Defined results: a null or empty text has no spans; without samples of either
class both models are flat and no candidate is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import written

# The base rules, in the order that breaks ties of position.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "markov"]

MIN_VALUE = 12
MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}"
ORDINARY = r"^[A-Za-z]+$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SAMPLE_RUNS = 20_000
#: Mean log-likelihood ratio (nats for each pair) from which a run is random.
THRESHOLD = 0.5

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def matches(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans (start, kind, end in code points, value) of all leftmost matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(found.alias("found"), F.slice(gaps, 1, F.size(found)).alias("gap"), values.alias("value"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["gap"])
        end = start + F.length(s["found"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), s["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    empty = F.lit(None).cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array().cast(f"array<{SPAN}>")).alias("out"))
    spans = F.aggregate(steps, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_VALUE)
    return F.array_sort(F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2)))


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(
        others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with arrays ``base`` (base spans) and ``runs`` (candidates)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("base", base_spans(text)).withColumn("runs", matches(text, RUN, 3))
    return out.withColumn("runs", F.when(F.size("runs") > 0, _apart(F.col("runs"), F.col("base")))
                          .otherwise(F.col("runs")))


def labelled_samples(docs: DataFrame, limit: int = SAMPLE_RUNS) -> DataFrame:
    """(random 1/0, value): at most ``limit`` distinct values of each class."""
    # A hex or access span inside an assignment is the same value once more.
    random = F.transform("base", lambda s: F.struct(F.lit(1).alias("random"), s["value"].alias("value")))
    ordinary = F.transform(F.filter("runs", lambda s: s["value"].rlike(ORDINARY)),
                           lambda s: F.struct(F.lit(0).alias("random"), s["value"].alias("value")))
    # One pass over the texts; the distinct values are written for both classes.
    found = candidates(docs).select(F.explode(F.concat(random, ordinary)).alias("s"))
    values = written(found.select("s.*").distinct(), "secret-samples")

    def take(label: int) -> DataFrame:
        return values.where(F.col("random") == label).orderBy(F.xxhash64("value"), "value").limit(limit)

    return take(1).unionByName(take(0))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random to ordinary) for each pair of characters
    of ALPHABET, row by row; counts are smoothed by one. The counts brought
    here have at most 2 x 66 x 66 rows."""
    n = len(ALPHABET)
    pairs = samples.select("random", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"), "value") \
        .select("random", F.substring("value", F.col("i"), F.lit(2)).alias("pair")) \
        .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect()
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = [[0] * (n * n), [0] * (n * n)]
    for r in pairs:
        if r["pair"][0] in place and r["pair"][-1] in place:
            counts[r["random"]][place[r["pair"][0]] * n + place[r["pair"][-1]]] += r["n"]
    if not any(counts[0]) or not any(counts[1]):
        return [0.0] * (n * n)
    rows = [[sum(c[a * n:(a + 1) * n]) for a in range(n)] for c in counts]
    return [math.log((counts[1][k] + 1) / (rows[1][k // n] + n)) - math.log((counts[0][k] + 1) / (rows[0][k // n] + n))
            for k in range(n * n)]


def mean_ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of the pairs in ``value``."""
    ratios = F.split(F.lit(",".join(f"{x:.9f}" for x in table)), ",").cast("array<double>")
    alphabet = F.lit(ALPHABET)

    def add(acc: Column, i: Column) -> Column:
        a = F.instr(alphabet, F.substring(value, i, F.lit(1)))
        b = F.instr(alphabet, F.substring(value, i + 1, F.lit(1)))
        return acc + F.get(ratios, (a - 1) * len(ALPHABET) + b - 1)

    return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), add) / (F.length(value) - 1)


def scan(docs: DataFrame, threshold: float = THRESHOLD, table: list[float] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (base and model spans, by start)."""
    table = table if table is not None else train(labelled_samples(docs.select("text")))
    taken = F.filter("runs", lambda r: mean_ratio(r["value"], table) >= threshold)
    return candidates(docs).withColumn("spans", F.array_sort(F.concat("base", taken))).drop("runs")


def n_of(spans: str, kind: str) -> Column:
    """How many spans of a kind there are."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span (overlapping ones as one) replaced by ``mark``."""
    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        apart = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_secrets(docs: DataFrame, **options) -> DataFrame:
    """All documents, with their own columns; secrets in ``text`` replaced and
    ``n_chars``, where there is one, counted again."""
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    found = scan(row, **options).withColumn("clean", redacted(F.col("text"), F.col("spans")))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars")) \
            .cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
