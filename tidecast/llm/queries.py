"""Registered queries: each operator on its whole table, with the digest
columns derived from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (decontaminate, hmm, jaccard_join, licenses, packing, periodic_runs, phrase_graph, quality,
                          secret_scan, sharding, substring_dedup, suffix_dedup, token_files)
from tidecast.llm.common import LOWER, UPPER, prepare, read

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    clean = substring_dedup.remove_repeats(docs).select("doc_id", "clean.*")
    return clean.select("doc_id", "n_sentences", "n_removed", (F.col("n_removed") > 0).alias("repeated"),
                        "removed", "text")


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf, "documents"), vocabulary())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf, "documents"), k=4, num=85, den=100)


def op3_jaccard_links(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_links(read(spark, sf, "documents"), k=4, num=85, den=100)


def op4_hmm_score(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.score_documents(read(spark, sf, "documents"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, read(spark, sf, "benchmark"))
    return found.select("doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"))


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_documents(read(spark, sf, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         "virtual_slot")


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    folder = token_files.token_folder(docs)
    manifest = token_files.write_token_files(docs, folder, vocabulary())
    stored = token_files.read_token_files(manifest, folder)
    return stored.select("doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))


def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf, "documents").select("doc_id", "text"))
    counts = [secret_scan.n_of("base", name).alias(f"n_{name}") for name in secret_scan.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"),
                        secret_scan.listed("spans").alias("spans"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.with_quality(read(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


#: Phrases that are listed of each language.
TOP_PHRASES = 2000


def op11_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    graph = phrase_graph.phrase_graph(read(spark, sf, "documents"))
    found = phrase_graph.top_collocations(phrase_graph.collocations(graph), TOP_PHRASES)
    paths = phrase_graph.unary_paths(graph).select("lang", "phrase", F.col("n_words").alias("path_words"))
    return found.join(paths, ["lang", "phrase"], "left").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words")


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    text = periodic_runs.planted(F.col("doc_id"), F.col("text"))
    found = periodic_runs.with_runs(docs.select("doc_id", text.alias("text")))
    best, runs = periodic_runs.best_run(F.col("periodic.runs")), F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256)
                        .alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256")) \
        .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                "runs_sha256", "collapsed_sha256")


def op13_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    clean = suffix_dedup.remove_repeated_bytes(read(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["z"] - s["a"])
    return clean.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf)

    run.__name__ = query.__name__
    return run


QUERIES = {q.__name__: _prepared(q) for q in (
    op1_substring_dedup, op2_packing, op3_jaccard_join, op3_jaccard_links, op4_hmm_score, op5_decontamination,
    op6_sharding, op7_token_files, op8_secrets, op9_quality_rules, op10_license_scan,
    op11_phrase_collocations, op12_periodic_runs, op13_suffix_dedup)}

_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

_NEAR = f"""WITH RECURSIVE
docs AS (
  SELECT row_number() OVER () AS r, doc_id, text AS t, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT r, array_to_string(w[s:s + least(len(w), 4) - 1], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n_both
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reached AS (
  SELECT r, r AS other FROM docs
  UNION
  SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.other),
classes AS (
  SELECT reached.r, min(docs.doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.other GROUP BY reached.r)"""

_NEAR_SQL = _NEAR + """
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, classes.component_id
FROM docs JOIN classes ON classes.r = docs.r LEFT JOIN sizes ON sizes.r = docs.r"""

#: Rows that repeat an id and its text are one document.
_LINKS_SQL = _NEAR + """,
degree AS (
  SELECT a AS r, count(DISTINCT struct_pack(d := o.doc_id, t := o.t)) AS n
  FROM links JOIN docs o ON o.r = b JOIN docs m ON m.r = a
  WHERE o.doc_id IS DISTINCT FROM m.doc_id OR o.t <> m.t GROUP BY a)
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, classes.component_id, coalesce(degree.n, 0) AS n_links
FROM docs JOIN classes ON classes.r = docs.r LEFT JOIN sizes ON sizes.r = docs.r LEFT JOIN degree ON degree.r = docs.r"""

_ALNUM_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_BENCHMARK_SQL = f"""WITH
docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM_WORDS} AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
        FROM items WHERE len(w) > 0)),
widths AS (SELECT DISTINCT k FROM wanted),
windows AS (
  SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docs, widths)),
met AS (SELECT r, s, windows.k, item FROM windows JOIN wanted ON windows.k = wanted.k AND windows.g = wanted.g),
hit AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(s, s + k)) AS place FROM (SELECT DISTINCT r, s, k FROM met)) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM met WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit ON hit.r = docs.r LEFT JOIN found ON found.r = docs.r"""

_PHRASES_SQL = f"""WITH RECURSIVE
docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]') AS parts FROM documents),
piece AS (
  SELECT lang, regexp_extract_all(part, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(parts) AS part FROM docs)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM piece, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
candidate AS (SELECT *, string_split(p, ' ') AS w FROM gram WHERE k >= 2),
kept AS (
  SELECT * FROM candidate c WHERE NOT EXISTS (
    SELECT 1 FROM candidate g WHERE g.lang = c.lang AND g.k > c.k AND 100 * g.f >= 100 * c.f
    AND contains(' ' || g.p || ' ', ' ' || c.p || ' '))),
cut AS (
  SELECT lang, p, f, k, j, array_to_string(w[:j], ' ') AS p1, array_to_string(w[j + 1:], ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)),
scored AS (
  SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, n, j,
         CAST(1000::HUGEINT * c.f * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut c JOIN gram x ON x.lang = c.lang AND x.p = c.p1 JOIN gram y ON y.lang = c.lang AND y.p = c.p2
  JOIN total ON total.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS place FROM scored),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p, a, l, r, n, score
  FROM best WHERE place = 1),
edge AS (
  SELECT lang, p, f, array_to_string(w[:4], ' ') AS u, array_to_string(w[2:], ' ') AS v FROM candidate WHERE k = 5),
link AS (
  SELECT e.lang, e.p AS p, g.p AS q
  FROM gram x JOIN edge e ON x.lang = e.lang AND x.p = e.v AND x.f = e.f
  JOIN edge g ON x.lang = g.lang AND x.p = g.u AND x.f = g.f WHERE x.k = 4 AND e.p <> g.p),
walk AS (
  SELECT lang, p AS head, p, 0 AS step FROM edge ANTI JOIN link ON link.lang = edge.lang AND link.q = edge.p
  UNION ALL
  SELECT walk.lang, head, link.q, step + 1 FROM walk JOIN link ON link.lang = walk.lang AND link.p = walk.p),
path AS (SELECT lang, p, max(step) OVER (PARTITION BY lang, head) + 5 AS words FROM walk)
SELECT ranked.lang, rank, ranked.p AS phrase, a, l, r, n, score,
       CASE WHEN len(string_split(ranked.p, ' ')) = 5 THEN CAST(coalesce(words, 5) AS BIGINT) END AS path_words
FROM ranked LEFT JOIN path ON path.lang = ranked.lang AND path.p = ranked.p WHERE rank <= 2000"""

_RUNS_SQL = """WITH
crc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) AS h
  FROM documents),
base AS (
  SELECT r, doc_id, w, h, CAST(len(w) AS BIGINT) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM crc),
shaped AS (
  SELECT *, CASE WHEN h % 10 = 0 THEN 1 + (n - a) // (3 + g % 8) ELSE n + 1 END AS p FROM base),
word AS (
  SELECT r, i, n, w[1 + CASE WHEN i < a OR p > n THEN i ELSE a + (i - a) % p END] AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)),
same AS (
  SELECT u.r, u.i, v.i - u.i AS q FROM word u JOIN word v
  ON u.r = v.r AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
stretch AS (
  SELECT r, q, min(i) AS s, count(*) + q AS m
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same)
  GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT r, s, m, min(q) AS q FROM stretch GROUP BY r, s, m),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         first(struct_pack(s := s, m := m, q := q) ORDER BY m / q DESC, s, q) AS best
  FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (
  SELECT word.r, string_agg(x, ' ' ORDER BY word.i) AS t
  FROM word ANTI JOIN gone ON gone.r = word.r AND gone.i = word.i GROUP BY word.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.m AS length, best.q AS period,
       1000 * best.m // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(t, '')) AS collapsed_sha256
FROM base LEFT JOIN listed ON listed.r = base.r LEFT JOIN kept ON kept.r = base.r"""

#: 400 hexadecimal digits are 200 bytes; windows are cut from blocks of 512.
_SUFFIX_SQL = """WITH
docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
block AS (
  SELECT r, b, substring(h, 2 * b + 1, 1422) AS part
  FROM (SELECT r, h, unnest(range(0, len(h) // 2, 512)) AS b FROM docs)),
win AS (
  SELECT r, b + j AS i, md5_number(substring(part, 2 * j + 1, 400)) AS g
  FROM (SELECT r, b, part, unnest(range(0, least(512, len(part) // 2 - 199))) AS j FROM block)),
again AS (SELECT r, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
island AS (
  SELECT r, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS k
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM again)),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS z FROM island GROUP BY r, k),
cut AS (
  SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS from_,
         lead(a) OVER (PARTITION BY r ORDER BY a) IS NULL AS final FROM span),
found AS (
  SELECT docs.r, sum(z - a) AS n_removed, count(*) AS n_spans,
         string_agg(substring(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN final THEN substring(h, 2 * z + 1) ELSE '' END,
                    '' ORDER BY a) AS kept
  FROM cut JOIN docs ON docs.r = cut.r GROUP BY docs.r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN found ON found.r = docs.r"""

#: DuckDB statements of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op3_jaccard_join": _NEAR_SQL, "op3_jaccard_links": _LINKS_SQL,
                              "op5_decontamination": _BENCHMARK_SQL,
                              "op11_phrase_collocations": _PHRASES_SQL, "op12_periodic_runs": _RUNS_SQL,
                              "op13_suffix_dedup": _SUFFIX_SQL}
