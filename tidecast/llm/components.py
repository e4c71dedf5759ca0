"""Connected components of a link table, by alternating stars.

Each round points every vertex at the smallest vertex it knows: first larger
neighbours (large star), then the rest (small star), as in Kiveris et al.
2014. A round is two shuffles; a vertex with very many links is reduced by
partial aggregates, and its links meet one row. Rounds are written to the
shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "w")).alias("x")).first()
    return r["n"], r["x"]


def components(links: DataFrame, name: str = "stars") -> DataFrame:
    """``links(a, b)`` in any direction -> (v, c): every linked vertex but the
    smallest of its component, with that smallest vertex."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w")).where("u <> w").distinct()
    edges = written(edges, name)
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("w").alias("u"), F.col("u").alias("w")))
        least = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("w > u").select(F.col("w").alias("u"), F.col("m").alias("w")).distinct()
        least = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(least, "u").where("w <> m").select(F.col("w").alias("u"), F.col("m").alias("w"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("w"))).distinct(), name)
        now = _signature(edges)
        if now == before:
            return edges.select(F.col("u").alias("v"), F.col("w").alias("c"))
        before = now
