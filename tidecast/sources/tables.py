"""Access to the driver-generated parquet tables (one file per table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] = ()
) -> DataFrame:
    """Scan one table; selecting columns here lets the scan prune them."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
