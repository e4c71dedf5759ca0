"""File scans and sinks.

CSV is always read with an explicit schema: inference costs a full extra pass
over every file, which at terabyte scale is a whole job of its own.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidecast.functions.columns import quoted_name

# ISO formats used on both sides of a CSV round trip (microsecond precision).
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATE_FORMAT = "yyyy-MM-dd"


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "FAILFAST")
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )


#: Holds the text of a record that a reader could not take.
REJECTED = "_rejected_record"


def named_schema(header: Sequence[str], columns: Mapping[str, str], patterns: Mapping[str, str]) -> StructType:
    """Schema of a file with this ``header``: the type of a column comes from
    its name in ``columns`` or from the first pattern its name matches; other
    columns stay text. A column that is missing or stands twice is an error."""
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {list(header)[:20]}")
    twice = sorted({c for c in header if list(header).count(c) > 1} if len(set(header)) < len(header) else ())
    if twice:
        raise ValueError(f"columns {twice} stand twice in the header")

    def kind(name: str) -> str:
        return columns.get(name) or next((t for p, t in patterns.items() if re.fullmatch(p, name)), "string")

    kinds = {c: kind(c) for c in header}
    types = {k: StructType.fromDDL(f"x {k}")[0].dataType for k in set(kinds.values())}
    return StructType([StructField(c, types[kinds[c]]) for c in header])


def read_csv_by_name(spark: SparkSession, path: str, columns: Mapping[str, str],
                     patterns: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV files with a header.

    Types are bound to names, wherever the columns stand: only the header line
    is read to lay them out, nothing is inferred from the data, and a file of
    the folder with another header fails (``enforceSchema`` off). ``rows``
    holds the named columns, then those that match a pattern, in file order; columns nobody
    named are neither converted nor returned. ``rejected(file, record)``
    holds every record with a value that is not of its type or with too few or
    too many values; such records are in ``rows`` in no part."""
    patterns = patterns or {}
    header = spark.read.option("header", True).csv(path).columns
    schema = named_schema(header, columns, patterns)
    wanted = [*columns, *[c for c in header if c not in columns and any(re.fullmatch(p, c) for p in patterns)]]
    raw = (
        spark.read.schema(StructType([*schema.fields, StructField(REJECTED, StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", False)  # else records of the wrong length pass
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )
    # The first condition always holds, and no length is below zero: it makes
    # every scan convert all wanted columns, so that a record is judged alike
    # whatever is selected later, but hashes none of them (that took longer
    # than the parser). The other one is written so that Spark does not push it
    # into the parser. Columns go as text: a wide file has thousands, and each
    # Column object costs the driver several calls to the JVM.
    quoted = [quoted_name(c) for c in wanted]
    checked = raw.where(F.expr(
        f"CASE WHEN length({REJECTED}) < 0 THEN hash({', '.join(quoted)}) ELSE 0 END >= -2147483648"))
    size = F.coalesce(F.length(REJECTED), F.lit(-1))
    rows = checked.where(size < 0).selectExpr(*quoted)
    rejected = checked.where(size >= 0).select(F.input_file_name().alias("file"), F.col(REJECTED).alias("record"))
    return rows, rejected


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", most_rows: int | None = None) -> str:
    """CSV files; with ``most_rows`` compressed ones of that many rows at most:
    a compressed file is read by one task, so it should hold about one split."""
    packed = {"compression": "gzip", "maxRecordsPerFile": most_rows} if most_rows else {}
    (
        df.write.mode(mode)
        .options(**packed)
        .option("header", header)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )
    return path


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> str:
    """Parquet sink. With ``partition_by`` each task writes its own rows per
    partition value (the writer sorts within the task); there is no shuffle
    by the partition column, which would send a value holding a third of the
    rows to a single task."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
