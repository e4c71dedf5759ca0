"""String indexes without the driver.

A ``StringIndexer`` brings every label to the driver, which does for a few
event names but not for item keys. Here the labels stay a table: counted,
dealt to range partitions in index order (falling count, then label) and
numbered inside each; the labels before a partition come from one number for
each partition. The index is joined to the rows, never collected.

Defined results: null and unseen values get the number of labels, as
``handleInvalid="keep"`` gives; numbers are indexed as their text; equal counts
go by label; an empty column has no labels, so its nulls get 0.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import materialize


def label_table(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """(label, n, index) of every label of ``col``."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("label").asc()]
    ranged = materialize(counts.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "labels")
    sizes = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}
    before, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(part, 0)
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before or [0]]), F.col("_part"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return materialize(ranged.select("label", "n", (offset + place).cast("double").alias("index")), "labels")


class LabelIndexer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LabelIndexerModel:
        return self._copyValues(LabelIndexerModel(label_table(df, self.getInputCol())))


class LabelIndexerModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """Joins the index; the join is broadcast or shuffled by its size."""

    def __init__(self, labels: DataFrame | None = None):
        super().__init__()
        self.labels = labels
        self.n_labels = labels.count() if labels is not None else 0

    def _transform(self, df: DataFrame) -> DataFrame:
        index = self.labels.select(F.col("label").alias("_label"), F.col("index").alias("_index"))
        met = df.join(index, df[self.getInputCol()].cast("string") == index["_label"], "left")
        return met.withColumn(self.getOutputCol(), F.coalesce("_index", F.lit(float(self.n_labels)))) \
            .drop("_label", "_index")

    def write(self) -> MLWriter:
        return _LabelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LabelReader(cls)


class _LabelWriter(MLWriter):
    def __init__(self, model: LabelIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.labels.write.parquet(f"{path}/labels")


class _LabelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LabelIndexerModel:
        spark = SparkSession.active()
        model = self.cls(spark.read.parquet(f"{path}/labels"))
        DefaultParamsReader.getAndSetParams(model, DefaultParamsReader.loadMetadata(path, spark))
        return model
