"""Histogram gradient boosting with a direction for missing values.

Values are cut into bins once (quantiles or equal widths of the values that are
there); bin 0 is for missing ones: null, NaN and the value ``missing`` (0.0 as
a sparse input has it). A level of a tree is one aggregate: the rows, spread
over their features, are summed by (node, feature, bin) - map-side first, so
what is shuffled is bounded by nodes x features x bins whatever the row count.
Windows over these sums give the gain of every cut with the missing values on
either side; one chosen row for each node comes to the driver. Squared error:
the gradient of a row is its residual.

The binned rows (a small array, the label and the current prediction) are
written once for each tree, so no plan grows with the number of trees and a
lost executor costs one tree at most.

Defined results: an empty training set gives a model that predicts null; a
feature without any value cannot be cut; equal gains go to the lower feature,
then the lower bin, then missing values to the left; a null label is left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import materialize


@dataclass
class Split:
    """Values up to ``threshold`` go to the left, missing ones as said."""

    feature: int
    bin: int
    threshold: float
    missing_left: bool
    gain: float


@dataclass
class Node:
    value: float
    split: Split | None = None
    left: int | None = None
    right: int | None = None


def feature_array(df: DataFrame, col: str) -> Column:
    return vector_to_array(col) if isinstance(df.schema[col].dataType, VectorUDT) else F.col(col)


def present(x: Column, missing: float | None) -> Column:
    """The value, or null where it counts as missing."""
    there = x.isNotNull() & ~F.isnan(x)
    return F.when(there if missing is None or math.isnan(missing) else there & (x != F.lit(missing)), x)


def bin_edges(df: DataFrame, features: Column, n_features: int, bins: int, missing: float | None,
              binning: str = "quantile") -> list[list[float]]:
    """Upper edges of bins 1 ... of each feature, from one aggregate; at most
    ``bins - 1`` of them, and the last bin has none."""
    x = [present(F.get(features, F.lit(i)).cast("double"), missing) for i in range(n_features)]
    if binning == "uniform":
        low_high = df.agg(*[f(x[i]).alias(f"{name}{i}") for i in range(n_features) for name, f in
                            (("lo", F.min), ("hi", F.max))]).first()
        out = []
        for i in range(n_features):
            lo, hi = low_high[f"lo{i}"], low_high[f"hi{i}"]
            edges = [] if lo is None else [lo + (hi - lo) * k / bins for k in range(1, bins)]
            out.append(sorted(set(e for e in edges if lo <= e < hi)))
        return out
    if binning != "quantile":
        raise ValueError(f"unknown binning {binning!r}")
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(x[i], at, 10_000).alias(f"q{i}") for i in range(n_features)],
                 *[F.max(x[i]).alias(f"hi{i}") for i in range(n_features)]).first()
    return [sorted({e for e in row[f"q{i}"] or [] if e < row[f"hi{i}"]}) for i in range(n_features)]


def with_bins(df: DataFrame, features: Column, edges: Sequence[Sequence[float]], missing: float | None,
              *keep: Column | str) -> DataFrame:
    """``keep`` and ``bins``, the bin of each feature: 0 for a missing value,
    else 1 + edges below it."""
    names = [f"_x{i}" for i in range(len(edges))]
    values = [present(F.get(features, F.lit(i)).cast("double"), missing).alias(x) for i, x in enumerate(names)]
    places = [F.when(F.col(x).isNull(), 0).otherwise(_place(F.col(x), e, 1)) for x, e in zip(names, edges)]
    return df.select(*keep, *values).withColumn("bins", F.array(*places)).drop(*names)


def _place(x: Column, edges: Sequence[float], first: int) -> Column:
    """``first`` plus the number of edges below x, by bisection in nested
    conditions (compiled code, unlike a lambda over an array)."""
    if not edges:
        return F.lit(first)
    mid = len(edges) // 2
    return F.when(x <= F.lit(edges[mid]), _place(x, edges[:mid], first)) \
        .otherwise(_place(x, edges[mid + 1:], first + mid + 1))


def histogram(rows: DataFrame, n_features: int) -> DataFrame:
    """(node, feature, bin, g, n): sums of the residuals and rows, from
    ``rows(node, bins, g)``. The rows of a node without a value in a feature
    stand in bin 0."""
    cells = rows.select("node", "g", F.posexplode("bins").alias("feature", "bin"))
    return cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))


def split_gains(sums: DataFrame, reg_lambda: float, min_rows: int = 1) -> DataFrame:
    """(node, feature, bin, missing_left, gain, left, right) of every cut that
    leaves ``min_rows`` on both sides: bins up to ``bin`` go left; ``left`` and
    ``right`` hold the sums (g, n) of the two sides."""
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    is_missing = F.col("bin") == 0
    cells = sums.select(
        "node", "feature", "bin", F.sum("g").over(whole).alias("G"), F.sum("n").over(whole).alias("N"),
        F.sum(F.when(is_missing, F.col("g")).otherwise(0.0)).over(whole).alias("gm"),
        F.sum(F.when(is_missing, F.col("n")).otherwise(0)).over(whole).alias("nm"),
        F.sum(F.when(is_missing, 0.0).otherwise(F.col("g"))).over(upto).alias("gl"),
        F.sum(F.when(is_missing, 0).otherwise(F.col("n"))).over(upto).alias("nl"),
    ).where(~is_missing)
    sides = F.explode(F.array(
        F.struct(F.lit(True).alias("missing_left"), (F.col("gl") + F.col("gm")).alias("g"), (F.col("nl") + F.col("nm")).alias("n")),
        F.struct(F.lit(False).alias("missing_left"), F.col("gl").alias("g"), F.col("nl").alias("n"))))
    cuts = cells.select("node", "feature", "bin", "G", "N", sides.alias("left")) \
        .where((F.col("left.n") >= min_rows) & (F.col("N") - F.col("left.n") >= min_rows))

    def score(g: Column, n: Column) -> Column:
        return g * g / (n + F.lit(reg_lambda))

    g, n = F.col("left.g"), F.col("left.n")
    gain = score(g, n) + score(F.col("G") - g, F.col("N") - n) - score(F.col("G"), F.col("N"))
    return cuts.select("node", "feature", "bin", F.col("left.missing_left").alias("missing_left"), gain.alias("gain"),
                       F.struct(g.alias("g"), n.alias("n")).alias("left"),
                       F.struct((F.col("G") - g).alias("g"), (F.col("N") - n).alias("n")).alias("right"))


def best_splits(gains: DataFrame, by: Sequence[str] = ("node",)) -> DataFrame:
    """The cut with the greatest gain (ties: lower feature, lower bin, missing
    values to the left) of each ``by`` group."""
    order = F.struct(-F.col("gain"), "feature", "bin", ~F.col("missing_left"))
    rest = [c for c in gains.columns if c not in by]
    return gains.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("b")).select(*by, "b.*")


def _tree_column(nodes: list[Node], leaf, left_of, at: int = 0) -> Column:
    node = nodes[at]
    if node.split is None:
        return leaf(at, node)
    return F.when(left_of(node.split), _tree_column(nodes, leaf, left_of, node.left)) \
        .otherwise(_tree_column(nodes, leaf, left_of, node.right))


def _left_of_bins(s: Split) -> Column:
    b = F.get(F.col("bins"), F.lit(s.feature))
    return (b <= s.bin) if s.missing_left else ((b <= s.bin) & (b > 0))


class HistGBTRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", typeConverter=TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", typeConverter=TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree that is added", typeConverter=TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf values", typeConverter=TypeConverters.toFloat)
    missing = Param(Params._dummy(), "missing", "value that counts as missing besides null and NaN; NaN: none",
                    typeConverter=TypeConverters.toFloat)
    binning = Param(Params._dummy(), "binning", "quantile or uniform", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="LogSales", predictionCol="prediction", maxDepth=2, maxIter=10,
                 maxBins=32, stepSize=0.3, regLambda=1.0, missing=0.0, binning="quantile"):
        super().__init__()
        self._set(**{"featuresCol": "features", "labelCol": "LogSales", "predictionCol": "prediction", "maxDepth": 2,
                     "maxIter": 10, "maxBins": 32, "stepSize": 0.3, "regLambda": 1.0, "missing": 0.0,
                     "binning": "quantile"} | self._input_kwargs)

    def _fit(self, df: DataFrame) -> HistGBTModel:
        get = self.getOrDefault
        features, y = feature_array(df, self.getFeaturesCol()), F.col(self.getLabelCol()).cast("double")
        train = df.where(y.isNotNull() & ~F.isnan(y))
        about = train.agg(F.avg(y), F.max(F.size(features))).first()
        model = HistGBTModel(about[0], [], get(self.missing))
        self._copyValues(model)
        if about[0] is None:
            return model
        edges = bin_edges(train, features, about[1], get(self.maxBins), model.missing_value, get(self.binning))
        rows = materialize(with_bins(train, features, edges, model.missing_value, y.alias("y"),
                                     F.lit(about[0]).alias("margin")), "binned")
        for _ in range(get(self.maxIter)):
            nodes = self._grow(rows, edges)
            model.trees.append(nodes)
            value = _tree_column(nodes, lambda at, node: F.lit(node.value), _left_of_bins)
            rows = materialize(rows.withColumn("margin", F.col("margin") + value), "binned")
        return model

    def _grow(self, rows: DataFrame, edges: list[list[float]]) -> list[Node]:
        """One tree, a job for each level: the chosen cuts bring the sums of
        both their sides, which are the values of the nodes below."""
        reg, step = self.getOrDefault(self.regLambda), self.getOrDefault(self.stepSize)
        nodes, last = [Node(0.0)], [0]
        for depth in range(self.getOrDefault(self.maxDepth)):
            here = _tree_column(nodes, lambda at, node: F.lit(at), _left_of_bins)
            placed = rows.select(here.alias("node"), "bins", (F.col("y") - F.col("margin")).alias("g"))
            placed = placed.where(F.col("node").isin(last)) if depth else placed
            best = best_splits(split_gains(histogram(placed, len(edges)), reg)).collect()
            if depth == 0:  # no cut may be possible at all
                g, n = (sum(x[k] for x in (best[0]["left"], best[0]["right"])) for k in ("g", "n")) if best else \
                    placed.agg(F.sum("g"), F.count(F.lit(1))).first()
                nodes[0].value = step * g / (n + reg)
            last = []
            for r in sorted(best, key=lambda r: r["node"]):
                if r["gain"] <= 1e-12:
                    continue
                own = edges[r["feature"]]
                threshold = own[r["bin"] - 1] if r["bin"] <= len(own) else math.inf
                node = nodes[r["node"]]
                node.split = Split(r["feature"], r["bin"], threshold, r["missing_left"], r["gain"])
                node.left, node.right = len(nodes), len(nodes) + 1
                last += [node.left, node.right]
                nodes += [Node(step * x["g"] / (x["n"] + reg)) for x in (r["left"], r["right"])]
            if not last:
                break
        return nodes


class HistGBTModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, MLWritable, MLReadable):
    """Trees over raw values: no bins are needed to predict."""

    def __init__(self, base: float | None = None, trees: list[list[Node]] | None = None, missing_value: float = 0.0):
        super().__init__()
        self.base, self.trees, self.missing_value = base, trees if trees is not None else [], missing_value

    def first(self, n_trees: int) -> HistGBTModel:
        """The model as it was after its first ``n_trees`` trees."""
        return self._copyValues(HistGBTModel(self.base, self.trees[:n_trees], self.missing_value))

    def _transform(self, df: DataFrame) -> DataFrame:
        features = feature_array(df, self.getFeaturesCol())

        def left_of(s: Split) -> Column:
            x = present(F.get(features, F.lit(s.feature)).cast("double"), self.missing_value)
            return F.when(x.isNull(), s.missing_left).otherwise(x <= F.lit(s.threshold))

        total = F.lit(self.base).cast("double")
        for nodes in self.trees:
            total = total + _tree_column(nodes, lambda at, node: F.lit(node.value), left_of)
        return df.withColumn(self.getPredictionCol(), total)

    def write(self) -> MLWriter:
        return _BoostedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoostedReader(cls)


class _BoostedWriter(MLWriter):
    def __init__(self, model: HistGBTModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "base": m.base, "missing_value": m.missing_value})
        rows = [(i, json.dumps([asdict(n) for n in nodes])) for i, nodes in enumerate(m.trees)]
        self.sparkSession.createDataFrame(rows, "tree int, nodes string").write.parquet(f"{path}/trees")


class _BoostedReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistGBTModel:
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark)
        trees = [[Node(n["value"], Split(**n["split"]) if n["split"] else None, n["left"], n["right"])
                  for n in json.loads(r["nodes"])] for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        model = self.cls(meta["base"], trees, meta["missing_value"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
