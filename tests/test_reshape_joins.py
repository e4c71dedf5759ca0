import contextlib
import io
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidecast.operators.joins import inner_join_on, left_join_using
from tidecast.operators.reshape import day_columns, melt


def test_melt_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 3, 4), (2, None, 5)], "id int, d_1 int, d_2 int")
    rows = melt(df, ["id"]).orderBy("id", "variable").collect()
    assert [(r.id, r.variable, r.value) for r in rows] == [
        (1, "d_1", 3), (1, "d_2", 4), (2, "d_1", None), (2, "d_2", 5)]


def test_melt_mixed_types_fail_at_analysis(spark):
    df = spark.createDataFrame([(1, 3, "x")], "id int, d_1 int, d_2 string")
    with pytest.raises(AnalysisException):
        melt(df, ["id"], ["d_1", "d_2"]).collect()


def test_melt_picks_day_columns_by_name(spark):
    df = spark.createDataFrame([(1, "a", 3, 4)], "id int, name string, d_2 int, d_10 int")
    assert day_columns(df) == ["d_2", "d_10"]
    assert melt(df, ["id"]).count() == 2


def test_melt_row_count_property(spark):
    rng = random.Random(7)
    for _ in range(3):
        n_rows, n_cols = rng.randint(1, 20), rng.randint(1, 6)
        cols = [f"d_{i + 1}" for i in range(n_cols)]
        data = [tuple([i] + [rng.choice([None, rng.randint(0, 9)]) for _ in cols]) for i in range(n_rows)]
        df = spark.createDataFrame(data, "id int, " + ", ".join(f"{c} int" for c in cols))
        assert melt(df, ["id"]).count() == n_rows * n_cols


def test_left_join_keeps_unmatched(spark):
    prices = spark.createDataFrame([(1, 10.0), (99, 5.0)], "wm_yr_wk int, price double")
    cal = spark.createDataFrame([(1, "d_1"), (1, "d_2")], "wm_yr_wk int, d string")
    rows = left_join_using(prices, cal, "wm_yr_wk").orderBy("wm_yr_wk", "d").collect()
    assert [(r.wm_yr_wk, r.d) for r in rows] == [(1, "d_1"), (1, "d_2"), (99, None)]


def test_inner_join_on_two_renamed_keys(spark):
    a = spark.createDataFrame([("x", "d_1", 1), ("x", "d_2", 2), ("y", "d_1", 3)], "id2 string, variable string, v int")
    b = spark.createDataFrame([("x", "d_1", 10.0), ("y", "d_2", 20.0)], "id string, d string, p double")
    rows = inner_join_on(a, b, [("id2", "id"), ("variable", "d")]).collect()
    assert [(r.id2, r.variable, r.v, r.p) for r in rows] == [("x", "d_1", 1, 10.0)]


def test_grown_side_is_not_broadcast(spark, tmp_path):
    """The choice follows the bytes of the side now at the path."""
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plans = []
        for rows in (10, 100_000):
            spark.range(rows).withColumnRenamed("id", "k").write.mode("overwrite").parquet(str(tmp_path / "dim"))
            plans.append(_plan(left_join_using(fact, spark.read.parquet(str(tmp_path / "dim")), "k")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0]
    assert "BroadcastHashJoin" not in plans[1]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_wide_melt_equals_unpivot(spark):
    n = 1941
    schema = "id string, " + ", ".join(f"d_{i} int" for i in range(1, n + 1))
    rows = [(k, *[None if (i + j) % 7 == 0 else i * j for i in range(1, n + 1)]) for j, k in enumerate("ab")]
    df = spark.createDataFrame(rows, schema)
    got = {(r[0], r[1]): r[2] for r in melt(df, ["id"]).collect()}
    assert got == {(row[0], f"d_{i}"): row[i] for row in rows for i in range(1, n + 1)}
