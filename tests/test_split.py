import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast.operators.split import cutoff_split, time_percent_rank, time_split


def test_percent_rank_ties(spark):
    df = spark.createDataFrame([(d,) for d in [1, 1, 2, 3, 3]], "day int")
    got = sorted(r.rank for r in time_percent_rank(df, "day").collect())
    assert got == [0.0, 0.0, 0.5, 0.75, 0.75]


def test_percent_rank_equals_window_function(spark):
    rng = random.Random(3)
    data = [(rng.randint(1, 40), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "day int, v double")
    ours = time_percent_rank(df, "day").groupBy("day").agg(F.max("rank").alias("r"))
    ref = df.withColumn("r", F.percent_rank().over(Window.orderBy("day"))).groupBy("day").agg(F.max("r").alias("r"))
    a = {r.day: r.r for r in ours.collect()}
    b = {r.day: r.r for r in ref.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_split_single_row_goes_to_train(spark):
    df = spark.createDataFrame([(1,)], "day int")
    train, test = time_split(df, "day", 0.8)
    assert train.count() == 1 and test.count() == 0


@pytest.mark.parametrize("ratio", [0.7, 0.8])
def test_split_properties(spark, ratio):
    rng = random.Random(11)
    data = [(i, rng.randint(1, 100)) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, day int")
    train, test = time_split(df, "day", ratio)
    tr = {r.id: r.day for r in train.collect()}
    te = {r.id: r.day for r in test.collect()}
    assert not set(tr) & set(te)
    assert len(tr) + len(te) == 2000
    assert max(tr.values()) < min(te.values())  # no day on both sides
    assert abs(len(tr) / 2000 - ratio) < 0.05  # ratio honoured


def test_cutoff_split(spark):
    df = spark.createDataFrame([("2016-01-28",), ("2016-01-29",), ("2016-01-30",)], "d string") \
        .select(F.col("d").cast("date").alias("date"))
    train, test = cutoff_split(df, "date", "2016-01-29")
    assert train.count() == 2 and test.count() == 1


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-3, max_value=12), min_size=1, max_size=40))
def test_scalable_rank_equals_percent_rank_property(spark, days):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, day int")
    ours = {r.id: r.rank for r in time_percent_rank(df, "day").collect()}
    ref = {r.id: r.r for r in df.withColumn("r", F.percent_rank().over(Window.orderBy("day"))).collect()}
    assert ours.keys() == ref.keys()
    assert all(abs(ours[k] - ref[k]) < 1e-12 for k in ours)
