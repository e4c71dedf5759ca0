import datetime

from pyspark.sql import functions as F

from tidecast.functions import day_index, day_number, dept_key, saturday_wday, series_key


def test_day_index_parses_and_nulls_junk(spark):
    df = spark.createDataFrame([("d_9",), ("d_10",), ("x1",), (None,)], "v string")
    got = [r.n for r in df.select(day_index("v").alias("n")).collect()]
    assert got == [9, 10, None, None]


def test_day_index_only_strips_anchored_prefix(spark):
    df = spark.createDataFrame([("d_d_3",)], "v string")
    assert df.select(day_index("v").alias("n")).first().n is None


def test_dept_key_first_two_parts(spark):
    df = spark.createDataFrame([("HOBBIES_1_001",), ("HOBBIES",), (None,)], "v string")
    got = [r.k for r in df.select(dept_key("v").alias("k")).collect()]
    assert got == ["HOBBIES_1", None, None]


def test_dept_key_other_separator(spark):
    df = spark.createDataFrame([("small ring",)], "v string")
    assert df.select(dept_key("v", sep=" ").alias("k")).first().k == "small_ring"


def test_series_key_null_when_part_missing(spark):
    df = spark.createDataFrame([("A", "S1"), ("B", None)], "item string, store string")
    got = [r.id for r in df.select(series_key("item", "store", suffix="evaluation").alias("id")).collect()]
    assert got == ["A_S1_evaluation", None]


def test_saturday_first_weekday(spark):
    days = [datetime.date(2024, 1, 6) + datetime.timedelta(days=i) for i in range(7)]  # Sat..Fri
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.w for r in df.select(saturday_wday("d").alias("w")).collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_day_number_origin_is_one(spark):
    df = spark.createDataFrame([(datetime.date(1995, 1, 1),), (datetime.date(1995, 1, 31),)], "d date")
    assert [r.n for r in df.select(day_number("d").alias("n")).collect()] == [1, 31]


def test_ln_of_non_positive_is_null(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    got = [r.y for r in df.select(F.ln("x").alias("y")).collect()]
    assert got == [0.0, None, None, None]
