"""Plan-level tests on the driver tables: equivalence of the scalable
forms, the registered catalogue against the DuckDB oracle, and the entry
contract."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tidecast.operators.stages import DailySum
from tidecast.plans import features as fe
from tidecast.sources.retail import calendar_attributes, retail_lines
from tidecast.sources.tables import TABLES


def test_three_key_sum_equals_sixteen_key_sum(spark):
    lines = retail_lines(spark, SF_SMALL)
    with_cal = lines.join(calendar_attributes(lines.select("date").distinct()), ["date", "day"])
    keys16 = ["store_id", "dept_id", "day", "date", "weekday", "wday", "month", "year", "d",
              "event_name_1", "event_type_1", "event_name_2", "event_type_2", "snap_CA", "snap_TX", "snap_WI"]
    wide = DailySum(inputCol="sales", outputCol="sales", groupCols=keys16).transform(with_cal)
    narrow = fe.daily_sales(spark, SF_SMALL)
    cols = keys16 + ["sales"]
    a = wide.select(*cols).withColumn("sales", F.round("sales", 6))
    b = narrow.select(*cols).withColumn("sales", F.round("sales", 6))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_feature_vector_has_22_inputs(spark):
    assert len(fe.FEATURE_COLS) == 22


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    idx = [rel.columns.index(c) for c in order]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert a == b


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_rows_only_queries_run(spark):
    qs = entry_mod.queries()
    assert qs["forecast_fourier"](spark, SF_SMALL).count() > 0
    assert qs["gbt_rmse"](spark, SF_SMALL).count() == 1


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["model", "family", "horizon", "rmse", "n", "chosen"]
    assert len({r.n for r in rows}) == 1
    assert {r.model for r in rows} == {"trees", "fourier", "trend_weekday"}
    assert sum(r.chosen for r in rows) == 1


def test_wide_job_in_either_join_order(spark):
    from tidecast.functions.columns import day_index, dept_key, revenue, series_key
    from tidecast.operators.joins import inner_join_on, left_join_using
    from tidecast.operators.reshape import day_columns, melt
    from tidecast.plans.wide import sales_by_day, wide_tables

    sales, prices, calendar = wide_tables(spark, SF_SMALL)
    dated = left_join_using(prices.withColumn("id", series_key("item_id", "store_id", suffix="evaluation")),
                            calendar, "wm_yr_wk")
    cells = melt(sales, ["id"], day_columns(sales), "variable", "quantity").withColumnRenamed("id", "id2")
    other = inner_join_on(cells, dated, [("variable", "d"), ("id2", "id")]).select(
        "store_id", dept_key("item_id").alias("dept_id"), day_index("variable").alias("day"), "date",
        revenue("quantity", "sell_price").alias("sales"))
    other = other.groupBy("store_id", "dept_id", "day", "date").agg(F.round(F.sum("sales"), 2).alias("sales"))
    ours = sales_by_day(sales, prices, calendar).withColumn("sales", F.round("sales", 2)).select(*other.columns)
    assert ours.count() == other.count() > 0
    assert ours.exceptAll(other).count() == 0 and other.exceptAll(ours).count() == 0


def test_calendar_table_join_equals_inline_calendar(spark):
    from tidecast.sources.retail import calendar_for_days

    inline = fe.daily_sales(spark, SF_SMALL)
    bare = inline.select(*fe.SERIES, fe.TIME, "sales")
    joined = fe.with_calendar(bare, calendar_for_days(bare, fe.TIME))
    cols = inline.columns
    a, b = inline.select(*cols), joined.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
