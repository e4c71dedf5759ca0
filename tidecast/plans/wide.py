"""The retail job from its own inputs: wide sales, prices and a calendar, CSV
files with a header, read by column name.

``sales_by_day`` joins the prices of a series to its line of sales, melts the
lines, gives each cell its calendar week and the price of that week, and sums
revenue by store, department and day. Prices meet the wide lines, one map by
week for each series, not the cells: a series has thousands of cells, and they
would all be shuffled to meet their (series, week); so they stay where they
are made. The attributes of a day are attached after the sum, so the rows that
are shuffled carry three keys and a number.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.columns import day_index, day_number, dept_key, revenue, series_key
from tidecast.operators.joins import inner_join_on
from tidecast.operators.reshape import column_numbers, day_columns, melt, pack
from tidecast.operators.stages import DailySum
from tidecast.plans.features import SERIES, TIME, with_calendar
from tidecast.session import materialize, scratch_path, shuffles_removed
from tidecast.sources.files import read_csv_by_name, write_csv
from tidecast.sources.retail import CALENDAR_COLUMNS, DAY_ORIGIN, calendar_for_days, store_of_supplier
from tidecast.sources.tables import read_table

# The column names of the dataset's files and their types.
CALENDAR = {
    "date": "date", "wm_yr_wk": "int", "weekday": "string", "wday": "int", "month": "int", "year": "int",
    "d": "string", "event_name_1": "string", "event_type_1": "string", "event_name_2": "string",
    "event_type_2": "string", "snap_CA": "int", "snap_TX": "int", "snap_WI": "int",
}
PRICES = {"store_id": "string", "item_id": "string", "wm_yr_wk": "int", "sell_price": "double"}
SALES = {"id": "string", "item_id": "string", "dept_id": "string", "cat_id": "string", "store_id": "string",
         "state_id": "string"}
DAYS = {r"d_\d+": "double"}
#: Text in a file that is written compressed, about.
FILE_BYTES = 64_000_000


@dataclass
class RetailFiles:
    """The three tables, and the records of their files that could not be read:
    ``rejected(table, file, record)``."""

    sales: DataFrame
    prices: DataFrame
    calendar: DataFrame
    rejected: DataFrame


def read_retail(spark: SparkSession, sales: str, prices: str, calendar: str) -> RetailFiles:
    """Read the three files (or folders of files) by their headers."""
    read = {"sales": read_csv_by_name(spark, sales, SALES, DAYS), "prices": read_csv_by_name(spark, prices, PRICES),
            "calendar": read_csv_by_name(spark, calendar, CALENDAR)}
    rejected = reduce(DataFrame.unionByName, [bad.select(F.lit(name).alias("table"), "file", "record")
                                              for name, (_, bad) in read.items()])
    return RetailFiles(*[rows for rows, _ in read.values()], rejected)


def write_retail(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Files of the dataset's shape made from the order tables: one column for
    each day from the first to the last ship date, one price for each item,
    store and week with a sale, one calendar row for each day. Returns paths."""
    lines = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_retailprice"])
    item = F.concat_ws("_", F.regexp_replace("p_brand", "#", "_"), F.col("p_partkey").cast("string"))
    sold = materialize(
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(store_of_supplier(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("store_id", item.alias("item_id"), "p_retailprice", day_number("l_shipdate", DAY_ORIGIN).alias("day"))
        .agg(F.sum("l_quantity").cast("double").alias("quantity")), "sold")
    with shuffles_removed(spark):
        first, last = sold.agg(F.min("day"), F.max("day")).first()
    days = [f"d_{i}" for i in range(first, last + 1)] if first is not None else ["d_1"]

    # A line of the wide file is put together from the days of a series with a
    # sale and the runs of zeros between them: a pivot would plan an expression
    # for each of the thousands of columns, a lookup for each cell. The sums of
    # a series are few (its days), so they are dealt once, by series.
    dealt = sold.repartition("store_id", "item_id")
    known = F.when(F.col("day").isNotNull(), F.struct("day", "quantity"))
    series = dealt.groupBy("store_id", "item_id", "day").agg(F.sum("quantity").alias("quantity")) \
        .groupBy("store_id", "item_id").agg(F.array_sort(F.collect_list(known)).alias("_days"))
    start = F.lit((first or 1) - 1)
    zeros = lambda after, until: F.repeat(F.lit(",0"), until - after - 1)
    cells = F.transform("_days", lambda s, i: F.concat(
        zeros(F.coalesce(F.get("_days", i - 1)["day"], start), s["day"]), F.lit(","),
        F.coalesce(s["quantity"], F.lit(0.0)).cast("string")))
    tail = zeros(F.coalesce(F.try_element_at("_days", F.lit(-1))["day"], start), F.lit((last or 1) + 1))
    leading = [series_key("item_id", "store_id", suffix="evaluation"), F.col("item_id"), dept_key("item_id"),
               F.split_part("item_id", F.lit("_"), F.lit(1)), F.col("store_id"), F.left("store_id", F.lit(2))]
    wide = series.select(F.concat(F.concat_ws(",", *leading), F.array_join(cells, ""), tail).alias(",".join([*SALES, *days])))
    week = (F.floor(F.col("day") / 7) + 1).cast("int")
    # In the order of the dataset's file, which also packs best.
    prices = dealt.select("store_id", "item_id", week.alias("wm_yr_wk"),
                          (F.col("p_retailprice") + week % 3).alias("sell_price")).distinct() \
        .sortWithinPartitions("store_id", "item_id", "wm_yr_wk")
    calendar = calendar_for_days(sold.select("day")) if first is not None else calendar_for_days(
        spark.range(1).select(F.lit(1).alias("day")))
    # Lines are mostly zeros, two characters a day. One column named like the
    # whole header; no value holds the separator.
    paths = {"sales": scratch_path(spark, "sales")}
    with shuffles_removed(spark):
        wide.write.options(header=True, sep="\x01", compression="gzip",
                           maxRecordsPerFile=max(1, FILE_BYTES // (2 * len(days) + 100))).csv(paths["sales"])
        for name, table, columns in (("prices", prices, PRICES), ("calendar", calendar, CALENDAR)):
            paths[name] = write_csv(table.select(*columns), scratch_path(spark, name), most_rows=FILE_BYTES // 40)
    return paths


def wide_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sales, prices, calendar) written by :func:`write_retail` and read back."""
    files = read_retail(spark, **write_retail(spark, sf_dir))
    return files.sales, files.prices, files.calendar


def prices_by_week(prices: DataFrame) -> DataFrame:
    """(series, store_id, dept_id, by_week): of each item in a store a map from
    week to its prices, as a week may have more than one."""
    item, series = ["series", "store_id", "item_id"], series_key("item_id", "store_id", suffix="evaluation")
    # Dealt by series without it: it holds no more than the two columns beside it.
    known = prices.select("store_id", "item_id", F.col("wm_yr_wk").alias("week"), "sell_price") \
        .where(series.isNotNull() & F.col("week").isNotNull()).repartition(series).withColumn("series", series)
    return known.groupBy(*item, "week").agg(F.collect_list(F.struct("sell_price")).alias("prices")) \
        .groupBy(*item).agg(F.map_from_entries(F.collect_list(F.struct("week", "prices"))).alias("by_week")) \
        .select("series", "store_id", dept_key("item_id").alias("dept_id"), "by_week")


def sales_by_day(sales: DataFrame, prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """(store_id, dept_id, day, calendar attributes, sales). A cell without a
    price or a calendar row counts for nothing."""
    days = day_columns(sales)
    # Spark takes an array for small whatever it holds, and would broadcast it.
    priced = inner_join_on(pack(sales, ["id"], days), prices_by_week(prices).hint("merge"), [("id", "series")])
    cells = melt(priced, [*SERIES, "by_week"], days, "variable", "quantity", packed="cells", at_name="at")
    # The calendar finds its columns by name, a cell its column by number. This
    # table is as long as the file is wide, so it goes to the cells.
    weeks = inner_join_on(column_numbers(sales, days, "variable", "at"), calendar.select("d", "wm_yr_wk"), [("variable", "d")]) \
        .select(F.col("at").alias("column"), "wm_yr_wk", day_index("variable").alias(TIME))
    dated = inner_join_on(cells, F.broadcast(weeks), [("at", "column")])
    lines = dated.select(*SERIES, TIME, "quantity", F.inline(F.try_element_at("by_week", F.col("wm_yr_wk")))) \
        .select(*SERIES, TIME, revenue("quantity", "sell_price").alias("sales"))
    daily = DailySum(inputCol="sales", outputCol="sales", groupCols=[*SERIES, TIME]).transform(lines)
    return with_calendar(daily, calendar.withColumn(TIME, day_index("d"))).select(
        *SERIES, TIME, *[c for c in CALENDAR_COLUMNS if c != TIME], "sales")
