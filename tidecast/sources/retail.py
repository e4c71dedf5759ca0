"""Retail roles over the driver-generated order tables.

    store       = region name of the line's supplier (supplier -> nation -> region)
    department  = part type
    item        = part key
    day         = days from 1995-01-01 to the ship date, plus 1
    quantity    = line quantity, sell price = part retail price
    calendar    = attributes of each date in the shipped date range

The line table is the fact table; it is only ever scanned once, with just
the four columns it contributes, and every dimension is joined to it by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.columns import day_number, saturday_wday
from tidecast.sources.tables import read_table

DAY_ORIGIN = "1995-01-01"

# Calendar events by month-day (name, type) for the first and
# second event slot, and the days of the month with SNAP benefits per state.
# They define this fixture's calendar.
EVENTS_1 = {
    "01-01": ("NewYear", "National"),
    "02-14": ("ValentinesDay", "Cultural"),
    "03-17": ("StPatricksDay", "Cultural"),
    "07-04": ("IndependenceDay", "National"),
    "10-31": ("Halloween", "Cultural"),
    "11-11": ("VeteransDay", "National"),
    "12-24": ("ChristmasEve", "Religious"),
    "12-25": ("Christmas", "National"),
}
EVENTS_2 = {
    "07-04": ("Fireworks", "Cultural"),
    "12-25": ("OrthodoxAdvent", "Religious"),
}
SNAP_DAYS = {
    "snap_CA": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10),
    "snap_TX": (1, 3, 5, 6, 7, 9, 11, 12, 15),
    "snap_WI": (2, 3, 5, 6, 8, 9, 11, 12, 14, 15),
}


def store_of_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, store_id): supplier joined to its nation's region."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation_region = nation.join(region,
                                F.col("n_regionkey") == F.col("r_regionkey"))
    return supplier.join(
        nation_region,
        F.col("s_nationkey") == F.col("n_nationkey"),
    ).select("s_suppkey", F.col("r_name").alias("store_id"))


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line:
    (store_id, dept_id, item_id, date, day, quantity, sell_price, sales)."""
    lines = read_table(spark, sf_dir, "lineitem",
                       ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_retailprice"])
    stores = store_of_supplier(spark, sf_dir)
    joined = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    date = F.to_date("l_shipdate")
    return joined.select(
        "store_id",
        F.col("p_type").alias("dept_id"),
        F.col("p_partkey").alias("item_id"),
        date.alias("date"),
        day_number(date, DAY_ORIGIN).alias("day"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("sell_price"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("sales"),
    )


def _lookup(month_day, table: dict, slot: int):
    """CASE over integer month*100+day keys (cheaper to generate and run than
    comparing formatted date strings)."""
    expr = None
    for key, value in table.items():
        month, day = key.split("-")
        cond = month_day == F.lit(int(month) * 100 + int(day))
        expr = F.when(cond, F.lit(value[slot])) if expr is None else expr.when(cond, F.lit(value[slot]))
    return expr.otherwise(F.lit(None).cast("string"))


def calendar_for_days(df: DataFrame, day_col: str = "day") -> DataFrame:
    """One row per day between the first and last day number in ``df``.

    Only a one-row min/max aggregate is computed over the input; the days
    are generated from it, so the table's size is the length of the date
    range, whatever the input volume.
    """
    bounds = df.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("_day"))
    dates = days.select(F.date_add(F.lit(DAY_ORIGIN).cast("date"), F.col("_day") - 1).alias("date"))
    return calendar_attributes(dates, "date")


def calendar_columns(date) -> dict:
    """Calendar attributes of a date column, as named expressions."""
    d = date
    md = F.month(d) * 100 + F.dayofmonth(d)
    dom = F.dayofmonth(d)
    day = day_number(d, DAY_ORIGIN)
    cols = {
        "date": d,
        "day": day,
        "d": F.concat(F.lit("d_"), day.cast("string")),
        # Week number, weeks starting on Saturday (day 1, 1995-01-01, is a Sunday).
        "wm_yr_wk": (F.floor(day / 7) + 1).cast("int"),
        "weekday": F.date_format(d, "EEEE"),
        "wday": saturday_wday(d),
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
        "event_name_1": _lookup(md, EVENTS_1, 0),
        "event_type_1": _lookup(md, EVENTS_1, 1),
        "event_name_2": _lookup(md, EVENTS_2, 0),
        "event_type_2": _lookup(md, EVENTS_2, 1),
    }
    for name, days in SNAP_DAYS.items():
        cols[name] = dom.isin(*days).cast("int")
    return cols


def calendar_attributes(df: DataFrame, date_col: str = "date") -> DataFrame:
    cols = calendar_columns(F.col(date_col))
    return df.select(*[cols[c].alias(c) for c in CALENDAR_COLUMNS])


CALENDAR_COLUMNS = [
    "date", "day", "d", "wm_yr_wk", "weekday", "wday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
]
