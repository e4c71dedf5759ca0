"""The wide job: a wide file costs the driver little, cells meet their prices
where they are made, and the lines of the file hold every day."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.test_session import shuffle_files
from tidecast.operators.reshape import column_numbers, melt, pack
from tidecast.plans import catalog, wide
from tidecast.plans.wide import prices_by_week, sales_by_day, wide_tables
from tidecast.sources.files import read_csv_by_name


def test_wide_file_makes_few_columns(spark, tmp_path, monkeypatch):
    days = [f"d_{i}" for i in range(400)]
    (tmp_path / "a.csv").write_text(",".join(["id", *days]) + "\n" + ",".join(["q", *["1"] * 400]) + "\n"
                                    + ",".join(["bad", *["1"] * 399, "x"]) + "\n")
    made = []
    for name in ("col", "lit"):
        make = getattr(F, name)
        monkeypatch.setattr(F, name, lambda c, make=make: (made.append(c), make(c))[1])
    rows, rejected = read_csv_by_name(spark, str(tmp_path), {"id": "string"}, {r"d_\d+": "double"})
    cells = melt(rows, ["id"], days)
    assert cells.agg(F.sum("value"), F.count_distinct("variable")).first()[:] == (400.0, 400)
    assert rejected.count() == 1 and len(made) < 50


def test_packed_cells_are_melted_alike(spark):
    names = [f"d_{i}" for i in (3, 1, 2)]
    df = spark.createDataFrame([(1, 1.0, None, 3.0), (2, 4.0, 5.0, 6.0)], "id int, d_3 double, d_1 double, d_2 double")
    plain = {(r[0], r[1]): r[2] for r in melt(df, ["id"], names).collect()}
    got = melt(pack(df, ["id"], names), ["id"], names, packed="cells", at_name="at").collect()
    assert {(r[0], r[1]): r[2] for r in got} == plain and len(got) == 6
    assert {(r["variable"], r["at"]) for r in got} == {tuple(r) for r in column_numbers(df, names, "v", "at").select("v", "at").collect()}


CALENDAR = ("date date, wm_yr_wk int, weekday string, wday int, month int, year int, d string, event_name_1 string, "
            "event_type_1 string, event_name_2 string, event_type_2 string, snap_CA int, snap_TX int, snap_WI int")


def _small(spark):
    days = [(datetime.date(2016, 1, i), 1 + i // 3, "x", 1, 1, 2016, f"d_{i}", None, None, None, None, 0, 0, 0) for i in range(1, 5)]
    sales = spark.createDataFrame(
        [("F_1_1_S_evaluation", 1.0, 2.0, 4.0, 8.0), ("F_1_1_S_evaluation", 1.0, None, 0.0, 0.0), (None, 9.0, 9.0, 9.0, 9.0),
         ("F_1_2_S_evaluation", 9.0, 9.0, 9.0, 9.0)], "id string, d_1 double, d_2 double, d_3 double, d_5 double")
    prices = spark.createDataFrame(
        [("S", "F_1_1", 1, 10.0), ("S", "F_1_1", 1, 100.0), ("S", "F_1_1", 2, None), ("S", "F_1_1", None, 7.0), ("S", None, 1, 7.0),
         ("S", "F_1_3", 1, 7.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return sales, prices, spark.createDataFrame(days, CALENDAR)


def test_every_price_of_a_week_counts(spark):
    got = {(r["store_id"], r["dept_id"], r["day"]): r["sales"] for r in sales_by_day(*_small(spark)).collect()}
    assert got == {("S", "F_1", 1): 220.0, ("S", "F_1", 2): 220.0, ("S", "F_1", 3): None}


def test_prices_meet_lines_not_cells(spark, capsys):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        sales_by_day(*_small(spark)).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = capsys.readouterr().out
    assert plan.index("posexplode(cells") < plan.index("SortMergeJoin [id") and "hashpartitioning(at#" not in plan
    one = prices_by_week(_small(spark)[1]).where("series = 'F_1_1_S_evaluation'").first()
    assert {w: sorted(p["sell_price"] or 0.0 for p in ps) for w, ps in one["by_week"].items()} == {1: [10.0, 100.0], 2: [0.0]}


def test_lines_of_the_file_hold_every_day(spark, tmp_path):
    day = lambda i: datetime.datetime(1995, 1, i)
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, 0)], "n_nationkey int, n_regionkey int"),
        "supplier": ([(1, 0)], "s_suppkey long, s_nationkey int"),
        "part": ([(1, "Brand#11", 2.0), (2, "Brand#12", 3.0)], "p_partkey long, p_brand string, p_retailprice double"),
        "lineitem": ([(1, 1, 5.0, day(3)), (1, 1, 2.0, day(3)), (1, 1, 1.0, day(7)), (2, 1, 4.0, day(5)), (2, 1, None, day(6)),
                      (2, 1, 4.0, None)], "l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp"),
    }
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    sales, _, _ = wide_tables(spark, str(tmp_path))
    got = {r["item_id"]: [r[f"d_{i}"] for i in range(3, 8)] for r in sales.collect()}
    assert got == {"Brand_11_1": [7.0, 0.0, 0.0, 0.0, 1.0], "Brand_12_2": [0.0, 0.0, 4.0, 0.0, 0.0]}
    assert [c for c in sales.columns if c.startswith("d_")] == [f"d_{i}" for i in range(3, 8)]


def _order_tables(spark, path, n=400):
    day = lambda i: datetime.datetime(1995, 1, 1) + datetime.timedelta(days=i)
    rows = [(i % 40, i % 4, float(i % 9), day(i * 7919 % 2500)) for i in range(n)] + [(1, 1, None, day(2499)), (None, 1, 1.0, day(0))]
    for name, kind, some in (
            ("region", "r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
            ("nation", "n_nationkey int, n_regionkey int", [(0, 0), (1, 1)]),
            ("supplier", "s_suppkey long, s_nationkey int", [(i, i % 2) for i in range(4)]),
            ("part", "p_partkey long, p_brand string, p_retailprice double",
             [*[(i, f"Brand#{i % 5}", 2.0 + i) for i in range(40)], (3, "Brand#3", 50.0)]),
            ("lineitem", "l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp", rows)):
        spark.createDataFrame(some, kind).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_written_lines_are_small_and_in_bounded_files(spark, tmp_path, monkeypatch):
    sf = _order_tables(spark, tmp_path / "tables")
    monkeypatch.setattr(wide, "FILE_BYTES", 51_000)
    before = shuffle_files(spark)
    paths = {k: p.removeprefix("file:") for k, p in wide.write_retail(spark, sf).items()}
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    files = [f for f in os.listdir(paths["sales"]) if f.startswith("part-")]
    held = sum(os.path.getsize(f"{paths['sales']}/{f}") for f in files)
    lines = spark.read.text(paths["sales"]).where("value not like 'id,%'")
    assert lines.count() == 40 and held < lines.agg(F.sum(F.length("value"))).first()[0] / 4
    assert len(files) >= 4 and len([f for f in os.listdir(paths["prices"]) if f.startswith("part-")]) >= 1
    tables = wide.read_retail(spark, **paths)
    assert tables.sales.count() == 40 and tables.rejected.count() == 0
    want = spark.read.parquet(f"{sf}/lineitem.parquet").alias("l").join(spark.read.parquet(f"{sf}/part.parquet"), F.expr("l_partkey = p_partkey")) \
        .agg(F.sum("l_quantity")).first()[0]
    days = [c for c in tables.sales.columns if c.startswith("d_")]
    assert melt(tables.sales, ["id"], days).agg(F.sum("value")).first()[0] == want


def test_prices_are_dealt_without_their_series(spark, capsys):
    prices = _small(spark)[1]
    prices_by_week(prices).explain()
    plan = capsys.readouterr().out
    dealt = plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1 and "AS series" not in dealt and "hashpartitioning(concat(" in dealt


@pytest.mark.parametrize("query", ["wide_features", "wide_model_choice"])
def test_daily_table_of_the_job_leaves_no_shuffles(spark, tmp_path, monkeypatch, query):
    """Both begin with the daily table from files; nothing else is run here."""
    sf, kept = _order_tables(spark, tmp_path / "tables"), {}

    def stop(daily, *_):
        kept["daily"] = daily
        raise StopIteration

    monkeypatch.setattr(catalog.fe, "feature_set", stop)
    before = shuffle_files(spark)
    with pytest.raises(StopIteration):
        catalog.QUERIES[query](spark, sf)
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and kept["daily"].count() > 0
