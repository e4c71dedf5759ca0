import pytest
from pyspark.sql import functions as F

from tidecast.session import scratch_path
from tidecast.sources.files import (named_schema, read_csv, read_csv_by_name, read_parquet, write_csv,
                                    write_parquet)
from tidecast.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_csv_roundtrip_keeps_types(spark):
    lines = read_table(spark, SF_SMALL, "lineitem")
    path = write_csv(lines, scratch_path(spark, "t-csv"))
    back = read_csv(spark, path, lines.schema)
    assert back.schema == lines.schema
    assert back.exceptAll(lines).count() == 0 and lines.exceptAll(back).count() == 0


def test_csv_malformed_row_fails_fast(spark):
    path = scratch_path(spark, "bad-csv")
    spark.createDataFrame([("1", "x")], "a string, b string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        read_csv(spark, path, "a int, b int").collect()


def test_partitioned_parquet_sink_prunes(spark):
    df = read_table(spark, SF_SMALL, "orders", ["o_orderkey", "o_orderpriority"])
    path = write_parquet(df, scratch_path(spark, "t-pq"), partition_by=["o_orderpriority"])
    back = read_parquet(spark, path)
    urgent = back.where(F.col("o_orderpriority") == "1-URGENT")
    assert urgent.count() == df.where(F.col("o_orderpriority") == "1-URGENT").count()
    assert back.count() == df.count()


def test_unknown_table_rejected(spark):
    with pytest.raises(ValueError):
        read_table(spark, SF_SMALL, "nope")


def _csv(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_csv_by_name_binds_types_to_names(spark, tmp_path):
    folder = _csv(tmp_path, a=["x,when,d_2,d_10,n", '"q, r",2016-01-02,2,10.5,7', ",,,,"])
    rows, rejected = read_csv_by_name(spark, folder, {"n": "int", "when": "date"}, {r"d_\d+": "double"})
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [
        ("n", "int"), ("when", "date"), ("d_2", "double"), ("d_10", "double")]
    assert {tuple(map(str, r)) for r in rows.collect()} == {("7", "2016-01-02", "2.0", "10.5"), ("None",) * 4}
    assert rejected.count() == 0 and rejected.columns == ["file", "record"]


def test_csv_by_name_sets_bad_records_apart(spark, tmp_path):
    bad = ["q,soon,1,2", "q,2016-01-01,1", "q,2016-01-01,1,2,3", "q,2016-01-01,one,2"]
    folder = _csv(tmp_path, a=["x,when,d_1,n", "q,2016-01-01,1,2", *bad])
    rows, rejected = read_csv_by_name(spark, folder, {"n": "int", "when": "date"}, {r"d_\d+": "double"})
    assert rows.count() == 1 and rows.select("n").count() == 1  # whatever is selected
    assert sorted(r["record"] for r in rejected.collect()) == sorted(bad)
    assert all(r["file"].endswith("a.csv") for r in rejected.collect())


def test_csv_by_name_refuses_other_headers(spark, tmp_path):
    folder = _csv(tmp_path, a=["x,n", "q,1"])
    with pytest.raises(ValueError, match="missing_one"):
        read_csv_by_name(spark, folder, {"missing_one": "int"})
    other = tmp_path / "two"
    other.mkdir()
    two = _csv(other, a=["x,n", "q,1"], b=["n,x", "2,q"])
    with pytest.raises(Exception):
        read_csv_by_name(spark, two, {"n": "int", "x": "string"})[0].collect()


def test_header_that_names_a_column_twice():
    with pytest.raises(ValueError, match="twice"):
        named_schema(["a", "b", "a"], {"b": "int"}, {})
    assert named_schema(["d_1", "a", "z"], {"a": "int"}, {r"d_\d+": "double"}).simpleString() == \
        "struct<d_1:double,a:int,z:string>"


CALENDAR_HEAD = ("date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,"
                 "snap_CA,snap_TX,snap_WI")


def test_retail_files_of_the_real_shape(spark, tmp_path):
    """14 calendar columns, six leading sales columns, one column a day: read,
    rejected records told apart, and summed with the calendar attached."""
    from tidecast.plans.wide import read_retail, sales_by_day

    _csv(tmp_path, sales=["id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_9",
                          "FOODS_1_001_CA_1_evaluation,FOODS_1_001,FOODS_1,FOODS,CA_1,CA,3,0,2",
                          "FOODS_1_002_CA_1_evaluation,FOODS_1_002,FOODS_1,FOODS,CA_1,CA,1,1,1",
                          "FOODS_1_003_CA_1_evaluation,FOODS_1_003,FOODS_1,FOODS,CA_1,CA,many,1,1"],
         prices=["store_id,item_id,wm_yr_wk,sell_price", "CA_1,FOODS_1_001,11101,2.0", "CA_1,FOODS_1_001,11102,2.5",
                 "CA_1,FOODS_1_002,11101,10"],
         calendar=[CALENDAR_HEAD, "2011-01-29,11101,Saturday,1,1,2011,d_1,,,,,0,0,0",
                   "2011-01-30,11101,Sunday,2,1,2011,d_2,SuperBowl,Sporting,,,1,0,1",
                   "2011-02-06,11102,Sunday,2,2,2011,d_9,,,,,1,1,1", "2011-02-07,11102,Monday,3,2,2011"])
    files = read_retail(spark, *[f"{tmp_path}/{n}.csv" for n in ("sales", "prices", "calendar")])
    assert {r["table"]: r["n"] for r in files.rejected.groupBy("table").agg(F.count("record").alias("n")).collect()} == {
        "sales": 1, "calendar": 1}
    days = {r["day"]: r for r in sales_by_day(files.sales, files.prices, files.calendar).collect()}
    assert {d: r["sales"] for d, r in days.items()} == {1: 16.0, 2: 10.0, 9: 5.0}
    assert (days[2]["event_name_1"], days[2]["snap_CA"], days[1]["event_name_1"], days[9]["wm_yr_wk"]) == (
        "SuperBowl", 1, None, 11102)
    assert {(r["store_id"], r["dept_id"]) for r in days.values()} == {("CA_1", "FOODS_1")}


def test_csv_in_bounded_files(spark):
    lines = read_table(spark, SF_SMALL, "lineitem").repartition(1)
    path = write_csv(lines, scratch_path(spark, "t-csv-parts"), most_rows=1000)
    back, files = read_csv(spark, path, lines.schema), spark.read.text(path).groupBy(F.input_file_name()).count()
    assert back.count() == lines.count() and back.exceptAll(lines).count() == 0
    assert files.where("count > 1001").count() == 0 and files.count() == -(-lines.count() // 1000)
    assert all(r[0].endswith(".csv.gz") for r in files.collect())
