"""Written tables leave no shuffle files behind."""

import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidecast import session
from tidecast.llm.common import written


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("write", [session.materialize, written])
def test_written_tables_leave_no_shuffles(spark, write):
    before = shuffle_files(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    table = write(sums.join(sums.groupBy("k").count(), "k"), "t-shuffles")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.count() == 7 and sums.count() == 7


def test_setting_is_restored_after_all_threads(spark):
    old = spark.conf.get(session._REMOVE, None)

    def inside(_):
        with session.shuffles_removed(spark):
            time.sleep(0.05)
            return spark.conf.get(session._REMOVE)

    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(inside, range(12))) == {"true"}
    assert spark.conf.get(session._REMOVE, None) == old
    with pytest.raises(ValueError), session.shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(session._REMOVE, None) == old
