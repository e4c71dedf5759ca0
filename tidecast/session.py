"""Session factory and shared-folder discipline.

Lineage is cut with ``DataFrame.checkpoint()`` or with tables written below
the folder the cluster names in ``spark.checkpoint.dir``. We only pick our own
folder when that setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours runs with. AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark's default; queries over long texts lower it for themselves.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidecast",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_code(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (the pandas
    functions of the Fourier fit live in it): zip it once per application
    and register the archive with ``addPyFile``, as ``--py-files`` would."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="tidecast-code-")
    archive = os.path.join(staging, "tidecast.zip")
    root = os.path.dirname(package_dir)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context); only when neither exists do we create one, as tests do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidecast-ckpt-")
    sc.setCheckpointDir(configured)
    # Spark appends a per-application sub folder; report what it uses.
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it back.
    Later fits and queries read the files (pruned and filtered there), and a
    lost executor does not send them back to the source."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_REMOVING, _REMOVERS = threading.Lock(), {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A query that is run inside removes its shuffle files at its end; else
    they stay until the driver happens to collect its garbage. For writes,
    whose rows are read from the files they leave. Threads may be inside side
    by side: the last one to leave restores the setting."""
    with _REMOVING:
        inside, before = _REMOVERS.get(spark, (0, None))
        if not inside:
            before = spark.conf.get(_REMOVE, None)
            spark.conf.set(_REMOVE, "true")
        _REMOVERS[spark] = inside + 1, before
    try:
        yield
    finally:
        with _REMOVING:
            inside, before = _REMOVERS.pop(spark)
            if inside > 1:
                _REMOVERS[spark] = inside - 1, before
            elif before is None:
                spark.conf.unset(_REMOVE)
            else:
                spark.conf.set(_REMOVE, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
