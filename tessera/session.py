"""SparkSession construction and shared-storage helpers.

The library never assumes it owns the session: every operator works on the
session of the DataFrame it is given.  ``get_session`` is a convenience for
scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for.  None of them is required for
# correctness (all date casts are time-zone free, all divisions are
# ``try_divide``), they are what a production job would set.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``; ``extra`` adds settings, such as the driver memory
    of a local run."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A scratch folder is made only where the setting is missing and the master
    is local (tests); a cluster without the setting is an error, since a
    machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="tessera-shared-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


@contextmanager
def _without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are removed when it ends, not when the driver's heap is next collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_WRITTEN: list[tuple[str, str]] = []             # (path, name of its table or ""), in order of writing


def materialize(df: DataFrame, rebalance: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (nothing upstream runs again when an executor is lost,
    or when several passes read it) and keeps columns prunable.  With
    ``rebalance``, for narrow tables, the rows are dealt to a few files of even
    size first, as many as AQE finds fit, instead of one small file per task.
    The folder stays until ``intermediates`` or the owner of the shared folder removes it.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    _WRITTEN.append((path, ""))
    with _without_leftovers(df.sparkSession):
        (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def series_table(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` written once, in as many buckets by ``keys`` as there are shuffle partitions, sorted
    within each, and read back as that table: windows by (more than) ``keys`` need no exchange.

    Rows that come partitioned by ``keys`` already, as from a window, leave one file per bucket.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tessera_{time.time_ns():016x}_{uuid.uuid4().hex}"       # listed in order of writing
    path = f"{shared_folder(spark)}/{name}"
    _WRITTEN.append((path, name))
    with _without_leftovers(spark):
        df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).saveAsTable(name)
    return spark.table(name)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Owns what ``materialize`` and ``series_table`` write inside: removed at the end, when no
    DataFrame made inside may be read any more."""
    first = len(_WRITTEN)
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path, name in _WRITTEN[first:]:
            if name:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        del _WRITTEN[first:]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
