"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. AQE re-plans joins at runtime (broadcast only when the
# measured side is small, split skewed partitions, coalesce small ones).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Defaults for large inputs (the spark-submit entry point applies them unless the
# deployment sets its own). Partitions are sized for memory, not core count: scans split
# at 256 MB, shuffles start wide (AQE coalesces to ~256 MB per reducer) so a 100 TB join
# does not spill per task, skewed partitions above 5x the median and 1 GB are split.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.broadcastTimeout": "1200",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(master: str | None = None, app: str = "culvert",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session. On a cluster, pass master=None and let spark-submit decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_spark(app: str = "culvert") -> SparkSession:
    """Session for spark-submit: CLUSTER_CONF for every key the deployment left unset."""
    from pyspark import SparkConf, SparkContext
    SparkContext._ensure_initialized()      # gateway up, so defaults come from the JVM
    given = SparkConf(loadDefaults=True)    # spark-submit --conf and spark-defaults.conf
    extra = {k: v for k, v in CLUSTER_CONF.items() if not given.contains(k)}
    return get_spark(None, app=app, extra=extra)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it (a folder that every executor reaches); a folder of our own is made only
    where the driver is the only machine (``local`` masters, as in tests).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="culvert-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the tables that the innermost ``scratch`` or ``settle`` has materialised.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted when its execution ends, not at some later collection on the driver.
    A DataFrame that was run inside has to be built anew to run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, by: str | None = None) -> DataFrame:
    """Computed once, as a compressed table in the shared checkpoint folder; the shuffles it took are deleted. The table stays
    until the end of the ``scratch`` or ``settle`` around it; without one, as long as that folder. With ``by`` the rows lie
    in buckets of that column, as many as a shuffle has partitions, so that a join on it does not shuffle them again."""
    spark = df.sparkSession
    name = f"made-{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_dir(spark), name)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    with tidy(spark):
        if by is None:
            df.write.option("compression", "zstd").parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, by).saveAsTable(_table(path))
        return spark.table(_table(path))


def _table(path: str) -> str:
    return os.path.basename(path).replace("-", "_")


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end, and shuffles as soon as they were used."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        with tidy(spark):
            yield
    finally:
        _MADE.reset(outer)
        _delete(spark, made)


def settle(build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    """``build()`` materialised (in buckets of ``by``); the tables materialised on the way to it are deleted."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        df = build()
    finally:
        _MADE.reset(outer)
    out = materialise(df, by)
    _delete(df.sparkSession, made)
    return out
