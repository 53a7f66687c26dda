"""Shared helpers of the operators: shipping the package to executors, reading, writing to the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import tempfile
import uuid
import weakref
import zipfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.session import checkpoint_dir

#: Packages already shipped, by application id.
_SHIPPED: set[str] = set()


#: Bytes that Spark hands to a Python worker at once, unless the deployment sets it: it bounds the memory of every worker.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (as ``--py-files`` would), and bound the batches they get."""
    sc = spark.sparkContext
    if not sc.getConf().contains(BATCH_BYTES[0]):
        spark.conf.set(*BATCH_BYTES)
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="culvert-ship-"), "culvert.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("culvert", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where each stored table lies, and all that are not discarded yet.
_PLACE: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_LIVE: set[str] = set()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/culvert-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    _PLACE[got] = path
    _LIVE.add(path)
    return got


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _LIVE.discard(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables from which everything that is needed has been stored elsewhere by now."""
    for df in tables:
        if df in _PLACE:
            delete(df.sparkSession, _PLACE.pop(df))


#: Tables that the steps of a chain have left.
_LEFT: set[str] = set()


def step(fn):
    """A step of a chain whose results are each written elsewhere before the next step starts: ``fn(spark, docs, ..)``, which
    first deletes the tables that earlier steps have stored on their way."""

    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, *args):
        for path in _LEFT & _LIVE:
            delete(spark, path)
        _LEFT.clear()
        before = set(_LIVE)
        out = fn(spark, docs, *args)
        _LEFT.update(_LIVE - before)
        return out

    return run


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key long, text) with null texts empty; other columns are dropped, so their names cannot clash."""
    ship(df.sparkSession)
    return df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def tidy() -> None:
    """Give freed memory of this worker back to the machine; allocators would keep it beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20):
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least), so temporaries stay bounded."""
    if batch.num_rows == 0:
        return
    col = batch.column(column)
    sizes = pc.binary_length(col).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, s in enumerate(sizes):
        if i > start and total + s > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += s
    yield batch.slice(start)
    tidy()
