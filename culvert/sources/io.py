"""Scans and sinks: typed source scans, versioned snapshots, appends, the change feed.

Parquet tables have no MERGE, so state is kept as versioned snapshot directories:
``<table>/v=<n>/`` written whole, plus a ``_COMMITTED`` marker file. A reader takes
the highest committed version; a writer that finds its version committed skips the
write, which makes a replayed micro-batch a no-op.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tidy
from .schemas import FEED_SCHEMA, SOURCE_SCHEMAS


def load_sources(spark: SparkSession, base: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Scan each source relation from ``<base>/<name>`` with its declared schema (no
    inference). Column pruning and filters reach the parquet scan through Catalyst."""
    out = {}
    for n in names or list(SOURCE_SCHEMAS):
        out[n] = spark.read.schema(SOURCE_SCHEMAS[n]).parquet(os.path.join(base, n))
    return out


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def _touch(spark: SparkSession, path: str) -> None:
    fs, p, _ = _hadoop_fs(spark, path)
    fs.create(p, True).close()


def mark(spark: SparkSession, path: str, text: str) -> None:
    """Write the commit marker of a version folder, with a note."""
    fs, p, _ = _hadoop_fs(spark, os.path.join(path, "_COMMITTED"))
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def marker(spark: SparkSession, path: str) -> str:
    """The note of a version's marker."""
    fs, p, jvm = _hadoop_fs(spark, os.path.join(path, "_COMMITTED"))
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def drop_version(spark: SparkSession, table_dir: str, version: int) -> None:
    """Remove an old version, its marker first."""
    path = version_path(table_dir, version)
    fs, p, jvm = _hadoop_fs(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(p, "_COMMITTED"), False)
    fs.delete(p, True)


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _hadoop_fs(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds."""
    fs, p, _ = _hadoop_fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def version_path(table_dir: str, version: int) -> str:
    return os.path.join(table_dir, f"v={version:012d}")


def committed_versions(spark: SparkSession, table_dir: str) -> list[int]:
    fs, p, jvm = _hadoop_fs(spark, table_dir)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_COMMITTED")):
            out.append(int(name[2:]))
    return sorted(out)


def overwrite_snapshot(df: DataFrame, table_dir: str, version: int) -> bool:
    """Write ``df`` as version ``version`` of a table; a committed version is left as is.
    Returns True when written. (Recreating a table that may not exist is just a new version.)"""
    spark = df.sparkSession
    path = version_path(table_dir, version)
    if _exists(spark, os.path.join(path, "_COMMITTED")):
        return False
    df.write.mode("overwrite").parquet(path)
    _touch(spark, os.path.join(path, "_COMMITTED"))
    return True


def read_latest(spark: SparkSession, table_dir: str, schema=None, before: int | None = None) -> DataFrame | None:
    vs = [v for v in committed_versions(spark, table_dir) if before is None or v < before]
    if not vs:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(version_path(table_dir, vs[-1]))


def append_rows(df: DataFrame, path: str) -> None:
    """INSERT .. SELECT sink: append files to a parquet table."""
    df.write.mode("append").parquet(path)


#: The column that names a feed row's file.
FILE = "__file"
MANIFEST = "feed_manifest"


def change_feed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of the unified change feed (parquet files arriving in ``path``), with each row's file name."""
    r = spark.readStream.schema(FEED_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path).select("*", F.col("_metadata.file_name").alias(FILE))


def feed_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, after, last, n): the files of a feed, the last ``seq`` before each, its own last ``seq`` and its rows."""
    place = os.path.join(path, f"_{MANIFEST}")
    schema = "file string, after long, last long, n long"
    # the folder's name starts with an underscore, which a scan of the feed skips; its files are read by their own names
    files = [os.path.join(place, f) for f in folders(spark, place) if f.endswith(".json")]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)


def write_feed(feed: DataFrame, path: str, files: int = 1) -> None:
    """Append a feed as ``files`` parquet files, each a range of ``seq``. The files are written in parallel and may be seen in any
    order; the manifest, published before them, says which follows which. All ``seq`` must lie beyond those already there."""
    spark = feed.sparkSession
    name = uuid.uuid4().hex
    fresh = os.path.join(path, f"_new-{name}")
    with tidy(spark):
        feed.repartitionByRange(files, F.col("seq")).sortWithinPartitions("seq").write.parquet(fresh)
    paths = [os.path.join(fresh, f) for f in folders(spark, fresh) if f.endswith(".parquet")]
    if not paths:
        return
    rows = spark.read.schema(feed.schema).parquet(*paths).groupBy(F.col("_metadata.file_name").alias("file"))
    ranges = sorted((r["first"], r["last"], r["n"], r["file"]) for r in rows.agg(F.min("seq").alias("first"), F.max("seq").alias("last"), F.count("*").alias("n")).collect())
    after = feed_manifest(spark, path).agg(F.max("last")).first()[0]
    lines = []
    for first, last, n, file in ranges:
        if after is not None and first <= after:
            raise ValueError(f"seq {first} is not beyond {after}, the end of the feed")
        lines.append(json.dumps({"file": file, "after": after, "last": last, "n": n}))
        after = last
    fs, place, jvm = _hadoop_fs(spark, path)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(place, f"_{MANIFEST}/{name}.json"), True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    for *_, file in ranges:
        fs.rename(jvm.org.apache.hadoop.fs.Path(fresh, file), jvm.org.apache.hadoop.fs.Path(place, file))
    delete(spark, fresh)
