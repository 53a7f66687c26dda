"""Versioned state in parts: a batch writes what it touches, and a version is a list of parts.

``state/v=<n>/`` holds one marker, written last: the version's manifest. It names the stream's checkpoint and the batch, the
frontier of the feed, and for every table the parts it consists of:

  stg, queue   hash buckets of the work order; a bucket is in the part of the version that last rewrote it
  cr           inspection rows in parts that are only appended, laid out by whether they are to be sent (``outbound``)
  changes, sids  status changes and vendor ids since, one part a batch; readers merge the last ones into ``cr``
  held         feed events that wait for earlier files
  keys         how often each key of staging and queue occurs, in hash buckets of the key (``watch``), if the state keeps them

Parts lie in ``state/data/<table>/v=<n>/``. A batch rewrites the buckets it touches and appends inspections and changes; after
``COMPACT`` parts of changes the inspections are written anew, merged. What no kept version lists any more is deleted.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.ids import pack_id, unpack_id
from ..sources import io
from ..sources.schemas import CR_INSPECT_COLUMNS, CR_INSPECT_SCHEMA, FEED_SCHEMA, WOT_STG1_SCHEMA, WOT_STG_SCHEMA
from . import rules as R

BUCKETS = 64
#: Hex ids, most of a state's bytes, take half the room.
CODEC = "zstd"
COMPACT = 16
KEEP_VERSIONS = 3
#: Added to the number of a part of merged inspections, so that it is not one of the parts it is made from.
MERGED = 1 << 40
SEQ = "__seq"
#: The ``seq`` that gave an inspection row its status (null: it was there at the start).
STATUS_SEQ = "__status_seq"

_SCHEMA = {
    "stg": WOT_STG_SCHEMA, "queue": WOT_STG1_SCHEMA, "cr": f"{CR_INSPECT_SCHEMA}, {SEQ} long, {STATUS_SEQ} long, outbound int",
    "changes": "inspectionid string, feed_status string, seq long", "sids": "workorder string, inspection_sid string, seq long",
    "keys": "table_name string, key string, n long",
    "held": StructType([*FEED_SCHEMA.fields, StructField(io.FILE, StringType())]),
}
BUCKETED, PARTS = ("stg", "queue", "keys"), ("cr", "changes", "sids", "held")


def bucket(table: str, n: int) -> Column:
    """The bucket of a staging, queue or key row. Staging rows without a work order are spread by their task."""
    key = {"stg": F.coalesce("workorder_uuid", "task_uuid"), "queue": F.col("task_uuid"), "keys": F.col("key")}[table]
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def wo_bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _part(state_dir: str, table: str, version: int) -> str:
    return os.path.join(state_dir, "data", table, f"v={version:014d}")


def note_of(spark: SparkSession, state_dir: str, version: int) -> dict:
    return json.loads(io.marker(spark, io.version_path(state_dir, version)))


def last_version(spark: SparkSession, state_dir: str, before: int | None = None) -> tuple[int, dict]:
    """(number, manifest) of the last committed version (below ``before``)."""
    versions = [v for v in io.committed_versions(spark, state_dir) if before is None or v < before]
    if not versions:
        raise ValueError(f"no committed version below {before} in {state_dir}")
    return versions[-1], note_of(spark, state_dir, versions[-1])


def read(spark: SparkSession, state_dir: str, note: dict, table: str, only: set[int] | None = None) -> DataFrame:
    """A table of a version as its parts hold it (``only`` these buckets)."""
    if table in BUCKETED:
        paths = [os.path.join(_part(state_dir, table, v), f"bucket={b}") for b, v in note.get(table, {}).items() if only is None or int(b) in only]
    else:
        paths = [_part(state_dir, table, v) for v in note[table]]
    if not paths:
        return spark.createDataFrame([], _SCHEMA[table])
    if table == "cr":  # its parts are laid out by folders, below the version's
        base = os.path.dirname(paths[0])
        return spark.read.option("basePath", base).schema(f"{_SCHEMA[table]}, v long").parquet(*paths).drop("v")
    return spark.read.schema(_SCHEMA[table]).parquet(*paths)


def _merged(spark: SparkSession, state_dir: str, note: dict, cr: DataFrame) -> DataFrame:
    """Stored inspection rows with the changes since merged in."""
    cr = cr.drop("outbound")
    if note["changes"]:
        cr = R.set_inspection_status(cr, read(spark, state_dir, note, "changes"))
    if note["sids"]:
        cr = R.backfill_sid(cr, read(spark, state_dir, note, "sids"))
    return cr


def inspections(spark: SparkSession, state_dir: str, note: dict) -> DataFrame:
    """The inspection rows of a version with ``__seq`` and ``__status_seq``."""
    return _merged(spark, state_dir, note, read(spark, state_dir, note, "cr"))


def to_send(spark: SparkSession, state_dir: str, note: dict, after: int | None = None) -> DataFrame:
    """The inspection rows of a version whose status is NEW (those that a ``seq`` beyond ``after`` set to it).

    Rows written as NEW are one folder of each part, so others are not read, unless upstream has set some back to NEW
    since the parts were merged: those are looked up by their ids."""
    cr = read(spark, state_dir, note, "cr")
    fresh, newer = F.col("outbound") == 1, F.lit(True) if after is None else F.col(STATUS_SEQ) > after
    rows = cr.where(fresh & newer)
    if note["changes"]:
        last = R.last_per_key(read(spark, state_dir, note, "changes"), "inspectionid", "seq", ["feed_status"])
        back = last.where(F.col("feed_status") == "NEW")
        back = back if after is None else back.where(F.col("seq") > after)
        if not back.isEmpty():
            rest = cr.where(~(fresh & F.coalesce(newer, F.lit(False))))
            rows = rows.unionByName(rest.join(back.select("inspectionid"), "inspectionid", "left_semi"))
    rows = _merged(spark, state_dir, note, rows).where(F.col("feed_status") == "NEW")
    return rows if after is None else rows.where(F.col(STATUS_SEQ) > after)


def write_inspections(df: DataFrame, state_dir: str, version: int) -> list[int]:
    """Write inspection rows (with ``__seq``; ``__status_seq`` is ``__seq`` where it is missing) as a part."""
    since = F.col(STATUS_SEQ if STATUS_SEQ in df.columns else SEQ)
    outbound = F.coalesce(F.col("feed_status") == "NEW", F.lit(False)).cast("int").alias("outbound")
    return write_part(df.select(*CR_INSPECT_COLUMNS, SEQ, since.alias(STATUS_SEQ), outbound), state_dir, "cr", version, ["outbound"])


def write_buckets(df: DataFrame, state_dir: str, table: str, version: int, note: dict, touched: set[int], far: DataFrame | None = None) -> dict[str, int]:
    """Rewrite the touched buckets with ``df`` (and ``far``); the buckets of the table in the new version.

    ``far`` are rows that were read from these buckets and did not change: a task that reads them has few buckets, so they are
    written as they come, without the shuffle."""
    spark = df.sparkSession
    kept = {b: v for b, v in note.get(table, {}).items() if int(b) not in touched}
    if touched:
        path = _part(state_dir, table, version)
        # rebalancing splits a bucket that a hot work order fills; ids are shuffled as 16 bytes
        ids = [c for c in ("task_uuid", "workorder_uuid") if c in df.columns]
        rows = df.withColumn("bucket", bucket(table, note["buckets"])).withColumns({c: pack_id(F.col(c)) for c in ids}).hint("rebalance", "bucket")
        rows = rows.withColumns({c: unpack_id(F.col(c)) for c in ids})
        if far is not None:
            rows = rows.unionByName(far.withColumn("bucket", bucket(table, note["buckets"])))
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy("bucket").parquet(path)
        kept |= {name.split("=")[1]: version for name in io.folders(spark, path) if name.startswith("bucket=")}
    return kept


def write_part(df: DataFrame, state_dir: str, table: str, version: int, by: list[str] | None = None) -> list[int]:
    """Write a part; no part if there are no rows."""
    if df.isEmpty():
        return []
    df.write.mode("overwrite").option("compression", CODEC).partitionBy(*by or []).parquet(_part(state_dir, table, version))
    return [version]


def forget(spark: SparkSession, state_dir: str, version: int, tables: dict[str, list[int]]) -> None:
    """Delete the parts of a version that is not committed."""
    for t, parts in tables.items():
        if version in parts:
            io.delete(spark, _part(state_dir, t, version))


def _places(state_dir: str, note: dict) -> set[str]:
    of_buckets = {os.path.join(_part(state_dir, t, v), f"bucket={b}") for t in BUCKETED for b, v in note.get(t, {}).items()}
    return of_buckets | {_part(state_dir, t, v) for t in PARTS for v in note[t]}


def commit(spark: SparkSession, state_dir: str, version: int, note: dict) -> None:
    """Write the marker, then drop old versions and the parts that only they list."""
    io.mark(spark, io.version_path(state_dir, version), json.dumps(note))
    versions = io.committed_versions(spark, state_dir)
    if len(versions) > KEEP_VERSIONS:
        kept = set().union(*[_places(state_dir, note_of(spark, state_dir, v)) for v in versions[-KEEP_VERSIONS:]])
        for old in versions[:-KEEP_VERSIONS]:
            gone = _places(state_dir, note_of(spark, state_dir, old)) - kept
            io.drop_version(spark, state_dir, old)
            for path in gone:
                io.delete(spark, path)


def init(state_dir: str, state: dict[str, DataFrame], buckets: int, quality: bool = False) -> None:
    """Version 0, with all rows."""
    spark = state["stg"].sparkSession
    note: dict = {"query": None, "batch": -1, "frontier": None, "seq": -1, "buckets": buckets, "keys": {}, "nulls": None, "changes": [], "sids": [], "held": []}
    every = set(range(buckets))
    for t, columns in (("stg", R.STG_COLUMNS), ("queue", R.QUEUE_COLUMNS)):
        note[t] = write_buckets(state[t].select(*columns), state_dir, t, 0, note, every)
    note["cr"] = write_inspections(state["cr"].select(*CR_INSPECT_COLUMNS, F.lit(None).cast("long").alias(SEQ)), state_dir, 0)
    if quality:
        from . import watch
        before = {**note, "stg": {}, "queue": {}, "nulls": {}}
        note |= watch.update(spark, state_dir, 0, before, note, dict.fromkeys(watch.KEYS, every))
    commit(spark, state_dir, 0, note)
