"""Structured Streaming driver of the sync rules.

readStream(feed parquet) -> ordered intake -> foreachBatch(rules) -> versioned state.

A version is a manifest of parts (``state``), written last, that names the stream's checkpoint, the batch and the frontier of the feed.
What a batch put in quarantine lies beside the versions, in a part of its own
(``state/quarantine_*/stream=<id>/batch=<n>/``) that a replay overwrites and that outlives the version. So a reader sees all tables of one batch or
of the one before, a replayed batch finds its marker and writes nothing, and a stream with another checkpoint (which
would apply the feed anew) is refused instead of being taken for a replay. Events are applied in the order of ``seq``, files that come too
early are held back (``intake``). Sources are read for each batch, so rows written after the start of the stream are seen.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import split_by_keys
from ..plans.outbound import extract_to_send
from ..session import checkpoint_dir, materialise, scratch
from ..sources import io
from ..sources.lookups import Lookup
from ..sources.schemas import CR_INSPECT_COLUMNS
from . import intake, watch
from . import rules as R
from . import state as S

STATE_TABLES = ("stg", "queue", "cr")
QUARANTINE_TABLES = ("quarantine_ids", "quarantine_queue")

Sources = dict[str, DataFrame] | Callable[[SparkSession], dict[str, DataFrame]]


def init_state(state_dir: str, state: dict[str, DataFrame], buckets: int = S.BUCKETS, quality: bool = False) -> None:
    """Write version 0. An existing state is never replaced: that is an error. With ``quality`` the state keeps the
    counters of ``watch`` from batch to batch."""
    spark = state["stg"].sparkSession
    if io.committed_versions(spark, state_dir):
        raise ValueError(f"{state_dir} already holds a state")
    with scratch(spark):
        S.init(state_dir, state, buckets, quality)


def read_state(spark: SparkSession, state_dir: str, before: int | None = None) -> dict[str, DataFrame]:
    """All tables of the last committed version (below ``before``)."""
    _, note = S.last_version(spark, state_dir, before)
    return {"stg": S.read(spark, state_dir, note, "stg"), "queue": S.read(spark, state_dir, note, "queue"),
            "cr": S.inspections(spark, state_dir, note).select(*CR_INSPECT_COLUMNS)}


def read_outbound(spark: SparkSession, state_dir: str, after: int | None = None) -> tuple[DataFrame, int]:
    """(the outbound extract of the last version, a cursor). With the cursor of an earlier call as ``after``, only the rows that
    events since then inserted as NEW or set to NEW; a row that left NEW before it was read is not among them."""
    _, note = S.last_version(spark, state_dir)
    return extract_to_send(S.to_send(spark, state_dir, note, after)), note["seq"]


def send_outbound(spark: SparkSession, state_dir: str, out_dir: str) -> int | None:
    """Write what is to be sent since the last time as the next version of ``out_dir``, whose marker keeps the cursor; the number
    of the version, or None if there is nothing. A send that did not reach its marker is done again."""
    sent = io.committed_versions(spark, out_dir)
    after = json.loads(io.marker(spark, io.version_path(out_dir, sent[-1])))["seq"] if sent else None
    rows, cursor = read_outbound(spark, state_dir, after)
    if cursor == after:
        return None
    version = sent[-1] + 1 if sent else 0
    path = io.version_path(out_dir, version)
    rows.write.mode("overwrite").parquet(path)
    io.mark(spark, path, json.dumps({"seq": cursor}))
    return version


def read_held(spark: SparkSession, state_dir: str) -> DataFrame:
    """Feed events that wait for files before theirs."""
    return S.read(spark, state_dir, S.last_version(spark, state_dir)[1], "held")


def _quarantine_path(state_dir: str, table: str, stream: str) -> str:
    return os.path.join(state_dir, table, f"stream={quote(stream, safe='')}")


def read_quarantine(spark: SparkSession, state_dir: str) -> dict[str, DataFrame]:
    """What all committed batches put in quarantine, also those whose version is dropped by now."""
    versions = io.committed_versions(spark, state_dir)
    note = S.note_of(spark, state_dir, versions[-1]) if versions else {"query": None}
    if note["query"] is None:
        return {}
    paths = {t: _quarantine_path(state_dir, t, note["query"]) for t in QUARANTINE_TABLES}
    return {t: spark.read.parquet(p).where(F.col("batch") <= note["batch"]).drop("batch") for t, p in paths.items() if io.folders(spark, p)}


def _apply(spark: SparkSession, state_dir: str, version: int, note: dict, feed: DataFrame, src: dict[str, DataFrame],
           lookups: dict[str, Lookup], dedupe: str, with_backfill: bool) -> tuple[dict, dict[str, DataFrame]]:
    """Apply released events to the parts they touch: (the tables of the next version's manifest, quarantine)."""
    got = R.prepare(S.read(spark, state_dir, note, "cr"), feed, src, lookups, dedupe)
    n = note["buckets"]
    ids = lambda df, key: {r[0] for r in df.select(S.wo_bucket(key, n)).distinct().collect()}
    wos = ids(got["events"], F.col("wo"))
    lost = ids(got["lost"], F.col("task_uuid"))
    if lost:  # rows that lose their work order: the buckets where they are
        at = split_by_keys(S.read(spark, state_dir, note, "stg"), "task_uuid", got["lost"], "task_uuid")[0]
        at = at.select(F.col("task_uuid").alias("__t"), S.bucket("stg", n).alias("b"))
        lost |= {r["b"] for r in at.join(got["lost"], at["__t"] == got["lost"]["task_uuid"], "left_semi").select("b").distinct().collect()}
    out = R.apply_prepared(S.read(spark, state_dir, note, "stg", wos | lost), S.read(spark, state_dir, note, "queue", wos), got)
    # each batch adds files to the buckets it touches; after a number of batches all rows of a batch's buckets are dealt anew
    loose = note.get("loose", 0) + 1
    near, far = (out["near"], out["far"]) if loose <= S.COMPACT else (out, {})
    tables = {"loose": loose if far else 0,
              "stg": S.write_buckets(near["stg"], state_dir, "stg", version, note, wos | lost, far.get("stg")),
              "queue": S.write_buckets(near["queue"], state_dir, "queue", version, note, wos, far.get("queue")),
              "cr": note["cr"] + S.write_inspections(got["new_cr"], state_dir, version)}
    if note.get("nulls") is not None:
        tables |= watch.update(spark, state_dir, version, note, tables, {"stg": wos | lost, "queue": wos})
    changes = R.last_per_key(got["changed"].where(F.col("inspectionid").isNotNull()), "inspectionid", "seq", ["feed_status"])
    tables["changes"] = note["changes"] + S.write_part(changes.select("inspectionid", "feed_status", "seq"), state_dir, "changes", version)
    sids = R.feed_part(feed, "vendor", ["workorder", "inspection_sid"]).where(F.col("workorder").isNotNull())
    sids = R.last_per_key(sids, "workorder", "seq", ["inspection_sid"]).select("workorder", "inspection_sid", "seq")
    tables["sids"] = note["sids"] + (S.write_part(sids, state_dir, "sids", version) if with_backfill else [])
    if len(tables["changes"]) + len(tables["sids"]) > S.COMPACT:
        merged = S.write_inspections(S.inspections(spark, state_dir, tables), state_dir, version + S.MERGED)
        S.forget(spark, state_dir, version, {t: tables[t] for t in ("cr", "changes", "sids")})  # what this batch wrote is merged, too
        tables |= {"cr": merged, "changes": [], "sids": []}
    return tables, out


def make_batch_fn(state_dir: str, src: Sources, lookups: dict[str, Lookup],
                  dedupe: str = "raw", with_backfill: bool = False, query: str | None = None, feed_dir: str | None = None):
    """foreachBatch body: the rules on the touched parts of the last state, committed as the next version.

    ``src`` may be a function that lists the sources anew for each batch. ``query`` names the stream's checkpoint; by
    default it is the id that Spark keeps in it. With ``feed_dir`` batches come from the files of a feed with a manifest and are
    put in order; without, the caller gives batches in the order of ``seq``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):   # nothing of a batch but its parts of the state outlives it
            commit(batch, batch_id)

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        stream = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        version, note = S.last_version(spark, state_dir)
        if note["query"] is not None and note["query"] != stream:
            raise ValueError(f"{state_dir} was written by the stream {note['query']}; this one is {stream} and would apply the feed again")
        if batch_id <= note["batch"]:
            return  # replay of a committed batch
        ready, held, frontier = batch, None, note["frontier"]
        if feed_dir:
            ready, held, frontier = intake.release(spark, feed_dir, frontier, S.read(spark, state_dir, note, "held"), batch)
        ready = materialise(ready)
        next_ = {**note, "query": stream, "batch": batch_id, "frontier": frontier}
        next_["held"] = S.write_part(held, state_dir, "held", version + 1) if held is not None else []
        if not ready.isEmpty():
            tables, out = _apply(spark, state_dir, version + 1, note, ready, src(spark) if callable(src) else src, lookups, dedupe, with_backfill)
            next_ |= tables | {"seq": max(note["seq"], ready.agg(F.max("seq")).first()[0])}
            for t in QUARANTINE_TABLES:
                out[t].write.mode("overwrite").parquet(os.path.join(_quarantine_path(state_dir, t, stream), f"batch={batch_id}"))
        S.commit(spark, state_dir, version + 1, next_)
    return apply


def stream_sync(spark: SparkSession, feed_dir: str, state_dir: str, checkpoint: str,
                src: Sources, lookups: dict[str, Lookup],
                max_files_per_trigger: int | None = None, available_now: bool = True, **kw):
    """Start the sync stream; with ``available_now`` it processes what is there and stops."""
    feed = io.change_feed(spark, feed_dir, max_files_per_trigger)
    w = (feed.writeStream.foreachBatch(make_batch_fn(state_dir, src, lookups, feed_dir=feed_dir, **kw))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
