"""Deployment entry points (``spark-submit culvert/jobs.py <command> ...``).

  views   publish the unified inspections view and the outbound extract as temp views
          and write them as parquet
  sync    run the change-feed stream that keeps staging, queue and inspection tables
          in step (``--once`` processes what is there and stops)
  init    write version 0 of the state tables from parquet inputs

Sources are read with their declared schemas from ``<src_dir>/<name>`` (see
``sources.schemas.SOURCE_SCHEMAS``). State lives in versioned snapshot folders below
``<state_dir>``; the streaming checkpoint defaults to ``<state_dir>/_stream_checkpoint``
(one per state folder) and in-batch checkpoints go to the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from culvert.plans.inspections import unified_inspections  # noqa: E402
from culvert.plans.outbound import register_views  # noqa: E402
from culvert.session import checkpoint_dir, cluster_spark, scratch  # noqa: E402
from culvert.sources import io  # noqa: E402
from culvert.sources.lookups import all_lookups  # noqa: E402
from culvert.streaming.sync import init_state, read_outbound, read_state, send_outbound, stream_sync  # noqa: E402


def publish_views(spark: SparkSession, src_dir: str, state_dir: str | None = None) -> list[str]:
    """Register ``inspections_v`` (and ``cr_inspect_to_send_v`` when a state folder with
    an inspection table is given) over the current sources."""
    src = io.load_sources(spark, src_dir)
    cr = read_state(spark, state_dir)["cr"] if state_dir else None
    return register_views(spark, src, cr)


def write_views(spark: SparkSession, src_dir: str, out_dir: str, state_dir: str | None = None) -> None:
    src = io.load_sources(spark, src_dir)
    with scratch(spark):
        unified_inspections(src, all_lookups(spark), stored=True).write.mode("overwrite").parquet(os.path.join(out_dir, "inspections"))
    if state_dir:
        read_outbound(spark, state_dir)[0].write.mode("overwrite").parquet(os.path.join(out_dir, "cr_inspect_to_send"))


def init_from(spark: SparkSession, stg: DataFrame, queue: DataFrame, cr: DataFrame, state_dir: str, quality: bool = False) -> None:
    init_state(state_dir, {"stg": stg, "queue": queue, "cr": cr}, quality=quality)


def start_sync(spark: SparkSession, src_dir: str, feed_dir: str, state_dir: str, checkpoint: str | None = None,
               once: bool = False, max_files_per_trigger: int | None = None, **kw):
    # the stream's checkpoint belongs to the state it produces (one per state folder)
    ckpt = checkpoint or os.path.join(state_dir, "_stream_checkpoint")
    checkpoint_dir(spark)   # batch-level checkpoints go to the cluster's shared folder
    return stream_sync(spark, feed_dir, state_dir, ckpt, lambda s: io.load_sources(s, src_dir), all_lookups(spark),
                       max_files_per_trigger=max_files_per_trigger, available_now=once, **kw)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="culvert")
    sub = p.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("views")
    v.add_argument("--src", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--state")
    s = sub.add_parser("sync")
    s.add_argument("--src", required=True)
    s.add_argument("--feed", required=True)
    s.add_argument("--state", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--once", action="store_true")
    s.add_argument("--max-files", type=int)
    s.add_argument("--dedupe", choices=["raw", "canonical"], default="raw")
    s.add_argument("--backfill", action="store_true", help="also apply vendor rows (optional rule)")
    i = sub.add_parser("init")
    i.add_argument("--stg", required=True)
    i.add_argument("--queue", required=True)
    i.add_argument("--cr", required=True)
    i.add_argument("--state", required=True)
    i.add_argument("--quality", action="store_true", help="keep duplicate and null counters from batch to batch")
    o = sub.add_parser("send", help="write the inspections to be sent since the last send")
    o.add_argument("--state", required=True)
    o.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = cluster_spark(app=f"culvert-{a.cmd}")
    if a.cmd == "views":
        write_views(spark, a.src, a.out, a.state)
    elif a.cmd == "init":
        init_from(spark, spark.read.parquet(a.stg), spark.read.parquet(a.queue), spark.read.parquet(a.cr), a.state, a.quality)
    elif a.cmd == "send":
        send_outbound(spark, a.state, a.out)
    else:
        q = start_sync(spark, a.src, a.feed, a.state, a.checkpoint, a.once, a.max_files,
                       dedupe=a.dedupe, with_backfill=a.backfill)
        q.awaitTermination()


if __name__ == "__main__":
    main()
