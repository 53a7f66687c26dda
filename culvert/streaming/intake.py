"""Ordered intake of the change feed: events are released in the order of ``seq``, whatever order files arrive in.

A writer lists each feed file in the feed's manifest: its name, the last ``seq`` of the file before it and its own last
``seq``. The file source takes files as it finds them, so a micro-batch may hold a later file before an earlier one. The frontier is the
``seq`` up to which all files have come. A batch releases the files that continue from the frontier without a gap; all
others are held back, in a table of the state, until what lies before them has come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import io
from ..sources.schemas import FEED_SCHEMA

FEED_COLUMNS = [f.name for f in FEED_SCHEMA.fields]
HELD_COLUMNS = [*FEED_COLUMNS, io.FILE]


def contiguous(frontier: int | None, files: dict[str, tuple[int | None, int]]) -> tuple[list[str], int | None]:
    """The files (name -> seq before it, last seq) that follow the frontier without a gap, in order, and the new frontier."""
    following = {}
    for name, (after, last) in files.items():
        if after in following:
            raise ValueError(f"the manifest lets two files follow {after}: {following[after][0]} and {name}")
        following[after] = name, last
    out = []
    while frontier in following:
        name, last = following.pop(frontier)
        out.append(name)
        frontier = last
    return out, frontier


def release(spark: SparkSession, feed_dir: str, frontier: int | None, held: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame, int | None]:
    """(events to apply, events held back, new frontier). What the driver sees are names of held and new files only."""
    pool = held.select(*HELD_COLUMNS).unionByName(batch.select(*HELD_COLUMNS))
    names = pool.select(io.FILE).distinct()
    listed = io.feed_manifest(spark, feed_dir).join(names, F.col("file") == F.col(io.FILE)).select("file", "after", "last").collect()
    ready, frontier = contiguous(frontier, {r["file"]: (r["after"], r["last"]) for r in listed})
    chosen = spark.createDataFrame([(n,) for n in ready], "__ready string")
    of = lambda how: pool.join(chosen, pool[io.FILE] == chosen["__ready"], how)
    return of("left_semi").select(*FEED_COLUMNS), of("left_anti").select(*HELD_COLUMNS), frontier
