"""Connected components of an undirected edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.llm.common import discard, stored


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge from u's side with the least of u and its neighbours; a node of very many edges is combined before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a long, b long): ``root`` is the least node of its component.

    Each step joins edges with one row per node, so hot nodes can be split; a step's edges are written to the shared folder."""
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        before, pairs = pairs, stored(small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct(), "edges")
        discard(before)
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
