"""Change-set operators: the key set of a statement and the per-key orderings that
replace row-by-row trigger firing when a micro-batch holds many rows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import along


def changed_keys(feed: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct non-null keys touched by a statement (partial + final hash aggregate)."""
    return feed.where(F.col(key).isNotNull()).select(F.col(key).alias(alias or key)).distinct()


def first_per_key(df: DataFrame, key: str, order: list[str], value_cols: list[str]) -> DataFrame:
    """One row per key: the values of the first row by ``order`` (the first insert wins,
    later ones find it). Aggregate form (``min_by`` over a struct of the order columns),
    so a key with very many rows is reduced map-side before the shuffle."""
    packed = F.struct(*[F.col(c).alias(c) for c in value_cols])
    ordkey = F.struct(*[F.col(c).alias(c) for c in order])
    agg = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(packed, ordkey).alias("__v"))
    return agg.select(key, *[F.col(f"__v.{c}").alias(c) for c in value_cols if c != key])


def last_per_key(df: DataFrame, key: str, seq: str, value_cols: list[str]) -> DataFrame:
    """One row per key: the values of the row with the highest ``seq`` (the last update wins).

    A hash aggregate with ``max_by`` (partial aggregation before the shuffle), so a hot
    key costs one partial row per input partition, not a sorted partition.
    """
    packed = F.struct(*[F.col(c).alias(c) for c in value_cols])
    agg = df.groupBy(key).agg(F.max(seq).alias(seq), F.max_by(packed, F.col(seq)).alias("__v"))
    return agg.select(key, seq, *[F.col(f"__v.{c}").alias(c) for c in value_cols])


def previous_value(df: DataFrame, key: str, seq: str, col: str, seed: Column | None = None,
                   alias: str | None = None) -> DataFrame:
    """The value of ``col`` in the previous row of the same key (old image), seeded for the first. A key of any size is
    spread over range partitions (``scan.along``)."""
    prev = F.col("__before.v")
    if seed is not None:
        prev = F.when(F.col("__before").isNull(), seed).otherwise(prev)
    out = along(df, [key], [seq], before={"__before": F.struct(F.col(col).alias("v"))})
    return out.withColumn(alias or f"prev_{col}", prev).drop("__before")
