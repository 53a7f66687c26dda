"""Ordered look-back and look-ahead within keys, for keys of any size.

A window over a key sorts the whole key in one task. Here rows are dealt to range partitions by (key, order), so a key
with very many rows lies in many partitions; windows see one partition's share of a key, and what a share needs
from those before (or after) it comes from a table of one row for each key and partition, joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

PART = "__part"


def along(df: DataFrame, keys: list[str], order: list[str], before: dict[str, Column] | None = None,
          after: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with columns named in ``before`` and ``after``: the last non-null value of the expression in the rows of the
    same key before a row, the first one in the rows after it. Null keys are one key. A struct is null only as a whole, so wrap a value to look for rows whatever it is."""
    before, after = before or {}, after or {}
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = {**before, **after}
    rows = df.select("*", *[v.alias(f"__v_{c}") for c, v in values.items()]).repartitionByRange(n, *keys, *order)
    # written once: another execution would draw other range bounds
    rows = materialise(rows.withColumn(PART, F.spark_partition_id()))
    place = F.struct(*order)
    share = Window.partitionBy(PART, *keys)
    past = share.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    future = share.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", *[F.last(f"__v_{c}", ignorenulls=True).over(past if c in before else future).alias(c) for c in values])
    ends = []
    for c in values:
        known = F.when(F.col(f"__v_{c}").isNotNull(), place)
        ends.append((F.max_by(f"__v_{c}", known) if c in before else F.min_by(f"__v_{c}", known)).alias(c))
    shares = rows.groupBy(PART, *keys).agg(*ends)
    parts = Window.partitionBy(*keys)   # at most one row for each partition
    past = parts.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    future = parts.orderBy(F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)
    edge = shares.select(F.col(PART).alias(f"{PART}_"), *[F.col(k).alias(f"__k_{k}") for k in keys],
                         *[F.last(c, ignorenulls=True).over(past if c in before else future).alias(f"__e_{c}") for c in values])
    edge = edge.where(reduce(lambda a, b: a | b, [F.col(f"__e_{c}").isNotNull() for c in values]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], F.col(PART) == F.col(f"{PART}_"))
    return local.join(edge, same, "left").select(*df.columns, *[F.coalesce(c, f"__e_{c}").alias(c) for c in values])
