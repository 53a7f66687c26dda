"""Quality counters of staging and queue, kept from batch to batch.

A batch rewrites some buckets of staging and queue. What their old rows counted is taken off and what their new rows count
is added, so the reports of the whole state come from the touched buckets alone:

  nulls  nulls of each required column, a few numbers in the version's manifest
  keys   how often each key occurs, in hash buckets of the key; the buckets of keys whose count changed are rewritten

Null keys are counted as nulls and have no row in ``keys``; an empty state has zeros and no duplicates. The reports equal
those of ``operators.quality`` over the whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import state as S

KEYS = {"stg": "task_uuid", "queue": "task_uuid"}
REQUIRED = {"stg": ["task_uuid", "workorder_uuid", "plndcompdate_dttm"], "queue": ["task_uuid"]}


def _counts(tables: dict[str, DataFrame], sign: int) -> DataFrame:
    one = lambda t, df: (df.where(F.col(KEYS[t]).isNotNull()).groupBy(F.col(KEYS[t]).alias("key"))
                         .agg((F.count("*") * sign).alias("n")).select(F.lit(t).alias("table_name"), "key", "n"))
    return reduce(DataFrame.unionByName, (one(t, df) for t, df in tables.items()))


def _nulls(df: DataFrame, columns: list[str]) -> list[int]:
    return list(df.agg(*[F.count_if(F.col(c).isNull()) for c in columns]).first())


def update(spark: SparkSession, state_dir: str, version: int, before: dict, after: dict, touched: dict[str, set[int]]) -> dict:
    """``keys`` and ``nulls`` of the next version's manifest, given the manifests before and after the touched buckets were rewritten."""
    old, new = ({t: S.read(spark, state_dir, note, t, touched[t]) for t in KEYS} for note in (before, after))
    nulls = {}
    for t, columns in REQUIRED.items():
        had = before["nulls"].get(t, [0] * len(columns))
        nulls[t] = [n + a - b for n, a, b in zip(had, _nulls(new[t], columns), _nulls(old[t], columns))]
    total = lambda df: df.groupBy("table_name", "key").agg(F.sum("n").alias("n")).where("n != 0")
    changed = materialise(total(_counts(new, 1).unionByName(_counts(old, -1))))
    hit = {r[0] for r in changed.select(S.bucket("keys", before["buckets"])).distinct().collect()}
    rows = total(S.read(spark, state_dir, before, "keys", hit).unionByName(changed))
    return {"keys": S.write_buckets(rows, state_dir, "keys", version, before, hit), "nulls": nulls}


def _note(spark: SparkSession, state_dir: str) -> dict:
    _, note = S.last_version(spark, state_dir)
    if note.get("nulls") is None:
        raise ValueError(f"{state_dir} keeps no quality counters; init it with quality=True")
    return note


def kept_duplicates(spark: SparkSession, state_dir: str) -> DataFrame:
    """Keys of the last version that occur more than once: (table_name, key, n)."""
    return S.read(spark, state_dir, _note(spark, state_dir), "keys").where("n > 1")


def kept_nulls(spark: SparkSession, state_dir: str) -> DataFrame:
    """Nulls of each required column in the last version: (table_name, column_name, null_count)."""
    nulls = _note(spark, state_dir)["nulls"]
    rows = [(t, c, n) for t, columns in REQUIRED.items() for c, n in zip(columns, nulls[t])]
    return spark.createDataFrame(rows, "table_name string, column_name string, null_count long")
