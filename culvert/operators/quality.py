"""Constraint and coverage reports (constraints are not enforced by parquet tables)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import norm_key
from ..functions.ids import is_valid_hex
from ..sources.lookups import MATERIAL_ROWS, Lookup


def duplicate_keys(df: DataFrame, keys: list[str | Column], name: str = "key") -> DataFrame:
    """Keys that occur more than once (null keys ignored): (key, n)."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    k = cols[0] if len(cols) == 1 else F.concat_ws("|", *[c.cast("string") for c in cols])
    d = df.select(k.cast("string").alias(name)).where(F.col(name).isNotNull())
    return d.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_violations(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """Per NOT NULL column the count of nulls: (table_name, column_name, null_count)."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(table).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) as (column_name, null_count)"))


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(rows passing ``rule``, rows failing it or with an unknown result)."""
    ok = F.coalesce(rule, F.lit(False))
    return df.where(ok), df.where(~ok)


def queue_key_rule() -> Column:
    return F.col("workorder_uuid").isNotNull()


def hex_id_rule(*cols: str) -> Column:
    r = None
    for c in cols:
        t = is_valid_hex(F.col(c))
        r = t if r is None else r & t
    return r


def unmapped_codes(unified: DataFrame) -> DataFrame:
    """Materials that no lookup mapped (raw text passed through): (inspection_type, material, n)."""
    known = sorted({c for _, c in MATERIAL_ROWS})
    codes = F.col("material").isin(*known)
    return (unified.where(F.col("inspection_type").isin("PACP", "LACP") & F.col("material").isNotNull() & ~codes)
            .groupBy("inspection_type", "material").agg(F.count(F.lit(1)).alias("n")))


def double_branch(unified: DataFrame) -> DataFrame:
    """History rows that enter more than one branch: (epdrfacilityworkhistoryoi, n_branches)."""
    return (unified.groupBy("epdrfacilityworkhistoryoi")
            .agg(F.count_distinct("inspection_type").alias("n_branches"))
            .where(F.col("n_branches") > 1))


def with_default_uuid(df: DataFrame, col: str = "task_uuid") -> DataFrame:
    """A generated 32-hex id where the id is missing (the column default upstream)."""
    return df.withColumn(col, F.coalesce(F.col(col), F.replace(F.expr("uuid()"), F.lit("-"), F.lit(""))))


#: lookup -> the raw columns that it codes
CODED = {
    "shape": [("epdrpipe", "shape"), ("epdrmanhole", "shape"), ("epdrcatchbasin", "shape")],
    "material": [("epdrpipe", "material"), ("epdrserviceconnect", "pipetype")],
    "mh_use": [("epdrmanhole", "wwtype"), ("epdrcatchbasin", "wwtype")],
    "wall": [("epdrmanhole", "cone"), ("epdrmanhole", "bench"), ("epdrmanhole", "channel")],
}


def coverage(src: dict[str, DataFrame], lookups: dict[str, Lookup]) -> DataFrame:
    """Raw values that no key of their lookup matches, whatever code they would pass for: (lookup, raw, n)."""
    def one(name: str) -> DataFrame:
        raw = reduce(DataFrame.unionByName, (src[t].select(norm_key(F.col(c)).alias("raw")) for t, c in CODED[name]))
        counts = raw.where(F.col("raw").isNotNull()).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
        keys = lookups[name].df.select(norm_key(F.col("src_text")).alias("raw"))
        return counts.join(keys, "raw", "left_anti").select(F.lit(name).alias("lookup"), "raw", "n")
    return reduce(DataFrame.unionByName, map(one, CODED))


def lookup_report(lookups: dict[str, Lookup]) -> DataFrame:
    """Rows, null keys and keys that repeat after normalising, of each lookup: (lookup, row_count, null_keys, repeated_keys)."""
    def one(name: str) -> DataFrame:
        keys = lookups[name].df.groupBy(norm_key(F.col("src_text")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        total = F.coalesce(F.sum("n"), F.lit(0))
        return keys.agg(total.alias("row_count"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
                        F.coalesce(F.sum((F.col("k").isNotNull() & (F.col("n") > 1)).cast("long")), F.lit(0)).alias("repeated_keys")).select(F.lit(name).alias("lookup"), "*")
    return reduce(DataFrame.unionByName, map(one, ("mh_use", "shape", "material", "wall")))
