"""Join building blocks: code lookups, skew-safe left joins, and the set-based forms of
the row triggers' key joins (exists / not exists / update by key / delete by key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import norm_key
from ..sources.lookups import Lookup



def code_join(df: DataFrame, key: Column, lookup: Lookup, out: str) -> DataFrame:
    """Left join a code lookup on the normalised key; adds column ``out`` (the code).

    The lookup side is normalised once and broadcast when its size bound allows it
    (the seeded lookups hold 5..67 rows). A null or unmatched key gives a null code.
    A lookup key that repeats after normalising multiplies rows, as a join does.
    """
    k = f"__k_{out}"
    lk = lookup.df.select(norm_key(F.col("src_text")).alias(k), F.col("code").alias(out))
    if lookup.broadcastable:
        lk = F.broadcast(lk)
    return df.join(lk, norm_key(key) == lk[k], "left").drop(k)


def null_salt(key: Column, buckets: int, *salt_from: Column) -> Column:
    """0 for a non-null key; for a null key a bucket in [1, ``buckets``] from a
    deterministic hash of ``salt_from`` (so recomputing a lost partition gives the same rows)."""
    return F.when(key.isNull(), F.pmod(F.xxhash64(*salt_from), F.lit(buckets)) + 1) \
        .otherwise(F.lit(0)).cast("int")


def match_salt(key: Column) -> Column:
    """Right-side partner of ``null_salt``: 0 for every usable key. Written as an
    expression of the key (not a literal) so the optimizer keeps the pair (key, salt) as
    the equi-join key and the shuffle hashes on both; a literal would be folded into a
    post-join filter and the null-key rows would again meet in one partition."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("int")


def left_join_spread_nulls(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                           salt_from: list[str], extra: Column | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.lkey = right.rkey [AND extra]``, with null keys spread.

    A null key never matches, but a hash shuffle sends every null-key row to one
    partition. Pairing the key with a salt (0 on the right, a hash bucket for
    null-key rows on the left) keeps the result identical while spreading those
    rows over as many buckets as the shuffle has partitions. ``rkey`` is dropped after the join.
    """
    buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    l2 = left.withColumn("__salt_l", null_salt(F.col(lkey), buckets, *[F.col(c) for c in salt_from]))
    r2 = right.withColumn("__salt_r", match_salt(F.col(rkey)))
    cond = (l2[lkey] == r2[rkey]) & (l2["__salt_l"] == r2["__salt_r"])
    if extra is not None:
        cond = cond & extra
    return l2.join(r2, cond, "left").drop("__salt_l", "__salt_r", rkey)


def not_present(df: DataFrame, existing: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows of df with no match in existing (NOT EXISTS): a left anti join."""
    cond = None
    for lc, rc in on:
        c = df[lc] == existing[rc]
        cond = c if cond is None else cond & c
    return df.join(existing, cond, "left_anti")


def only_keys(df: DataFrame, keys: DataFrame, on: str, key_col: str | None = None) -> DataFrame:
    """Rows of df whose ``on`` is in keys (EXISTS): a left semi join."""
    k = keys.select(F.col(key_col or on).alias(on))
    return df.join(k, on, "left_semi")


#: Bits of the filter that ``split_by_keys`` broadcasts: 2^20 words of 64 bits at most, whatever the number of keys.
FILTER_BITS = 26


def _marking(df: DataFrame, on: str, keys: DataFrame, key_col: str, how: str) -> tuple[DataFrame, Column]:
    """(df joined with the words of a Bloom filter of ``keys``, whether ``on`` may be in keys). One hash, as a table of bit words
    that is broadcast: its size is bounded; with more keys it lets more rows through."""
    place = lambda c: F.xxhash64(F.col(c)).bitwiseAND((1 << FILTER_BITS) - 1)
    bit = lambda c: place(c).bitwiseAND(63).cast("int")
    word, bits = f"__word_{on}", f"__bits_{on}"
    words = (keys.where(F.col(key_col).isNotNull()).select(F.shiftright(place(key_col), 6).alias(word), bit(key_col).alias("__bit"))
             .groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bit"))).alias(bits)))
    set_ = F.call_function("shiftright", F.col(bits), bit(on)).bitwiseAND(1) == 1
    return df.join(F.broadcast(words), F.shiftright(place(on), 6) == F.col(word), how), F.col(on).isNotNull() & F.coalesce(set_, F.lit(False))


def mark_keys(df: DataFrame, on: str, keys: DataFrame, key_col: str, flag: str) -> DataFrame:
    """df with column ``flag``: whether ``on`` may be in keys; where it is false, ``on`` certainly is not in keys (or null)."""
    marked, known = _marking(df, on, keys, key_col, "left")
    return marked.select(*df.columns, known.alias(flag))


def split_by_keys(df: DataFrame, on: str, keys: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows of df whose ``on`` may be in keys, rows whose ``on`` certainly is not, null ones among them).

    By a Bloom filter: a wide table of which a batch touches a small share is cut down where it is scanned, and only that share
    is shuffled for the exact join that has to follow. ``keys`` is read once for each of the two that is used, so it should be stored or cheap."""
    near, known = _marking(df, on, keys, key_col, "inner")
    far, known_too = _marking(df, on, keys, key_col, "left")
    return near.where(known).select(*df.columns), far.where(~known_too).select(*df.columns)


def split_rows(df: DataFrame, on: str, keys: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of df whose ``on`` is in keys, the others in two parts: the second is not shuffled). ``keys`` holds each key once.

    Inner and left joins rather than semi and anti ones, which the optimizer would move below the filter."""
    near, far = split_by_keys(df, on, keys, key_col)
    k = keys.select(F.col(key_col).alias("__key")).where(F.col("__key").isNotNull())
    rest = near.join(k, near[on] == F.col("__key"), "left").where(F.col("__key").isNull())
    return near.join(k, near[on] == F.col("__key")).select(*df.columns), rest.select(*df.columns), far


def update_by_key(state: DataFrame, changes: DataFrame, on: list[tuple[str, str]],
                  set_cols: dict[str, Column], when: Column | None = None,
                  flag: str | None = None) -> DataFrame:
    """UPDATE state SET .. WHERE state.k = changes.k [AND when], as a left join.

    ``changes`` must hold at most one row per key (reduce it first, e.g. with
    ``last_per_key``); every state row of a key is updated (fan-out). ``set_cols``
    expressions may use change columns (prefixed ``chg_``) and state columns.
    ``flag`` names an optional boolean output column marking the updated rows.
    """
    chg = changes.select(*[F.col(c).alias(f"chg_{c}") for c in changes.columns])
    cond = None
    for lc, rc in on:
        c = state[lc] == chg[f"chg_{rc}"]
        cond = c if cond is None else cond & c
    j = state.join(chg, cond, "left")
    matched = F.col(f"chg_{on[0][1]}").isNotNull()
    hit = matched if when is None else (matched & F.coalesce(when, F.lit(False)))
    cols = []
    for c in state.columns:
        cols.append(F.when(hit, set_cols[c]).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c))
    if flag:
        cols.append(hit.alias(flag))
    # carry the change columns a caller may want (e.g. the change sequence)
    extra = [F.col(f"chg_{c}") for c in changes.columns]
    return j.select(*cols, *extra) if flag else j.select(*cols)


def delete_by_keys(state: DataFrame, keys: DataFrame, on: str, key_col: str | None = None) -> DataFrame:
    """DELETE FROM state WHERE on IN (keys): a left anti join."""
    k = keys.select(F.col(key_col or on).alias(on)).where(F.col(on).isNotNull())
    return state.join(k, on, "left_anti")
