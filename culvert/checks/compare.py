"""Run a registered Spark query and its DuckDB oracle side by side and compare
row count, column names and an order-insensitive hash of normalised values."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}" if abs(v) < 1e15 else repr(v)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["schema_match"] = sorted(s_cols) == sorted(d_cols)
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    out["value_match"] = sh == dh
    out["status"] = "ok" if (out["schema_match"] and out["value_match"] and sn == dn) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ls = sorted("|".join(_norm(r[i]) for i in order_s) for r in s_rows)
        ld = sorted("|".join(_norm(r[i]) for i in order_d) for r in d_rows)
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        out["sample_only_spark"], out["sample_only_oracle"] = only_s, only_d
    return out
