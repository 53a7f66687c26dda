"""Code rules: pipe-use text -> code, code-or-raw fallback, grade to invert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.lookups import PIPE_USE_RULES


def norm_key(c: Column) -> Column:
    """Join form of a free-text attribute: trimmed of spaces, upper-cased."""
    return F.upper(F.trim(c))


def pipe_use_code(c: Column, with_combined: bool) -> Column:
    """Normalised use text -> code. COMBINED is recognised only when ``with_combined``."""
    k = norm_key(c)
    out = None
    for text, code in PIPE_USE_RULES:
        if text == "COMBINED" and not with_combined:
            continue
        out = F.when(k == text, code) if out is None else out.when(k == text, code)
    return out.otherwise(F.lit(None).cast("string"))


def code_or_raw(code: Column, raw: Column) -> Column:
    """Mapped code when there is one, else the raw text unchanged."""
    return F.coalesce(code, raw)


def grade_to_invert(ground: Column, invert: Column) -> Column:
    """ground - invert rounded half-up to 4 places; null when either is null or zero.

    Exact DECIMAL arithmetic: both sides are widened to DECIMAL(37,10) so that the
    difference keeps scale 10 (DECIMAL(38,10)) before rounding.
    """
    g, i = ground.cast("decimal(37,10)"), invert.cast("decimal(37,10)")
    bad = g.isNull() | i.isNull() | (g == 0) | (i == 0)
    return F.when(bad, F.lit(None).cast("decimal(38,4)")).otherwise(F.round(g - i, 4).cast("decimal(38,4)"))


def null_safe_changed(a: Column, b: Column, sentinel) -> Column:
    """'Really changed' test with a sentinel for null: NVL(a,s) <> NVL(b,s).

    A value equal to the sentinel compares equal to null, as upstream.
    """
    s = F.lit(sentinel)
    return F.coalesce(a, s) != F.coalesce(b, s)
