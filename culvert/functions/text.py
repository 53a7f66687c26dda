"""Text helpers: empty-is-null, null-tolerant concatenation, the two HTML cleaners.

All are Column -> Column, built from JVM functions, so they stay inside whole-stage
codegen. No Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nn(c: Column) -> Column:
    """Empty string reads as null upstream; apply to every string result that may be ''."""
    return F.nullif(c, F.lit(""))


def cat(*cols) -> Column:
    """Concatenation where a null operand counts as empty (``a || '.' || b`` upstream)."""
    return F.concat_ws("", *[F.lit(c) if isinstance(c, str) else c for c in cols])


def fit(c: Column, n: int | None) -> Column:
    """Silent truncation to n characters (a CAST to a shorter VARCHAR upstream)."""
    return c if n is None else F.left(c, F.lit(n))


# ---------------------------------------------------------------------------
# FIXED VALUES: the long-description cleaner, in order. The patterns are kept
# literally, including their double-escaped entity form.
# ---------------------------------------------------------------------------
LONGDESC_LITERAL_REPLACES = [
    ("&amp;lt;", "&lt;"),
    ("&amp;gt;", "&gt;"),
    ("&amp;nbsp;", "&nbsp;"),
    ("&amp;quot;", "&quot;"),
    ("&amp;#39;", "&#39;"),
    ("&amp;amp;", "&amp;"),
]
LONGDESC_REGEX_DELETES = [
    "(?is)&amp;lt;!DOCTYPE[^&amp;gt;]*&amp;gt;",
    "(?is)&amp;lt;head[^&amp;gt;]*&amp;gt;.*?&amp;lt;/head&amp;gt;",
    "(?is)&amp;lt;style[^&amp;gt;]*&amp;gt;.*?&amp;lt;/style&amp;gt;",
    "(?is)&amp;lt;script[^&amp;gt;]*&amp;gt;.*?&amp;lt;/script&amp;gt;",
    "(?s)&amp;lt;[^&amp;gt;]+&amp;gt;",
]
# The write-path cleaner, in order; each match becomes one space.
HTML_BLOCK_PATTERNS = [
    r"(?is)<(script|style)[^>]*>.*?</\1>",
    r"(?is)<head[^>]*>.*?</head>",
    r"(?is)<!DOCTYPE[^>]*>",
    r"(?is)<[^>]+>",
]
# ---------------------------------------------------------------------------


def clean_longdesc(c: Column) -> Column:
    """Clean a task long description (entity unescape, tag removal, white-space fold)."""
    out = c
    for old, new in LONGDESC_LITERAL_REPLACES:
        out = F.replace(out, F.lit(old), F.lit(new))
    for pat in LONGDESC_REGEX_DELETES:
        out = F.regexp_replace(out, pat, "")
    out = F.regexp_replace(out, r"\s+", " ")
    out = F.regexp_replace(out, r"^\s+|\s+$", "")
    out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    return nn(out)


def strip_html(c: Column) -> Column:
    """Write-path HTML cleaner: only values holding a '<' are touched.

    Blocks and tags become a space, the result is trimmed of spaces and then runs
    of white space are folded to one space (so the trim happens first).
    """
    out = c
    for pat in HTML_BLOCK_PATTERNS:
        out = F.regexp_replace(out, pat, " ")
    out = F.regexp_replace(F.trim(out), r"\s+", " ")
    return F.when(c.isNotNull() & c.contains("<"), nn(out)).otherwise(c)
