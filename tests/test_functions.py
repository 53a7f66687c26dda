"""Golden cases for the scalar rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from culvert.functions import codes as C
from culvert.functions import ids as I
from culvert.functions.text import cat, clean_longdesc, strip_html


def one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


CLEAN_CASES = [
    ("<p>x</p>", "<p>x</p>"),
    ("&lt;b&gt;x", "&lt;b&gt;x"),
    ("&amp;lt;b&amp;gt;x", "&lt;b&gt;x"),
    ("&amp;amp;lt;b&amp;amp;gt;x", "x"),
    ("&amp;amp;lt;p&amp;amp;gt;x", "&lt;p&gt;x"),
    ("&amp;amp;lt;P&amp;amp;gt;x", "x"),
    ("&amp;amp;lt;style&amp;amp;gt;q&amp;amp;lt;/style&amp;amp;gt;x", "x"),
    ("&amp;amp;lt;!DOCTYPE html&amp;amp;gt;x", "&lt;!DOCTYPE html&gt;x"),
    ("A &amp; B", "A & B"),
    ("   ", None),
    (None, None),
    ("  a \n\n b \t", "a b"),
]


@pytest.mark.parametrize("inp,out", CLEAN_CASES)
def test_clean_longdesc(spark, inp, out):
    assert one(spark, clean_longdesc, [inp]) == [out]


STRIP_CASES = [
    ("\n<p>x</p>\n", " x "),
    (" <p>x</p> ", "x"),
    ("1 < 2", "1 < 2"),
    ("1 < 2 > 0", "1 0"),
    ("<p></p>", None),
    ("no tags\n here", "no tags\n here"),
    (None, None),
    ("<script>var a;</script>ok<style>p{}</style>", "ok"),
    ("<head><title>t</title></head><b>body</b>", "body"),
    ("<!DOCTYPE html><P>Hi</P>", "Hi"),
]


@pytest.mark.parametrize("inp,out", STRIP_CASES)
def test_strip_html(spark, inp, out):
    assert one(spark, strip_html, [inp]) == [out]


def test_strip_html_stable_except_surviving_lt(spark):
    once = one(spark, strip_html, ["\n a < b\n"])[0]
    assert once == " a < b "
    assert one(spark, strip_html, [once]) == ["a < b"]


CANON_CASES = [
    ("0123456789abcdef0123456789ABCDEF", "01234567-89ab-cdef-0123-456789abcdef"),
    ("01234567-89AB-CDEF-0123-456789ABCDEF", "01234567-89ab-cdef-0123-456789abcdef"),
    ("{01234567-89ab-cdef-0123-456789abcdef}", "01234567-89ab-cdef-0123-456789abcdef"),
    ("0123456789abcdef0123456789abcde", "0123456789abcdef0123456789abcde"),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("inp,out", CANON_CASES)
def test_canonical_uuid(spark, inp, out):
    assert one(spark, I.canonical_uuid, [inp]) == [out]


def test_compact_and_hex_roundtrip(spark):
    got = one(spark, lambda c: I.raw_hex(I.hex_raw(I.compact_uuid(c))), ["01234567-89ab-cdef-0123-456789abcdef"])
    assert got == ["0123456789ABCDEF0123456789ABCDEF"]
    assert one(spark, I.is_valid_hex, ["zz-01", "ab-cd"]) == [False, True]


def test_drop_last_segment(spark):
    assert one(spark, I.drop_last_segment, ["A-1-2", "-abc", "abc", "a-", None]) == ["A-1", "-abc", "abc", "a", None]


def test_pipe_base_ref(spark):
    got = one(spark, I.pipe_base_ref, ["PIP12", "cbl7", "PIP", "X9", None, "pipe"])
    assert got == ["12", "7", None, "X9", None, "e"]


def test_strip_prefix_case_sensitive(spark):
    assert one(spark, lambda c: I.strip_prefix(c, "MH"), ["MH12", "mh12", "MH", "XMH1"]) == ["12", "mh12", None, "XMH1"]


def test_task_number(spark):
    df = spark.createDataFrame([(None, 1), ("WO5", None), (None, None)], "wo string, n long")
    got = [r[0] for r in df.select(I.task_number(F.col("wo"), F.col("n"))).collect()]
    assert got == [".1", "WO5.", "."]
    assert [r[0] for r in df.select(cat(F.col("wo"), "-")).collect()] == ["-", "WO5-", "-"]


def test_grade_to_invert(spark):
    rows = [(Decimal("10"), Decimal("7.5")), (Decimal("0"), Decimal("7")), (Decimal("10"), Decimal("0")),
            (None, Decimal("7")), (Decimal("3.00005"), Decimal("1"))]
    df = spark.createDataFrame(rows, "g decimal(38,10), i decimal(38,10)")
    got = [r[0] for r in df.select(C.grade_to_invert(F.col("g"), F.col("i"))).collect()]
    assert got == [Decimal("2.5000"), None, None, None, Decimal("2.0001")]


def test_pipe_use_code(spark):
    vals = [" storm ", "Combined", "n/a", "NA", "water", "other", None, "FOUNDATION DRAIN", "sanitary"]
    with_c = one(spark, lambda c: C.pipe_use_code(c, True), vals)
    without = one(spark, lambda c: C.pipe_use_code(c, False), vals)
    assert with_c == ["SW", "CB", "XX", "XX", "XX", None, None, "SW", "SS"]
    assert without == ["SW", None, "XX", "XX", "XX", None, None, "SW", "SS"]


def test_null_safe_changed(spark):
    import datetime as dt
    s = dt.datetime(1900, 1, 1)
    rows = [(None, None), (None, s), (dt.datetime(2020, 1, 1), None), (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(C.null_safe_changed(F.col("a"), F.col("b"), F.lit(s).cast("timestamp_ntz"))).collect()]
    assert got == [False, False, True, False]


def test_canonical_uuid_of_ready_forms(spark):
    h = "0123456789abcdefABCDEF0123456789"
    dashed = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"
    odd = [h, h.upper(), dashed, dashed + "\n", h + "\n", h[:31], h + "0", "{" + dashed + "}", "--", "", None, dashed.replace("-", "_"), "Ａ" + h]
    import re

    def slow(c):
        bare = None if c is None else re.sub("[^0-9A-Fa-f]", "", c)
        return bare and re.sub("^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"\1-\2-\3-\4-\5", bare).lower() or None
    got = [r[0] for r in spark.createDataFrame([(c,) for c in odd], "c string").select(I.canonical_uuid(F.col("c"))).collect()]
    assert got == [slow(c) for c in odd]


@pytest.mark.parametrize("form", [str, str.upper])
def test_pack_id_gives_back_every_text(spark, form):
    h = "0123456789abcdef0123456789abcdef"
    d = "01234567-89ab-cdef-0123-456789abcdef"
    rows = [h, d, "1" * 32, "1" * 8 + "-1111" * 3 + "-" + "1" * 12]
    odd = [None, "", "-", " " + h, h + "\n", h[:-1], h + "0", h[:31] + "g", h[:16] + h[16:].upper(), d.replace("-", "", 1), d + "\n",
           "-" + d[:-1], h[:16].upper() + "é" + h[17:], "\x00" + h[1:], "\x01" + h, "\x01", "ü" * 16, "a" * 15]
    rows = [form(r) for r in rows] + odd
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string").repartition(3)
    got = df.select("i", I.pack_id(F.col("s")).alias("p")).select("i", I.unpack_id(F.col("p")).alias("s"), F.length("p").alias("n"))
    got = sorted(got.collect())
    assert [r["s"] for r in got] == rows
    assert [r["n"] for r in got[:4]] == [17] * 4 and got[4]["n"] is None
