"""Randomised checks of the id rules against plain-Python statements of the same rules."""

import random
import re

from pyspark.sql import functions as F

from culvert.functions import ids as I
from culvert.functions.text import clean_longdesc, strip_html

ALPHABET = "0123456789abcdefABCDEF-{} xyzPIPcblCBLMH"


def _strings(seed, n=400, max_len=40):
    rnd = random.Random(seed)
    out = [None, "", "-", "PIP", "cbl", "a-", "-a"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))))
    # exact 32-hex cases, with and without dashes / case changes
    for _ in range(60):
        h = "".join(rnd.choice("0123456789abcdef") for _ in range(32))
        out.append(rnd.choice([h, h.upper(), f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", "{" + h + "}"]))
    return out


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}


def py_canonical(s):
    if s is None:
        return None
    bare = re.sub("[^0-9A-Fa-f]", "", s)
    if len(bare) == 32:
        bare = f"{bare[:8]}-{bare[8:12]}-{bare[12:16]}-{bare[16:20]}-{bare[20:]}"
    return bare.lower() or None


def py_drop_last_segment(s):
    if s is None:
        return None
    pos = s.rfind("-")
    return s[:pos] if pos > 0 else s


def py_pipe_base_ref(s):
    if s is None:
        return None
    if s.upper().startswith(("PIP", "CBL")):
        return s[3:] or None
    return s


def test_id_rules_match_python(spark):
    vals = _strings(3)
    for fn, ref in [(I.canonical_uuid, py_canonical), (I.drop_last_segment, py_drop_last_segment),
                    (I.pipe_base_ref, py_pipe_base_ref)]:
        got = _apply(spark, fn, vals)
        for i, v in enumerate(vals):
            assert got[i] == ref(v), (fn.__name__, v, got[i], ref(v))


def test_canonical_is_idempotent_and_cleaners_stable(spark):
    vals = _strings(5)
    once = _apply(spark, I.canonical_uuid, vals)
    twice = _apply(spark, lambda c: I.canonical_uuid(I.canonical_uuid(c)), vals)
    assert once == twice
    html = ["<p>a</p>", "<b>x</b> <i>y</i>", "plain", None, "<script>z</script>q", "a<br/>b"]
    s1 = _apply(spark, strip_html, html)
    s2 = _apply(spark, lambda c: strip_html(strip_html(c)), html)
    assert s1 == s2          # no '<' survives in these, so a second pass changes nothing
    c1 = _apply(spark, clean_longdesc, ["  a  b ", "&amp;amp;lt;b&amp;amp;gt;x", None])
    assert c1 == {0: "a b", 1: "x", 2: None}
