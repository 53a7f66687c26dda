"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits, URL schemes and
identifier cues. At each anchor a deterministic local parser expands to both sides and validates the boundary.

Kinds, in this order: the base kinds ``email``, ``ip`` (parts at most 255), ``card`` (16 to 19 digits, Luhn) and
``phone`` (8 to 15 digits), which are leftmost and non-overlapping per kind; then the kinds the method adds:
``url`` (scheme with a host), ``iban`` (after its cue, mod 97), ``account`` (digits after an account cue) and
``secret`` (a value of 16 characters or more after a credential cue). Added spans never change base spans.

Defined cases: null text is empty; empty text has no spans; equal texts have equal spans; spans are code points, end
exclusive; texts are never cut; other columns are neither read nor changed.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import ship, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://", "ftps://")
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "ssn", "passport")
SECRET_CUES = ("token", "api_key", "apikey", "secret", "password", "passwd", "access_key", "private_key")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_RUN = re.compile(r"[0-9]++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"(?:[A-Za-z0-9._%+-]++(?::[^\s@/]*)?@)?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?")
_IBAN = re.compile(r"[:\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"[^0-9A-Za-z]{0,3}(?:(?:no|nr|number|num)[^0-9A-Za-z]{0,3})?([0-9](?:[ -]?[0-9]){5,17})(?![0-9A-Za-z])", re.I)
_SECRET = re.compile(r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_=.-]{16,})")

_automaton = None


def _anchors():
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        a.add_word("@", ("email", 1))
        a.add_word("+", ("phone", 1))
        for d in "0123456789":
            a.add_word(d, ("digit", 1))
        for kind, words in (("url", SCHEMES), ("iban", ("iban",)), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            for w in words:
                for form in {w, w.upper(), w.capitalize()}:
                    a.add_word(form, (kind, len(form)))
        a.make_automaton()
        _automaton = a
    return _automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digit_spans(text: str, at: list[int], kind: str, pattern, ok, spans: list) -> None:
    """Leftmost matches from the digit anchors; one that fails its test is passed over, not tried again."""
    pos = 0
    for p in at:
        if p < pos:
            continue
        m = pattern.match(text, p)
        if m is None:
            pos = _RUN.match(text, p).end()
            continue
        pos = m.end()
        if ok(m.group()):
            spans.append((kind, p, pos))


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of one text, ordered by kind as in ``KINDS``, then start."""
    at: dict[str, list[tuple[int, int]]] = {}
    for end, (kind, size) in _anchors().iter(text):
        at.setdefault(kind, []).append((end + 1 - size, end + 1))
    if not at:
        return []
    spans: list[tuple[str, int, int]] = []
    last = 0
    for a, after in at.get("email", ()):
        i = a
        while i > last and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, after) if i < a else None
        if m:
            last = m.end()
            spans.append(("email", i, last))
    digits = [a for a, _ in at.get("digit", ())]
    _digit_spans(text, digits, "ip", _IP, lambda s: all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split(".")), spans)
    _digit_spans(text, digits, "card", _CARD, lambda s: 16 <= len(d := s.replace(" ", "").replace("-", "")) <= 19 and luhn(d), spans)
    for a, _ in at.get("phone", ()):
        m = _PHONE.match(text, a)
        if m and 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append(("phone", a, m.end()))
    for kind, pattern, ok in (("url", _URL, None), ("iban", _IBAN, _iban_ok), ("account", _ACCOUNT, None), ("secret", _SECRET, None)):
        last = 0
        for a, after in at.get(kind, ()):
            m = pattern.match(text, after) if a >= last else None
            if m is None or kind != "url" and a and text[a - 1].isalnum():
                continue
            start, end = (a, m.end()) if kind == "url" else m.span(1)
            while kind == "url" and text[end - 1] in ".,;:!?)]":
                end -= 1
            if ok is None or ok(text[start:end]):
                spans.append((kind, start, end))
                last = end
    return spans


SPANS = "array<struct<kind: string, start: int, end: int>>"


def _spans_udf():
    @F.arrow_udf(SPANS)
    def spans(text: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in find(t or "")] for t in text.to_pylist()], kind)

    return spans


def _mask_udf():
    @F.arrow_udf("string")
    def mask(text: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redact(t) for t in text.to_pylist()], pa.string())

    return mask


def redact(text: str) -> str:
    """``text`` with each span (overlapping ones merged) replaced by the first kind's name in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(find(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def with_spans(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    ship(docs.sparkSession)
    return docs.withColumn(out, _spans_udf()(F.coalesce(F.col(text), F.lit(""))))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; null stays null."""
    ship(docs.sparkSession)
    return docs.withColumn(text, _mask_udf()(F.col(text)))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = with_spans(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "_s")
    count = lambda k: F.size(F.filter("_s", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("_s", lambda s: s["kind"].isin(*BASE_KINDS))
    return got.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined("_s").alias("spans"))
