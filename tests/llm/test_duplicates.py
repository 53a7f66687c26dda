"""Fingerprints, Jaccard join, suffix-array dedup, components, and the pipeline."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from brute import covered, links, personal, sha, shingles
from edge_rows import ROWS, SF, frame
from pyspark.sql import functions as F

from culvert.llm import components, imatch, jaccard, pii, suffix_dedup
from culvert.llm.common import table
from culvert.llm.langid import language_id


def _near_rows(n=150, seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(2, 6)))
    bases = [[word() for _ in range(r.randint(4, 90))] for _ in range(12)]
    line = [word() for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(r.choice(bases)) if r.random() < 0.7 else [word() for _ in range(r.randint(1, 60))]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.4:
            w = line + w
        rows.append((i, " ".join(w) if r.random() < 0.9 else " ".join(w).upper()))
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 128])
def test_links_equal_brute_force(spark, rows_of, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    if chunk == 1:  # without any hub round everything goes through the matrix
        monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = _near_rows()
    got = sorted((r["doc"], r["n"], r["component"]) for r in jaccard.linked_components(rows_of(spark, rows)).collect())
    assert got == sorted(links(rows))


def test_links_of_edge_rows(spark, edge, nothing):
    key = lambda x: tuple(-1 if v is None else v for v in x)
    got = sorted(key((r["doc"], r["n"], r["component"])) for r in jaccard.linked_components(edge).collect())
    assert got == sorted(map(key, links(ROWS)))
    assert jaccard.linked_components(nothing).count() == 0


def test_one_row_of_each_group_stays(spark, rows_of, edge):
    rows = _near_rows(seed=4)
    got = sorted(r["doc_id"] for r in jaccard.representatives(rows_of(spark, rows)).collect())
    assert got == sorted({c for _, _, c in links(rows)})
    kept = jaccard.representatives(edge)
    assert kept.columns == edge.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[7] == 1 and ids[9] == 0 and ids[5] == 1 and ids[6] == 0 and ids[1] == ids[2] == ids[3] == 1 and ids[14] == 0 and ids[8] == 1


def test_a_threshold_pair_is_exact():
    a = np.arange(100, dtype=np.uint64)
    assert jaccard.linked(a[:80], a) and not jaccard.linked(a[:79], a)
    assert shingles("a b") == frozenset(["a b"])


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(7, 7), (1, 0), (1, 0)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == top(x) for x in got) and {x for a, b in edges if a != b for x in (a, b)} == set(got)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh"])
def test_repeated_windows_of_groups_equal_brute_force(letters):
    r = random.Random(len(letters))
    some = lambda n: bytearray(r.choice(letters) for _ in range(n))
    groups = []
    for g in range(60):
        left, gram, right, seen = some(100), bytes(some(100)), some(100), set()
        for _ in range(r.choice([2, 3, 25])):
            a, b = bytearray(left), bytearray(right)
            for _ in range(r.randint(0, 3)):
                r.choice([a, b])[r.randrange(100)] = r.choice(letters)
            if r.random() < 0.2:
                a = some(100)
            back = r.randint(0, 100)
            more = r.randint(0, back)
            raw = bytes(a[100 - back:]) + gram + bytes(b[:more + 100 - back])
            if (raw, back) not in seen:
                seen.add((raw, back))
                groups.append((g, raw, back))
    holders: dict = {}
    for g, raw, back in groups:
        for k in range(len(raw) - 199):
            holders.setdefault((g, raw[k:k + 200]), set()).add((raw, back))
    got = suffix_dedup.repeated_windows(groups)
    assert any(x.any() for x in got) and not all(x.all() for x in got)
    for (g, raw, _), hit in zip(groups, got):
        assert hit.tolist() == [len(holders[g, raw[k:k + 200]]) > 1 for k in range(len(raw) - 199)]


def test_suffix_array_is_sorted():
    for n in range(1, 9):
        for s in itertools.product((1, 2), repeat=n):
            s = [*s, 0]
            assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    r = random.Random(3)
    for _ in range(300):
        s = [r.randint(1, r.choice([2, 3, 9])) for _ in range(r.randint(1, 80))]
        s = s * r.randint(1, 3) + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def _repeat_rows():
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdéf") for _ in range(r.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(70) for _ in range(4)]
    rows = []
    for i in range(70):
        parts = [prose(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, 60)
            parts += [s[a:], prose(r.randint(0, 30))]
        rows.append((i, " ".join(parts)))
    return rows + [(200, "ab" * 300), (201, "xyz" * 67), (202, "q" * 199), (203, "q" * 200), (204, rows[3][1]), (205, None), (206, "")]


def _removed(rows):
    raw, masks = covered(rows)
    return sorted((-1 if d is None else d, len(b), sum(m), len(re.findall(b"\x01+", m)), sha(bytes(x for x, y in zip(b, m) if not y))) for (d, _), b, m in zip(rows, raw, masks))


@pytest.mark.parametrize("group", [2000, 1])
def test_removal_equals_brute_force(spark, rows_of, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)  # 1: every open group is counted by window hashes
    rows = _repeat_rows()
    got = sorted((r["doc_id"], *list(r)[1:]) for r in suffix_dedup.removed(rows_of(spark, rows)).collect())
    assert got == _removed(rows)


def test_removal_of_edge_rows(spark, edge, nothing):
    rows = [(d, t if t is None or len(t) < 5000 else t[:5000]) for d, t in ROWS]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], *list(r)[1:]) for r in suffix_dedup.removed(frame(spark, rows)).collect())
    assert got == _removed(rows)
    assert suffix_dedup.removed(nothing).count() == 0
    kept = suffix_dedup.without_repeats(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    texts = {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] != 8}
    assert texts[1] is None and texts[5] == "" and texts[13] == "one two three"


def test_texts_without_id_are_told_apart(spark, rows_of):
    """Different texts of one doc value whose hashes agree in their low 18 bits."""
    r = random.Random(11)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared = [prose(60) for _ in range(3)]
    made = [(None, prose(r.randint(0, 9)) + shared[i % 3][r.randint(0, 90):] + prose(r.randint(0, 9))) for i in range(2500)]
    low = F.xxhash64("text").bitwiseAND(F.lit((1 << 18) - 1))
    alike = rows_of(spark, made).groupBy(low).agg(F.sort_array(F.collect_list("text")).alias("t")).where("size(t) > 1").select("t").collect()
    rows = [(None, t) for x in alike for t in x["t"]][:40] + [(1, shared[0])]
    assert len(rows) > 2
    for group in (2000, 1):
        suffix_dedup.GROUP, kept = group, suffix_dedup.GROUP
        try:
            got = sorted((-1 if x["doc_id"] is None else x["doc_id"], *list(x)[1:]) for x in suffix_dedup.removed(rows_of(spark, rows)).collect())
        finally:
            suffix_dedup.GROUP = kept
        assert got == _removed(rows)
    raw, masks = covered(rows)
    want = sorted(suffix_dedup.kept_text(b, [q.span() for q in re.finditer(b"\x01+", m)]) for b, m in zip(raw, masks))
    assert sorted(x["text"] for x in suffix_dedup.without_repeats(rows_of(spark, rows)).collect()) == want


def test_kept_text_keeps_characters_whole():
    assert suffix_dedup.kept_text("aéb€c".encode(), [(2, 5)]) == "aé€c"
    assert suffix_dedup.kept_text("abc".encode(), [(0, 3)]) == ""


def test_fingerprints(spark, edge, nothing, rows_of):
    lex = imatch.lexicon(edge)
    got = {}
    shared = spark.sparkContext.broadcast(lex)
    from culvert.llm.common import texts

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = imatch.in_order(texts(edge)).mapInArrow(imatch._compare(shared), schema).collect()
    order = sorted(((d, t or "") for d, t in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = Counter((d, len(t), sha(imatch.edited(t, order[(i + 1) % len(order)][1]))) for i, (d, t) in enumerate(order))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert got[5] == got[6] and got[7] <= got[8] and got[1] == got[2] == got[3] and got[5] != got[7]
    assert imatch.in_order(texts(nothing)).count() == 0
    assert imatch.likeness(imatch.signatures(["a b c"], lex), imatch.signatures(["c  b\na A"], lex))[0] == 1


def test_lexicon_is_the_band(spark, rows_of, monkeypatch):
    r = random.Random(2)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.4)) % 5000}" for _ in range(30))) for i in range(900)]
    monkeypatch.setattr(imatch, "RARE", 0.01)
    df = Counter(w for _, t in rows for w in set(t.split()))
    lex = imatch.lexicon(rows_of(spark, rows).repartition(3))
    words = sorted(df)
    import pyarrow as pa

    _, h = imatch._terms(pa.array([" ".join(words)]))
    assert [w for w, ok in zip(words, lex.has(h)) if ok] == [w for w in words if 9 <= df[w] <= 900 * imatch.COMMON]


def test_pipeline_equals_its_rules(spark):
    docs = table(spark, SF, "documents")
    outs, d = [], docs
    from culvert.llm.common import stored

    for name, stage in corpus_pipeline.STAGES:
        d = stored(stage(spark, d, SF), f"test-{name}")
        outs.append(d)
    first, second, third, fourth, last = outs
    assert all(o.columns == docs.columns for o in outs[:-1])
    rows = lambda f: {r["doc_id"]: r["text"] for r in f.collect()}
    a, b, c, e = map(rows, (first, second, third, fourth))
    lang, _ = language_id(docs)
    assert set(a) == {r["doc_id"] for r in lang.collect() if r["_lang_id"]["lang"] != "und" and not r["_lang_id"]["ambiguous"]} and len(a) >= 0.98 * docs.count()
    assert set(b) == {k for _, _, k in links(sorted(a.items()))}
    raw, masks = covered(sorted(b.items()))
    for (k, t), x, m in zip(sorted(b.items()), raw, masks):
        assert c[k] == suffix_dedup.kept_text(x, [q.span() for q in re.finditer(b"\x01+", m)])
    assert e == {k: pii.redact(t) for k, t in c.items()} and not any(personal(t) for t in e.values())
    from test_tokens_and_archives import _check

    _check(last.collect(), sorted(e.items()))
    assert [r["n_chars"] for r in fourth.collect()] == [len(r["text"]) for r in fourth.collect()]
