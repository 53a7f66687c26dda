"""SentencePiece, packing, WARC archives."""

from __future__ import annotations

import io
import random
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from brute import sha

from culvert.llm import packing, pieces, warc

HARD = ["", "a", " ", "  ", "   x", "a  b   c    d", "\n\n a", "▁▁a ▁", "ab\ncd \n", "ﬁ①\t　z", "😀 x😀", "aaaa aaaaaaa", "0000000", "it's a don't  x", "a b c", "x\t y", "end.\n Start", "<|endoftext|> a", "é ü\nñ", "a \nb"]


def _random(n=400):
    r = random.Random(8)
    return ["".join(r.choice("ab 1\n.▁é'") for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_pieces_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    c = pieces.Coder(pieces.default_model())
    texts = HARD + _random(1500)
    for t, ids in zip(texts, c.encode(texts)):
        assert ids.tolist() == sp.encode(t), t
        assert c.decode(ids) == t.replace("▁", " ")


def test_pieces_frame(spark, edge, nothing):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for r in pieces.decoded(pieces.encoded(edge, "ids", pieces.default_model()), "ids", "back", pieces.default_model()).collect():
        t = r["text"] or ""
        assert r["ids"] == sp.encode(t) and r["back"] == t
    got = pieces.round_trips(edge, pieces.default_model()).collect()
    assert len(got) == edge.count() and all(r["same_text"] for r in got)
    assert Counter(r["decoded_sha256"] for r in got) == Counter(sha(r["text"] or "") for r in edge.collect())
    assert pieces.round_trips(nothing, pieces.default_model()).count() == 0


def _ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    return [e.ids + [packing.END] for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_tokens_equal_the_library():
    texts = HARD + _random()
    t = packing.tokens(packing.default_tokenizer(), plain=True)
    for _ in range(2):  # the second time from the cache
        assert [x.tolist() for x in t.encode(pa.array(texts))] == _ids(texts)


def test_added_tokens_inside_texts_equal_the_library(spark, rows_of):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    r = random.Random(12)
    texts = ["x <|endoftext|> a", "<|endoftext|>", "a<|endoftext|><|endoftext|> \n b", "<|endoftext|", "it's <|endoftext|>'s  x", " <|endoftext|>\n", "é<|endoftext|>é"]
    texts += ["".join(r.choice(["<|endoftext|>", " ", "\n", "ab", "1", "é", "<|"]) for _ in range(r.randint(0, 20))) for _ in range(300)]
    want = [e.ids + [packing.END] for e in tok.encode_batch(HARD + texts, add_special_tokens=False)]
    assert want[len(HARD)] == [87, 220, 50256, 257, packing.END]
    t = packing.tokens(packing.default_tokenizer(), plain=False)
    for _ in range(2):
        assert [x.tolist() for x in t.encode(pa.array(HARD + texts))] == want
    got = packing.packed(rows_of(spark, list(enumerate(texts[:7]))), packing.default_tokenizer()).select("doc_id", "doc_tokens").distinct().collect()
    assert dict(map(tuple, got)) == {i: len(x) for i, x in enumerate(want[len(HARD):][:7])}


def _check(rows, docs):
    want = defaultdict(list)
    for (d, t), ids in zip(docs, _ids([t or "" for _, t in docs])):
        want[d].append(ids)
    seqs, of = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        of[r["doc_id"]].append((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]))
    padding = 0
    for x in seqs.values():
        x.sort()
        total = sum(n for _, n in x)
        assert [o for o, _ in x] == list(np.cumsum([0] + [n for _, n in x])[:-1]) and 0 < total <= packing.SEQUENCE
        padding += 0 if total & (total - 1) == 0 else packing.SEQUENCE - total
    assert padding == 0
    assert of.keys() == want.keys()
    for d, lists in want.items():
        expected = Counter()
        if len(lists) == 1:
            x = lists[0]
            at = 0
            for total, start, n, crc in sorted(of[d], key=lambda p: p[1]):
                assert total == len(x) and start == at and crc == zlib.crc32(np.array(x[start:start + n], "<u4").tobytes())
                at += n
            assert at == len(x)
        else:  # rows that repeat an id
            assert sum(p[2] for p in of[d]) == sum(map(len, lists))
        expected.clear()


def test_packing_frame(spark, edge, nothing):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    _check(packing.packed(edge, packing.default_tokenizer()).collect(), docs)
    assert packing.packed(nothing, packing.default_tokenizer()).count() == 0


def test_windows_hold_the_shares_and_lose_nothing():
    r = random.Random(6)
    docs = [(i, s, np.zeros(r.randint(1, 3000), np.uint32)) for i in range(1500) for s in [r.choice("aaab")]]
    share, credit = {"a": 0.5, "b": 0.5}, {}
    seen, first = Counter(), None
    for k, w in enumerate(packing.windows(docs, share, credit)):
        for i, at, n in w:
            assert seen[i] == at
            seen[i] += n
        if k == 5:
            first = Counter()
            for i, _, n in w:
                first[docs[i][1]] += n
    assert all(seen[i] == len(x) for i, _, x in docs)
    assert abs(first["a"] / sum(first.values()) - 0.5) < 0.15


def test_every_source_is_owed_its_share_of_all_parts_before(spark):
    r = random.Random(18)
    names = [None, *(f"s{i}" for i in range(2999))]
    counts = Counter()
    for _ in range(20_000):
        counts[r.randrange(70_000), r.choice(names) if r.random() < 0.7 else "s7"] += r.randint(1, 10**9)
    frame = spark.createDataFrame([(p, s, n) for (p, s), n in counts.items()], "part long, source string, n long")
    for shares in (None, {"s7": 3.0, None: 1.0, "s9": 0.5, "not there": 2.0}):
        weight = Counter()
        for (_, s), n in counts.items():
            weight[s] += n
        if shares:
            weight = {s: shares.get(s, 0.0) for s in weight}
        whole, own, want = 0, Counter(), {}
        for p, s in sorted(counts, key=lambda k: (k[0], str(k[1]))):
            want[p, s] = (weight[s] / sum(weight.values()), own[s])
            own[s] += counts[p, s]
        ahead = {}
        totals = Counter()
        for (p, _), n in counts.items():
            totals[p] += n
        whole = 0
        for p in sorted(totals):
            ahead[p] = whole
            whole += totals[p]
        got = {(x["part"], d["source"]): (d["share"], d["owed"]) for x in packing.owed(frame, 70_000, shares).collect() for d in x["due"]}
        assert got.keys() == want.keys()
        for k, (share, mine) in want.items():
            assert abs(got[k][0] - share) < 1e-12 and abs(got[k][1] - (share * ahead[k[0]] - mine)) < 1e-9 * whole


def test_shares_hold_over_all_windows_of_all_parts():
    r = random.Random(19)
    weights = [1 / (k + 1) for k in range(300)]
    parts = [[(i, s, np.zeros(r.randint(1, 3000), np.uint32)) for i, s in enumerate(r.choices(range(300), weights, k=400))] for _ in range(12)]
    total = Counter()
    for docs in parts:
        for _, s, x in docs:
            total[s] += len(x)
    whole = sum(total.values())
    share = {s: n / whole for s, n in total.items()}
    seen, done, worst = Counter(), 0, 0.0
    for docs in parts:
        credit = {s: share[s] * done - seen[s] for s in {s for _, s, _ in docs}}
        for w in packing.windows(docs, share, credit):
            for i, _, n in w:
                seen[docs[i][1]] += n
                done += n
            worst = max(worst, *(abs(seen[s] - share[s] * done) for s in share))
    assert done == whole and seen == total and worst < 0.01 * whole


def test_equal_rows_are_dealt_to_many_parts(spark, rows_of, monkeypatch):
    monkeypatch.setattr(packing, "PART_TOKENS", 500)
    docs = [(None, "the same text again and again")] * 300 + [(k, "t " * k) for k in range(40)]
    rows = packing.packed(rows_of(spark, docs), packing.default_tokenizer()).collect()
    _check(rows, docs)
    assert len({r["sequence_id"] >> 32 for r in rows if r["doc_id"] is None}) > 3


def test_remainders_are_powers_of_two():
    got = list(packing.sequences([[(0, 0, 5000)]], 5000))
    sizes = Counter()
    for _, _, n, s, _ in got:
        sizes[s] += n
    assert [sizes[s] for s in sorted(sizes)] == [2048, 2048, 512, 256, 128, 8]


def test_archives_are_valid_zip(tmp_path):
    for wide in (False, True):
        out = io.BytesIO()
        a = warc.Archive(out, wide)
        data = {"x.bin": b"abc" * 1000, "empty": b"", "é.txt": b"hello"}
        for name, raw in data.items():
            a.begin(name)
            for k in range(0, len(raw), 700):
                a.add(raw[k:k + 700])
            a.end()
        a.close()
        raw = out.getvalue()
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            assert z.testzip() is None and {i.filename: z.read(i) for i in z.infolist()} == data
        members = warc.directory(lambda at, n: raw[at:at + n], len(raw))
        assert {n: raw[at:at + size] for n, (at, size) in members.items()} == data


def test_reader_takes_archives_of_the_standard_library(tmp_path):
    p = tmp_path / "a.zip"
    with zipfile.ZipFile(p, "w", zipfile.ZIP_STORED) as z:
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"q" * 5000)
        z.writestr("small", b"s")
        z.comment = b"a comment"
    raw = p.read_bytes()
    members = warc.directory(lambda at, n: raw[at:at + n], len(raw))
    assert {n: raw[at:at + s] for n, (at, s) in members.items()} == {"big": b"q" * 5000, "small": b"s"}


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>" + "é" * 200, "<p>" + "z" * 99
    rows = [(5, "u5", big), (3, "u3", big), (9, "u9", big), (4, None, "small"), (6, "u6", "small"), (7, "u7", None), (8, "a\r\nb: c", ""), (10, "u", other), (10, "u", other), (11, "v", other), (12, "w", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "c", "c", "c") for r in rows], "page_id long, url string, html string, digest string, size string, first string")
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        first = min(q for q, _, g in rows if (g or "") == (h or ""))
        revisit = len(raw) >= warc.REVISIT_FROM and p != first
        want.append((p, len(raw), sha(raw), "revisit" if revisit else "response", first if revisit else -1))
    for k, limit in enumerate((1 << 30, 500)):
        folder = f"file://{tmp_path}/{k}"
        archives = warc.write(pages, folder, zip64=bool(k), limit=limit)
        got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in warc.read(archives, folder).collect()]
        assert sorted(got) == sorted(want)
    empty = warc.write(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read(empty, f"file://{tmp_path}/none").count() == 0


def test_a_very_long_unspaced_word():
    import random
    import tracemalloc

    import sentencepiece

    from culvert.llm.pieces import Coder, default_model

    word = "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyzABC0123456789+/=\u00e9\u6771", k=400_000))
    coder = Coder(default_model())
    coder.encode([word[:20_000]])
    tracemalloc.start()
    got = coder.encode([word, "short " + word[:300]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    assert got[0].tolist() == sp.encode(word) and got[1].tolist() == sp.encode("short " + word[:300])
    assert peak < 400 * len(word) and not any(len(w) > 256 for w in coder.cache)


def test_archives_equal_their_sql(spark):
    import duckdb
    from edge_rows import SF

    from culvert.llm.queries import ORACLE

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cur = con.execute(ORACLE["op5_warc"])
    names = [d[0] for d in cur.description]
    got = warc.op5_warc(spark, SF)
    assert sorted(got.columns) == sorted(names)
    key = lambda rows: sorted(map(str, rows))
    assert key(tuple(r[n] for n in names) for r in got.collect()) == key(cur.fetchall())
