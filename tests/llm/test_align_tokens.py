"""Token alignment against the public libraries and brute force over bytes."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge_rows import ROWS, SF

from culvert.llm import align_tokens as A
from culvert.llm.common import table
from culvert.llm.packing import default_tokenizer
from culvert.llm.pieces import default_model

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """(rows -> expected columns), with the tokenizers and sentencepiece libraries and a loop over token spans."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def spans(raw):
        out, at = [], 0
        for r in raw:
            out.append((at, at + len(r)))
            at += len(r)
        return out

    def one(text):
        if not text:
            return None
        want = (" " + text).encode()
        ia, ib = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        ra = [bytes(byte[c] for c in t.id_to_token(i)) for i in ia]
        rb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ra) != want or b"".join(rb) != want:
            return None
        sa, sb = spans(ra), spans(rb)
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, x, y = [], 0, 0
        for high in common:
            u, v = x, y
            while u < len(sa) and sa[u][1] <= high:
                u += 1
            while v < len(sb) and sb[v][1] <= high:
                v += 1
            groups.append(",".join(map(str, ia[x:u])) + "|" + ",".join(map(str, ib[y:v])))
            x, y = u, v
        links = Counter()
        j = 0
        for i, (s, e) in zip(ia, sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links[i, ib[k]] += 1
                k += 1
        return len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def expected(texts):
        got = [one(x) for x in texts]
        held = Counter(p for g in got if g for p in g[3])
        most = Counter()
        for (a, _), n in held.items():
            most[a] = max(most[a], n)
        return [(*g[:3], sum(g[3].values()), sum(n for p, n in g[3].items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in g[3].items()), g[4]) if g else (0, 0, 0, 0, 0, 0, "") for g in got]

    return expected


ODD = ["<|endoftext|> in <s>a</s> text", "▁ marked", "a  b\t\tc \n\n d ", " leading", "trailing ", "naïve café 東京都 😀", "ﬁ ligature Å", "it's I'll 'x", "x", "'s", "1234567890 12", "\x00\x01", "<0x41> <unk>", "\r\n\r\n", "a b c"]


def test_edge_rows_equal_brute_force(spark, rows_of, plain, nothing, monkeypatch):
    rows = [(d, t if t is None else t[:4000]) for d, t in ROWS] + [(100 + i, t) for i, t in enumerate(ODD)]
    want = Counter((d, *v) for (d, _), v in zip(rows, plain([t for _, t in rows])))
    both = default_tokenizer(), default_model()
    assert Counter((r["doc_id"], *[r[n] for n in NAMES]) for r in A.token_alignment(rows_of(spark, rows), *both).collect()) == want
    monkeypatch.setattr(A, "SLICE", 300)  # counts in several slices
    monkeypatch.setattr(A, "COUNTED", 50)
    assert Counter((r["doc_id"], *[r[n] for n in NAMES]) for r in A.token_alignment(rows_of(spark, rows), *both).collect()) == want
    assert A.token_alignment(nothing, *both).count() == 0


def test_documents_equal_brute_force(spark, plain):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = Counter((d, *v) for (d, _), v in zip(rows, plain([t for _, t in rows])))
    assert Counter((r["doc_id"], *[r[n] for n in NAMES]) for r in A.op13_token_alignment(spark, SF).collect()) == want


def test_gallop_is_the_rank():
    r = random.Random(2)
    for _ in range(200):
        longer = sorted(r.sample(range(500), r.randint(1, 60)))
        keys = sorted(r.randint(0, longer[-1]) for _ in range(r.randint(1, 40)))
        pad = r.randint(0, 3)
        array = np.array([10 ** 6] * pad + longer + [-1])
        low, high = np.full(len(keys), pad), np.full(len(keys), pad + len(longer))
        guess = np.array([r.randrange(pad, pad + len(longer)) for _ in keys])
        got = A.gallop(np.array(keys), array, guess, low, high)
        assert got.tolist() == [pad + int(np.searchsorted(longer, k)) for k in keys]


def test_a_very_long_unspaced_text(plain):
    text = "".join(random.Random(4).choice("abcdé€") for _ in range(60000))
    both = A.aligner(default_tokenizer(), default_model())
    got = both.align(pa.array([text, None, ""]))
    assert got[0][:5] == plain([text])[0][:4] + plain([text])[0][6:] and got[1] == got[2] == (0, 0, 0, 0, "", b"", b"")
