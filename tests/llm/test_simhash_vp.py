"""SimHash fingerprints and vantage-point trees against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from brute import LOWER, WORD
from edge_rows import ROWS, SF
from pyspark.sql import functions as F

from culvert.llm import simhash_vp
from culvert.llm.common import table


def plain(t):
    w = WORD.findall((t or "").translate(LOWER))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(rows):
    """(doc_id, fingerprint, component) of each (doc_id, fingerprint)."""
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, f, least.get(top(i), d)) for i, (d, f) in enumerate(rows)]


def key(x):
    return tuple(-1 if v is None else v for v in x)


def test_edge_rows_equal_brute_force(spark, edge, nothing, monkeypatch):
    monkeypatch.setattr(simhash_vp, "PIECE", 100)  # a long text in many pieces
    got = sorted(key((r["doc_id"], r["fp"] % (1 << 64), r["component"])) for r in simhash_vp.near_components(edge).collect())
    assert got == sorted(map(key, groups([(d, plain(t)) for d, t in ROWS])))
    assert simhash_vp.near_components(nothing).count() == 0


@pytest.mark.parametrize("shard, leaf", [(20, 4), (1 << 20, 128)])
def test_near_texts_equal_brute_force(spark, rows_of, monkeypatch, shard, leaf):
    monkeypatch.setattr(simhash_vp, "SHARD", shard)
    monkeypatch.setattr(simhash_vp, "LEAF", leaf)
    r = random.Random(9)
    bases = [[str(r.randrange(1000)) for _ in range(r.randint(1, 300))] for _ in range(30)]
    rows = []
    for i in range(400):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = str(r.randrange(1000))
        rows.append((i, " ".join(w)))
    got = sorted((x["doc_id"], x["fp"] % (1 << 64), x["component"]) for x in simhash_vp.near_components(rows_of(spark, rows)).collect())
    assert got == sorted(groups([(d, plain(t)) for d, t in rows]))


@pytest.mark.parametrize("leaves", [1, 7, 64])
def test_trees_find_every_pair_once_or_more(leaves):
    r = np.random.RandomState(leaves)
    number = lambda n: r.randint(0, 1 << 62, n, dtype=np.int64).astype(np.uint64) * np.uint64(4) + r.randint(0, 4, n).astype(np.uint64)
    x = number(3000)
    near = x[:600].copy()
    for _ in range(3):
        near ^= np.uint64(1) << r.randint(0, 64, 600).astype(np.uint64)
    crowd = np.full(700, x[0])
    for _ in range(5):
        crowd ^= np.uint64(1) << r.randint(0, 64, 700).astype(np.uint64)
    upper = x[1] & simhash_vp.UPPER | r.randint(0, 1 << 31, 500).astype(np.uint64)  # one upper half
    points = np.unique(np.concatenate((x, near, crowd, upper)))
    up = {p: p for p in points.tolist()}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for half in (simhash_vp.UPPER, simhash_vp.LOWER):
        tree, n = simhash_vp.grow(points[::5], half, leaves)
        home = 0
        for shard, homes, visitors in simhash_vp.deal(tree, points, points[:0]):
            assert 0 <= shard < n
            home += len(homes)
            for a, b in simhash_vp.edges(homes, visitors, half):
                assert len(a) <= len(homes) + len(visitors)
                for p, q in zip(a.tolist(), b.tolist()):
                    up[top(p)] = top(q)
        assert home == len(points)
    got = {p: top(p) for p in up}
    up = {p: p for p in points.tolist()}
    for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)):
        up[top(int(points[i]))] = top(int(points[j]))
    assert len(set(got.values())) == len({top(p) for p in up}) and all(got[p] == got[top(p)] for p in up)


def test_hashes_are_those_of_spark(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").where("doc_id < 40")
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash_vp.fingerprints(docs).collect()}
    assert got == {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)
