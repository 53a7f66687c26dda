"""SimHash fingerprints, and all their pairs within three bits by vantage-point trees.

1. Fingerprint: every 3-word shingle of the lower-cased text is hashed (XXH64, seed 42); a bit is 1 where more than half of
   the hashes have it. Equal fingerprints are one point from there on.
2. Two fingerprints within ``RADIUS`` = 3 bits are within one bit in their upper or their lower 32 bits. So there are two
   trees, one for each half: a vantage point and a radius part the points by the Hamming distance of that half, and a pair that
   the tree has to find differs by at most one in its distances (triangle inequality). Distances of whole 64-bit
   fingerprints lie so close together (32 +- 4) that a ball of three bits would meet both sides of most nodes; in a half,
   only points on the rim of a ball do. Where a half cannot part the points, a node takes the whole distance and three bits.
3. The first levels of a tree, fitted on a bounded sample, deal the points to shards. A point is at home in one shard, and
   visits the shards beyond every rim that it lies on: pairs across a boundary are found by the visitor.
4. A shard goes on with the same tree over its own points down to leaves, where home points are compared with home points and
   visitors. A leaf gives one edge for a linked point, to its least partner by links, so groups never become all pairs.

The sample (``SAMPLE`` points at most) steers the work only: any tree gives the same links. Every point is dealt, every
shard is searched whole.

Defined cases: fewer than three words are one shingle; null, empty and blank texts have the fingerprint zero, which links like any
other; repeated rows and equal texts have one fingerprint; a null doc_id never names a component unless it has no other
member; an empty table gives no rows; other columns are neither read nor changed. A text of any length is hashed in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import discard, slices, stored, table, texts
from culvert.llm.components import components

SHINGLE, SEED = 3, 42
#: Differing bits of linked fingerprints, at most.
RADIUS = 3
#: Points at home in a shard, on average; sampled points for each shard, and in all.
SHARD, PER_SHARD, SAMPLE = 4096, 32, 1 << 18
#: Points of a leaf, which are compared one by one; visitors compared with them at once.
LEAF, BLOCK = 128, 4096
#: Bytes of text whose words are held at once.
PIECE = 1 << 20
#: The halves of a fingerprint, and the whole.
UPPER, LOWER, WHOLE = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFFFFFFFFFF)

_LOWER_CASE = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(raw: bytes):
    """The XXH64 digests (8 bytes each, high byte first) of all shingles of a text, in pieces."""
    low, at, words, some = raw.translate(_LOWER_CASE), 0, [], False
    digest = xxhash.xxh64_digest
    while at < len(low):
        cut = _SPACE.search(low, at + PIECE)
        end = cut.start() if cut else len(low)
        words = words + low[at:end].split()
        at = end
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            yield b"".join([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[SHINGLE - 1:].tolist())])
            words, some = words[1 - SHINGLE:], True
    if words and not some:
        yield digest(b" ".join(words), SEED)


def fingerprint(raw: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed number."""
    ones, n = np.zeros(64, np.int64), 0
    for digests in shingle_hashes(raw):
        for k in range(0, len(digests), 8 << 16):
            bits = np.unpackbits(np.frombuffer(digests[k:k + (8 << 16)], np.uint8)).reshape(-1, 64)
            ones += bits.sum(0, dtype=np.int64)
            n += len(bits)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                raw = part.column(1).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([fingerprint(t.as_py()) for t in raw], pa.int64())], ["doc_id", "fp"])

    return texts(docs, text=text).mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ trees


def _distance(x: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ vantage) & mask).astype(np.int16)


def vantage(points: np.ndarray, half: np.uint64):
    """(mask, slack, vantage point, radius): the ball that parts the points, with the fewest on its rim; None if none does."""
    tried = points[np.linspace(0, len(points) - 1, 6).astype(np.int64)]
    for mask, slack in ((half, RADIUS // 2), (WHOLE, RADIUS)):
        best = None
        for v in tried:
            count = np.bincount(_distance(points, v, mask), minlength=66)
            inner = np.cumsum(count)
            for r in np.flatnonzero((inner * 4 >= len(points)) & (inner * 4 <= 3 * len(points))):
                rim = count[max(0, r - slack + 1):r + slack + 1].sum() / min(inner[r], len(points) - inner[r])
                if best is None or rim < best[0]:
                    best = rim, mask, slack, v, int(r)
        if best:
            return best[1:]
    return None


def _sides(node, homes: np.ndarray, visitors: np.ndarray):
    """(homes, visitors) inside the ball and outside; a pair across the rim is left to the visitors outside."""
    mask, slack, v, r = node
    d, e = _distance(homes, v, mask), _distance(visitors, v, mask)
    inner = d <= r
    return (homes[inner], visitors[e <= r + slack]), (homes[~inner], np.concatenate((homes[inner & (d > r - slack)], visitors[e > r - slack])))


def grow(points: np.ndarray, half: np.uint64, leaves: int, first: int = 0):
    """A tree of about ``leaves`` leaves over sampled points: nested (node, inside, outside), leaves are numbers from ``first``."""
    node = vantage(points, half) if leaves > 1 and len(points) > 1 else None
    if node is None:
        return first, first + 1
    (a, _), (b, _) = _sides(node, points, points[:0])
    share = max(1, round(leaves * len(a) / len(points)))
    inside, after = grow(a, half, min(share, leaves - 1), first)
    outside, after = grow(b, half, leaves - min(share, leaves - 1), after)
    return (node, inside, outside), after


def deal(tree, homes: np.ndarray, visitors: np.ndarray):
    """(shard, homes, visitors) of every shard that some point is at home in or visits."""
    if not len(homes) + len(visitors):
        return
    if isinstance(tree, int):
        yield tree, homes, visitors
        return
    for side, below in zip(_sides(tree[0], homes, visitors), tree[1:]):
        yield from deal(below, *side)


def _stars(homes: np.ndarray, others: np.ndarray):
    """Edges (point, least linked point) between homes and homes, and homes and others."""
    for k in range(0, max(1, len(others)), BLOCK):
        points = np.concatenate((homes, others[k:k + BLOCK]))
        near = np.bitwise_count(homes[:, None] ^ points[None, :]) <= RADIUS
        if np.count_nonzero(near) == len(homes):  # each is near itself only
            continue
        label = np.arange(len(points))
        while True:
            hub = np.where(near, label, len(points)).min(1)
            new = np.minimum(label, np.where(near, hub[:, None], len(points)).min(0))
            if (new == label).all():
                break
            label = new
        some = label != np.arange(len(points))
        yield points[some], points[label[some]]


def edges(homes: np.ndarray, visitors: np.ndarray, half: np.uint64):
    """Edges that span all links of the homes with homes and visitors, by the tree of these points."""
    todo = [(homes, visitors)]
    while todo:
        homes, visitors = todo.pop()
        if not len(homes):
            continue
        node = vantage(homes, half) if len(homes) > LEAF else None
        if node is None:
            for k in range(0, len(homes), LEAF):  # more than one turn only for points that no ball parts
                yield from _stars(homes[k:k + LEAF], np.concatenate((homes[k + LEAF:], visitors)))
        else:
            todo.extend(_sides(node, homes, visitors))


def _edge_rows(points: DataFrame) -> DataFrame:
    """(a, b): edges that span all links between the distinct fingerprints ``points`` (fp)."""
    spark = points.sparkSession
    leaves = min(max(1, points.count() // SHARD), SAMPLE // PER_SHARD)
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(leaves * PER_SHARD).toArrow().column("fp").to_numpy().view(np.uint64)
    trees, after = [], 0
    for half in (UPPER, LOWER):
        tree, after = grow(sample, half, leaves, after)
        trees.append((tree, after))
    shared = spark.sparkContext.broadcast(trees)

    def copies(batches):
        def dealt(rows):
            x, nothing = np.concatenate(rows).view(np.uint64), np.zeros(0, np.uint64)
            for tree, _ in shared.value:
                for shard, homes, visitors in deal(tree, x, nothing):
                    both = np.concatenate((homes, visitors))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(both), shard, np.int32)), pa.array(both.view(np.int64)), pa.array(np.arange(len(both)) < len(homes))], ["shard", "fp", "home"])

        rows = []
        for batch in batches:
            rows.append(batch.column(0).to_numpy())
            if sum(map(len, rows)) > 1 << 20:
                yield from dealt(rows)
                rows = []
        if rows:
            yield from dealt(rows)

    def joined(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, home = [], []
        for batch in batches:
            fp.append(batch.column("fp").to_numpy().view(np.uint64))
            home.append(batch.column("home").to_numpy(zero_copy_only=False))
        fp, home = np.concatenate(fp), np.concatenate(home)
        half = UPPER if key[0].as_py() < shared.value[0][1] else LOWER
        for a, b in edges(fp[home], fp[~home], half):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = points.select("fp").mapInArrow(copies, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(joined, "a long, b long")


def near_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc_id, fp (signed) and component, the least doc_id reachable by links of fingerprints."""
    rows = stored(fingerprints(docs, text), "fingerprints")
    points = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("doc")), "points")
    found = stored(_edge_rows(points), "near")
    roots = components(found)
    named = points.join(roots, points["fp"] == roots["node"], "left").select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    by_fp = stored(named.join(least, "root").select("fp", "component"), "named")
    discard(points, found)
    return rows.join(by_fp, "fp").select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component"))


def op11_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
