"""Mixture-controlled packing of token sequences by deficit round-robin over source queues.

Documents are tokenised once, ended by the end id, stored with a number of their own, and queued by source. Every window of
``WINDOW`` tokens gives each source a quantum in proportion to its target share; a source is served while it has credit, what
it could not use (or took beyond it) is carried to the next window, and when only sources without credit have tokens the one
owed most goes on, so no window waits. Rows are dealt to parts by a hash of their number, so equal rows spread. The credit
that a part starts with is its share of all tokens before it less the source's own tokens before it, counted exactly over all
parts and for every source, so shares are steered over the whole table, not per part. Nothing is left out, so a target above
what a source has can only bring its tokens forward.

Windows are cut into sequences of 2048 tokens. What remains at the end of a part is cut into powers of two, which
need no padding. The target shares default to the table's own, by tokens.

Defined cases: null text is empty (its document is the end id alone); a null source is a source of its own; equal rows are
packed each; a document of any length is cut at window ends; an empty table gives no rows; other columns are not read.
Memory is bounded by one part's tokens (``PART_TOKENS`` on average) or one document.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culvert.llm.common import ship, slices, stored, table
from culvert.llm.textnum import buffer, mix, prefix, span

SEQUENCE = 2048
WINDOW = 16 * SEQUENCE
END = 1
#: Tokens of a part on average.
PART_TOKENS = 3 << 20
#: Shuffle partitions at most; a task takes its parts one after another.
TASKS = 1 << 15
#: Children of a node in the tree over the parts that gives the sums before each.
FAN = 256
#: Encoded cuts kept by a worker.
CACHE = 2_000_000

OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: the split of byte-level BPE tokenizer files.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level BPE files: printable bytes stand for themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + size), one after another."""
    total = int(size.sum())
    at = np.cumsum(size) - size
    return np.repeat(start - at, size) + np.arange(total)


class Tokens:
    """Byte-level BPE of a tokenizer file (its vocabulary ranked by id) that encodes each distinct word of a block once.

    The split pattern never joins characters across a single white space between two other characters, other than by
    putting a space before the next word. So a text is cut before each single space or newline, the distinct cuts are
    found by their hashes, new ones are encoded in one call, and their ids are told apart by the bytes each id stands
    for. Texts with any other white space are encoded whole. Texts are cut at the file's added tokens first, whose ids
    stand for them, as the tokenizers library does by default; ``plain`` encodes those as any other text. At most ``CACHE`` cuts are kept between blocks.
    """

    def __init__(self, path: str, plain: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, added = _byte_of(), {t["content"]: t for t in spec.get("added_tokens", ())}
        odd = [c for c, t in added.items() if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or any(c != d and c in d for d in added)]
        if odd and not plain:
            raise ValueError(f"{path}: added tokens that take in white space, whole words or each other: {odd}")
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.added = {} if plain else {c: t["id"] for c, t in added.items()}
        self.coder = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.added)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, i in ranks.items():
            self.size[i] = len(t)
        self.clear()

    def clear(self) -> None:
        self.known, self.at, self.length, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, data: np.ndarray, key: np.ndarray, start: np.ndarray, size: np.ndarray, bare: np.ndarray) -> None:
        """Encode new cuts; one without its own white space (a text's first) gets a newline, whose id is dropped again."""
        ends = np.cumsum(size + bare)
        joined = np.full(int(ends[-1]), 10, np.uint8)
        joined[_ragged(ends - size, size)] = data[_ragged(start, size)]
        ids = np.array(self.coder.encode_ordinary(joined.tobytes().decode()), np.uint32)
        cut = np.concatenate(([0], np.searchsorted(np.cumsum(self.size[ids]), ends) + 1))
        spot = np.searchsorted(self.known, key)  # both are sorted
        self.at = np.insert(self.at, spot, len(self.flat) + cut[:-1] + bare)
        self.length = np.insert(self.length, spot, cut[1:] - cut[:-1] - bare)
        self.known = np.insert(self.known, spot, key)
        self.flat = np.concatenate((self.flat, ids))

    def _odd(self, data: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> np.ndarray:
        """Rows with white space other than single spaces and newlines between other characters (or that may have it)."""
        b = data[1:]
        a = data[:-1]
        bad = (data >= 9) & (data <= 31) & (data != 10)
        bad[:-1] |= sep[:-1] & sep[1:]
        bad[:-1] |= ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80))
        full = offs[1:] > offs[:-1]
        odd = np.zeros(len(full), bool)
        odd[full] = np.add.reduceat(bad, offs[:-1][full]) > 0
        odd[full] |= sep[offs[:-1][full]] | sep[offs[1:][full] - 1]
        return odd

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode(text, allowed_special="all") if self.added else self.coder.encode_ordinary(text), np.uint32)

    def encode(self, values: pa.Array) -> list[np.ndarray]:
        """Ids of each text, the end id included."""
        data, offs = buffer(values)
        rows = len(values)
        counts, flat, odd = np.zeros(rows, np.int64), np.zeros(0, np.uint32), np.zeros(rows, bool)
        if len(data):
            sep = (data == 32) | (data == 10)
            odd = self._odd(data, offs, sep)
            for content in self.added:
                odd |= pc.match_substring(values, content).to_numpy(zero_copy_only=False)
            first = np.zeros(len(data) + 1, bool)
            first[offs] = True
            start = np.flatnonzero(sep | first[:-1])
            size = np.diff(np.concatenate((start, [len(data)])))
            row = np.searchsorted(offs, start, "right") - 1
            keep = ~odd[row]
            start, size, row = start[keep], size[keep], row[keep]
            bare = first[start].astype(np.int64)
            key = mix(span(prefix(data), start, start + size) + (size * 2 + bare).astype(np.uint64))
            uniq, at, inv = np.unique(key, return_index=True, return_inverse=True)
            if len(self.known) + len(uniq) > CACHE:
                self.clear()
            spot = np.searchsorted(self.known, uniq)
            new = np.ones(len(uniq), bool)
            inside = spot < len(self.known)
            new[inside] = self.known[spot[inside]] != uniq[inside]
            if new.any():
                f = at[new]
                self._learn(data, uniq[new], start[f], size[f], bare[f])
                spot = np.searchsorted(self.known, uniq)
            length = self.length[spot][inv]
            flat = self.flat[_ragged(self.at[spot][inv], length)]
            counts = np.bincount(row, length, rows).astype(np.int64)
        ends, end = np.cumsum(counts), np.array([END], np.uint32)
        return [np.concatenate((self._whole(values[i].as_py()) if odd[i] else flat[ends[i] - counts[i]:ends[i]], end)) for i in range(rows)]


_tokens: dict[tuple[str, bool], Tokens] = {}


def tokens(path: str, plain: bool = False) -> Tokens:
    """The tokeniser of a file, kept by the worker; ``plain`` takes added tokens inside texts as plain text."""
    if (path, plain) not in _tokens:
        _tokens[path, plain] = Tokens(path, plain)
    return _tokens[path, plain]


def windows(docs: list[tuple[object, object, np.ndarray]], share: dict, credit: dict):
    """Deficit round-robin over (key, source, ids): yield the pieces (document index, start, length) of each window in order.

    ``share`` has each source's target; ``credit`` is what each is owed, and is carried on in place."""
    queues: dict[object, deque] = {}
    for i, (_, source, ids) in enumerate(docs):
        queues.setdefault(source, deque()).append([i, 0, len(ids)])
    order = sorted(queues, key=lambda s: (s is not None, str(s)))
    while any(queues.values()):
        room, window = WINDOW, []
        for s in order:
            credit[s] = credit.get(s, 0.0) + share.get(s, 0.0) * WINDOW

        def serve(s, most):
            nonlocal room
            i, at, left = queues[s][0]
            n = min(left, room, most)
            window.append((i, at, n))
            room -= n
            credit[s] = credit.get(s, 0.0) - n
            if n == left:
                queues[s].popleft()
            else:
                queues[s][0] = [i, at + n, left - n]

        served = True
        while room and served:
            served = False
            for s in order:
                while room and queues[s] and credit.get(s, 0.0) >= 1:
                    serve(s, room)
                    served = True
        while room and any(queues.values()):
            serve(max((s for s in order if queues[s]), key=lambda s: credit.get(s, 0.0)), room)
        yield window


def sequences(pieces_by_window, total: int):
    """Cut the stream of window pieces at sequence ends: (document index, start, length, sequence, offset)."""
    seq = offset = done = 0
    size = SEQUENCE
    for window in pieces_by_window:
        for i, at, n in window:
            while n:
                if offset == 0:
                    left = total - done
                    size = SEQUENCE if left >= SEQUENCE else 1 << (left.bit_length() - 1)
                k = min(n, size - offset)
                yield i, at, k, seq, offset
                at, n, offset, done = at + k, n - k, offset + k, done + k
                if offset == size:
                    seq, offset = seq + 1, 0


def _planes(ids: np.ndarray) -> bytes:
    """Ids as all their lowest bytes, then all the next ones, and so on, which codecs pack well."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _ids(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _encoded(docs: DataFrame, tokenizer: str, text: str, source: str, plain: bool) -> DataFrame:
    """(doc_id, source, number, n, ids) of every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("number"),
    )

    def run(batches):
        tok = tokens(tokenizer, plain)
        for batch in batches:
            for part in slices(batch, 2):
                ids = tok.encode(part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array([len(x) for x in ids], pa.int64()), pa.array([_planes(x) for x in ids], pa.binary())],
                    ["doc_id", "source", "number", "n", "ids"],
                )

    return rows.mapInArrow(run, "doc_id long, source string, number long, n long, ids binary")


def before(counts: DataFrame, parts: int, *keys: str) -> DataFrame:
    """(keys, part, before): the sum of ``n`` over all smaller parts with the same keys, for the pairs that ``counts`` has.

    A part is a leaf of a tree with ``FAN`` children a node; what lies before it are the earlier siblings of each of its
    ancestors, so no task holds more than ``FAN`` rows of a key."""
    counts = counts.groupBy(*keys, "part").agg(F.sum("n").alias("n"))
    out, width = counts.select(*keys, "part", F.lit(0).cast("long").alias("before")), 1
    while width < parts:
        nodes = counts.groupBy(*keys, F.expr(f"part div {width}").alias("node")).agg(F.sum("n").alias("n"))
        earlier = Window.partitionBy(*keys, F.expr(f"node div {FAN}")).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        nodes = nodes.select(*(F.col(k).alias(f"_{k}") for k in keys), "node", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
        same = F.expr(f"part div {width}") == F.col("node")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        out = out.join(nodes, same).select(*keys, "part", (F.col("before") + F.col("earlier")).alias("before"))
        width *= FAN
    return out


def targets(counts: DataFrame, shares: dict | None) -> DataFrame:
    """(source, share) of every source: the given shares (0 where none is given), or those of its tokens, with the sum 1."""
    sums = counts.groupBy("source").agg(F.sum("n").cast("double").alias("share"))
    if shares is not None:
        given = counts.sparkSession.createDataFrame([(k, float(v)) for k, v in shares.items()], "_source string, _share double")
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").select("source", F.coalesce("_share", F.lit(0.0)).alias("share"))
    whole = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.select("source", (F.col("share") / whole).alias("share"))


def owed(counts: DataFrame, parts: int, shares: dict | None) -> DataFrame:
    """(part, due): for each source of a part its target share and the tokens it is owed at the part's start."""
    own = before(counts, parts, "source").select("source", "part", F.col("before").alias("own"))
    whole = before(counts, parts).select("part", F.col("before").alias("whole"))
    share = targets(counts, shares).select(F.col("source").alias("_source"), "share")
    due = own.join(whole, "part").join(share, F.col("source").eqNullSafe(F.col("_source")))
    return due.groupBy("part").agg(F.collect_list(F.struct("source", "share", (F.col("share") * F.col("whole") - F.col("own")).alias("owed"))).alias("due"))


def packed(docs: DataFrame, tokenizer: str, shares: dict | None = None, text: str = "text", source: str = "source", plain: bool = False) -> DataFrame:
    """Pieces of all documents; ``shares`` are target token shares by source (default: as in the table). ``plain``: see ``tokens``."""
    ship(docs.sparkSession)
    kept = stored(_encoded(docs, tokenizer, text, source, plain), "tokens")
    parts = max(1, -(-(kept.agg(F.sum("n")).first()[0] or 0) // PART_TOKENS))
    rows = kept.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
    counts = stored(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "mixture")
    heads = owed(counts, parts, shares).select("part", F.lit(0).alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.lit(b"").alias("ids"), F.lit(-1).cast("long").alias("number"), "due")
    body = rows.select("part", F.lit(1).alias("row"), "doc_id", "source", "ids", "number", F.lit(None).cast(heads.schema["due"].dataType).alias("due"))
    dealt = body.unionByName(heads).repartition(min(parts, TASKS), "part").sortWithinPartitions("part", "row", F.xxhash64("number"), "number")

    def run(batches):
        current, ids, share, credit = None, [], {}, {}

        def flush():
            doc, start, length, crc, of, seq, off = ([] for _ in range(7))
            for i, at, n, s, o in sequences(windows(ids, share, credit), sum(len(x[2]) for x in ids)):
                key, _, x = ids[i]
                for column, value in ((doc, key), (start, at), (length, n), (crc, zlib.crc32(x[at:at + n].tobytes())), (of, len(x)), (seq, current << 32 | s), (off, o)):
                    column.append(value)
            if doc:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, length, crc, of, seq, off)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for part in slices(batch, 4, 4 << 20):
                for p, r, key, src, x, due in zip(*(part.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6))):
                    if p != current:
                        yield from flush()
                        current, ids, share, credit = p, [], {}, {}
                    if r:
                        ids.append((key, src, _ids(x)))
                    else:
                        share, credit = {d["source"]: d["share"] for d in due}, {d["source"]: d["owed"] for d in due}
        yield from flush()

    return dealt.mapInArrow(run, OUT)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), default_tokenizer())
