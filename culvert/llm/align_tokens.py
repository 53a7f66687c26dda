"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection of their end offsets.

A text is encoded by both tokenizers. Each gives a sorted list of the byte offsets where its tokens end. The shorter list
drives: each of its ends is looked up in the longer one by an exponential search, which starts where it would lie if tokens were spread
evenly and doubles its step until it has passed the end, and a binary search in between (all ends of a block of texts at once).
Ends that both lists have cut the tokens into groups. Between two driving ends, the difference of their ranks in
the longer list is the range of tokens that overlap: the links.

How many documents hold an id pair linked is counted over all documents: the distinct pairs of each document are kept in a stored
table, counted by block and then by pair. The counts go back to the documents in slices of at most ``SLICE`` pairs, one
broadcast and one pass over the stored pairs for each, so what is broadcast has a fixed size however many pairs there are.

Defined cases: texts that are null, empty, or that a tokenizer does not give back byte for byte (it drops or changes characters)
have no tokens, all counts zero and no digest; equal texts are documents of their own in every count, and so are rows that
repeat a doc_id or have none; an empty table gives no rows; other columns are neither read nor changed. A text is aligned
whole; memory is bounded by one slice of rows, or one text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import discard, slices, stored, table, texts, tidy
from culvert.llm.packing import default_tokenizer, tokens
from culvert.llm.pieces import default_model
from culvert.llm.textnum import buffer

#: Pairs whose counts are broadcast at once (12 bytes each); pairs counted together before they are shuffled.
SLICE, COUNTED = 4 << 20, 4 << 20
#: Text bytes that are aligned together.
PART = 1 << 20


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + size), one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def gallop(keys: np.ndarray, longer: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The first place in [low, high) where ``longer``, sorted there, is not below the key; its last entry is not."""
    up = longer[guess] < keys
    below, above = np.where(up, guess, low - 1), np.where(up, high - 1, guess)
    todo, step = np.arange(len(keys)), 1
    while len(todo):
        rising, first, last = up[todo], low[todo], high[todo] - 1
        at = np.where(rising, np.minimum(guess[todo] + step, last), np.maximum(guess[todo] - step, first - 1))
        less = (at < first) | (longer[np.maximum(at, 0)] < keys[todo])
        below[todo[less]] = at[less]
        above[todo[~less]] = at[~less]
        todo = todo[(less == rising) & (at >= first) & (at < last)]
        step *= 2
    todo = np.flatnonzero(above - below > 1)
    while len(todo):
        mid = (below[todo] + above[todo]) >> 1
        less = longer[mid] < keys[todo]
        below[todo[less]] = mid[less]
        above[todo[~less]] = mid[~less]
        todo = todo[above[todo] - below[todo] > 1]
    return above


def overlaps(ends: np.ndarray, size: np.ndarray, longer: np.ndarray, long_size: np.ndarray):
    """For each token of the shorter lists (``size`` tokens a row, ending at ``ends``): the first and the last token of the
    longer lists that it overlaps, and whether one ends with it."""
    first, base = np.cumsum(long_size) - long_size, np.cumsum(size) - size
    low, place = np.repeat(first, size), np.arange(len(ends)) - np.repeat(base, size)
    guess = low + place * np.repeat(long_size, size) // np.repeat(size, size)
    last = gallop(ends, longer, guess, low, low + np.repeat(long_size, size))
    both = longer[last] == ends
    start = np.concatenate((last[:0], [0], (last + both)[:-1])) if len(ends) else last
    start[base] = first
    return start, last, both


class Vocabulary:
    """The bytes of each id, and its decimal digits."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        digits = [str(i).encode() for i in range(len(entries))]
        self.wide = len(digits[-1]) + 1
        self.digits = np.frombuffer(b"".join(d.ljust(self.wide, b"\0") for d in digits), np.uint8).reshape(-1, self.wide)
        self.length = np.array([len(d) for d in digits])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.at[ids], self.size[ids])]


class Aligner:
    """Two tokenizers: a byte-level BPE file (A) and a SentencePiece model (B, which puts a space before the text)."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = tokens(a, plain=True)
        self.lead = len(self.a.encode(pa.array(["x"]))[0]) - 1
        ranks = sorted((i, t) for t, i in self.a.coder._mergeable_ranks.items())
        entries = [b""] * (ranks[-1][0] + 1)
        for i, t in ranks:
            entries[i] = t
        self.words_a = Vocabulary(entries)
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=b)
        piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.words_b = Vocabulary([bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(piece)])
        self.pairs = "<u4" if len(entries) * len(piece) < 1 << 32 else "<u8"

    def encode(self, values: pa.Array):
        """(ids of A, ids of B, whether both give back the space and the text) of non-empty texts."""
        led = [" " + t for t in values.to_pylist()]
        # a letter before the space is a word of its own to A's split, and spares it texts that begin with white space
        a = [x[self.lead:-1] for x in self.a.encode(pa.array(["x" + t for t in led], pa.string()))]
        b = [np.array(x, np.int64) for x in self.b.encode([t[1:] for t in led], num_threads=1)]
        same = []
        for t, x, y in zip(led, a, b):
            raw = np.frombuffer(t.encode(), np.uint8)
            same.append(np.array_equal(self.words_a.joined(x), raw) and np.array_equal(self.words_b.joined(y), raw))
        return a, b, np.array(same, bool)

    def digests(self, a, b, ends_a, ends_b, rows_a):
        """SHA-256 of the groups of each row: ids in order, `,` within and `|` after those of A, `;` between groups."""
        wide = max(self.words_a.wide, self.words_b.wide)
        in_a, in_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        many_a, many_b = np.bincount(in_a), np.bincount(in_b)
        at_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[in_a]
        at_b = np.arange(len(b)) + np.cumsum(many_a)[in_b]
        cells, length = np.zeros((len(a) + len(b), wide), np.uint8), np.zeros(len(a) + len(b), np.int64)
        for words, ids, at, end, mark in ((self.words_a, a, at_a, ends_a, b"|"), (self.words_b, b, at_b, ends_b, b";")):
            cells[at, :words.wide] = words.digits[ids]
            cells[at, words.length[ids]] = np.where(end, ord(mark), ord(","))
            length[at] = words.length[ids] + 1
        raw = cells[np.arange(wide) < length[:, None]].tobytes()
        stop = np.cumsum(length)[at_b[np.flatnonzero(ends_b)][np.cumsum(np.add.reduceat(ends_a, rows_a)) - 1]]
        return [hashlib.sha256(raw[s:e - 1]).hexdigest() for s, e in zip([0, *stop[:-1].tolist()], stop.tolist())]

    def align(self, values: pa.Array) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, how often each is linked) of each text."""
        out = [(0, 0, 0, 0, "", b"", b"")] * len(values)
        some = np.flatnonzero(np.array([bool(t) for t in values.to_pylist()], bool))
        if not len(some):
            return out
        a, b, same = self.encode(values.take(pa.array(some)))
        some, a, b = some[same], [x for x, ok in zip(a, same) if ok], [x for x, ok in zip(b, same) if ok]
        if not len(some):
            return out
        size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a, b = np.concatenate(a).astype(np.int64), np.concatenate(b)
        off_a, off_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        # ends within the block: offsets of all rows, one after another
        end_a, end_b = np.cumsum(self.words_a.size[a]), np.cumsum(self.words_b.size[b])
        ends_a, ends_b, groups, links, found = np.zeros(len(a), bool), np.zeros(len(b), bool), np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), []
        for rows, swap in ((np.flatnonzero(size_a <= size_b), False), (np.flatnonzero(size_a > size_b), True)):
            if not len(rows):
                continue
            (s_off, s_size, s_end), (l_off, l_size, l_end) = ((off_b, size_b, end_b), (off_a, size_a, end_a)) if swap else ((off_a, size_a, end_a), (off_b, size_b, end_b))
            short, long = ragged(s_off[rows], s_size[rows]), ragged(l_off[rows], l_size[rows])
            first, last, both = overlaps(s_end[short], s_size[rows], l_end[long], l_size[rows])
            n = last - first + 1
            row = np.repeat(rows, s_size[rows])
            groups += np.bincount(row[both], minlength=len(some))
            links += np.bincount(row, n, len(some)).astype(np.int64)
            x, y = np.repeat(short, n), long[ragged(first, n)]
            x, y = (y, x) if swap else (x, y)
            found.append(np.repeat(row, n) * (len(self.words_a.size) * len(self.words_b.size)) + a[x] * len(self.words_b.size) + b[y])
            for mine, at in ((ends_b, short[both]), (ends_a, long[last[both]])) if swap else ((ends_a, short[both]), (ends_b, long[last[both]])):
                mine[at] = True
        sha = self.digests(a, b, ends_a, ends_b, off_a)
        pairs, times = np.unique(np.concatenate(found), return_counts=True)
        row, pairs = np.divmod(pairs, len(self.words_a.size) * len(self.words_b.size))
        cut = np.searchsorted(row, np.arange(len(some) + 1))
        pairs, times = pairs.astype(self.pairs), times.astype("<u4")
        for k, i in enumerate(some):
            own = slice(cut[k], cut[k + 1])
            out[i] = (int(size_a[k]), int(size_b[k]), int(groups[k]), int(links[k]), sha[k], pairs[own].tobytes(), times[own].tobytes())
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The aligner of two tokenizer files, kept by the worker."""
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def aligned(docs: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row; ``pairs`` has the distinct linked id
    pairs (A id times the size of B's vocabulary plus B id) and ``times`` how often each is linked, as packed numbers."""

    def run(batches):
        both = aligner(a, b)
        for batch in batches:
            for part in slices(batch, 1, PART):
                got = list(zip(*both.align(part.column(1))))
                types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v, t) for v, t in zip(got, types)]], ["doc_id", *COLUMNS])

    return texts(docs, text=text).mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")


def pair_counts(rows: DataFrame, kind: str) -> DataFrame:
    """(pair, n): how many rows hold each pair."""

    def run(batches):
        def counted(held):
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

        held, size = [], 0
        for batch in batches:
            for v in batch.column(0):
                held.append(np.frombuffer(v.as_buffer(), kind))
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)
        tidy()

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_counts(rows: DataFrame, kind: str, size_b: int) -> DataFrame:
    """``rows`` of ``aligned``, stored, with n_best (links whose count is the highest of their A id) and count_sum."""
    spark = rows.sparkSession
    counts = stored(pair_counts(rows, kind), "pairs").withColumn("a", F.floor(F.col("pair") / size_b))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    marked = stored(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    number = max(1, -(-marked.count() // SLICE))
    names = ["row", "doc_id", *COLUMNS[:5]]
    types = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    parts = None
    for k in range(number):
        slice_ = marked.where(F.pmod(F.xxhash64("pair"), F.lit(number)) == k).orderBy("pair").toArrow()
        shared = spark.sparkContext.broadcast(tuple(slice_.column(c).to_numpy() for c in ("pair", "n", "best")))

        def sums(batches, shared=shared):
            pair, n, best = shared.value
            for batch in batches:
                cut = np.concatenate(([0], np.cumsum([len(v.as_buffer()) for v in batch.column("times")]) // 4))
                held, times = np.frombuffer(buffer(batch.column("pairs"))[0].tobytes(), kind), np.frombuffer(buffer(batch.column("times"))[0].tobytes(), "<u4").astype(np.int64)
                if len(pair):
                    at = np.minimum(np.searchsorted(pair, held), len(pair) - 1)
                    times = times * (pair[at] == held)
                    top, total = np.concatenate(([0], np.cumsum(times * best[at]))), np.concatenate(([0], np.cumsum(times * n[at])))
                else:
                    top = total = np.zeros(len(held) + 1, np.int64)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *[pa.array(x[cut[1:]] - x[cut[:-1]]) for x in (top, total)]], [*names, "n_best", "count_sum"])

        part = rows.select(*names, "pairs", "times").mapInArrow(sums, types)
        parts = part if parts is None else parts.unionByName(part)
    discard(counts)
    return parts.groupBy(*names).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def token_alignment(docs: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    both = Aligner(a, b)
    rows = stored(aligned(docs, a, b, text).withColumn("row", F.monotonically_increasing_id()), "aligned")
    got = with_counts(rows, both.pairs, len(both.words_b.size))
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents").select("doc_id", "text"), default_tokenizer(), default_model())
