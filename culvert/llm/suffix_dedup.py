"""Removal of repeated 200-byte strings, decided by suffix arrays of linear grouping construction.

Anchors. Of the ``LENGTH - GRAM + 1`` byte grams inside a 200-byte window, the one of least hash (leftmost on ties) is the
window's anchor; it depends on the window's bytes alone, so equal windows have equal anchors at equal places. The
consecutive windows of one anchor form a fragment. Windows of fragments with different anchors cannot be equal.

Decision. All fragments meet by anchor in one shuffle. A fragment that occurs twice as a whole is repeated as a whole
(copies inside one task are settled there, so a passage that very many documents share sends one row a task). What is
left are anchors with two or more different fragments: their bytes are fetched and aligned at the gram they share, columns
that tell the fragments apart in the same way become one symbol, and the suffixes of a block of such groups are sorted. A window is repeated if and only if a neighbour of
its suffix agrees on the whole window. A group of more than ``GROUP`` different fragments is not gathered: its windows
are counted by their hashes, spread over all tasks.

Suffix sorting (``suffix_array``) groups suffixes by their Lyndon prefixes: groups are processed in descending order,
each member is followed by its previous-smaller pointer, and the suffixes pointed at move to the end of their own groups
by how many members point at them. A second pass walks the pointers in ascending order and writes each group's order.
There is no recursive renaming and both passes are linear in the text.

Defined cases: null text is empty; texts under 200 bytes keep everything; strings are judged on the input as given, matches
never cross rows, and a string also counts as repeated when it overlaps its other occurrence; rows that repeat a doc_id are
documents of their own (told apart by 64 bits of their text); a null doc_id is kept; an empty table gives no rows; other columns are neither read nor changed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culvert.llm.common import ship, slices, stored, table
from culvert.llm.textnum import buffer, mix, prefix, span

LENGTH = 200
GRAM = 100
SPREAD = LENGTH - GRAM + 1
#: Larger groups of different fragments are counted window by window.
GROUP = 2000
#: Columns of fragments that are aligned and sorted at once.
BLOCK = 1 << 18
#: Text bytes whose fragments are compared inside a task before the shuffle.
LOCAL = 48 << 20
_POSITION = np.uint64((1 << 31) - 1)


def suffix_array(s: list[int]) -> list[int]:
    """Order of the suffixes of ``s``, whose last symbol is smaller than all others."""
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    where, group, size, before = [0] * n, [0] * n, [0] * n, [-1] * n
    start = 0
    for k, i in enumerate(order):
        where[i] = k
        if s[i] != s[order[start]]:
            start = k
        group[i] = start
        size[start] += 1
    # groups in descending order
    end = n
    while end > 0:
        start = group[order[end - 1]]
        members = order[start:end]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            if len(pointed) == 1 or max(pointed.values()) == 1:
                levels = [list(pointed)]
            else:
                by: dict[int, list[int]] = {}
                for p, c in pointed.items():
                    by.setdefault(c, []).append(p)
                levels = [by[c] for c in sorted(by, reverse=True)]
            for level in levels:
                for p in level:  # to the end of its group
                    g = group[p]
                    size[g] -= 1
                    last = g + size[g]
                    k, other = where[p], order[last]
                    order[k], order[last] = other, p
                    where[other], where[p] = k, last
                tails = [group[p] + size[group[p]] for p in level]
                for p, g in zip(level, tails):  # which becomes a group of its own
                    group[p] = g
                    size[g] += 1
        end = start
    # each group's order, from the smallest suffix up
    out, free, placed = [0] * n, group, bytearray(n)
    slot = list(range(n))
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            g = free[p]
            k = slot[g]
            out[k] = p
            slot[g] = k + 1
            placed[p] = 1
            p = before[p]
    return out


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.cumsum(size) - size
    return np.repeat(start - at, size) + np.arange(int(size.sum()))


def fragments(data: np.ndarray, offs: np.ndarray):
    """(row, first window, windows - 1, anchor - first window, anchor hash, fragment hash) of all rows; places are in the row."""
    size = np.diff(offs)
    rows = np.flatnonzero(size >= LENGTH)
    if not len(rows):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    pre = prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = mix(span(pre, at, at + GRAM))
    best = (gram & ~_POSITION) | at.astype(np.uint64)
    width = 1
    while width * 2 <= SPREAD:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < SPREAD:
        best = np.minimum(best[:len(best) - (SPREAD - width)], best[SPREAD - width:])
    starts = _ragged(offs[rows], size[rows] - LENGTH + 1)
    anchor = (best[starts] & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((first[1:], [len(starts)])) - 1
    lo, hi, p = starts[first], starts[last], anchor[first]
    row = np.searchsorted(offs, lo, "right") - 1
    whole = mix(span(pre, lo, hi + LENGTH) + ((hi - lo) * 128 + (p - lo)).astype(np.uint64))
    return row, lo - offs[row], hi - lo, p - lo, gram[p], whole


def _pack(lo, more, back):
    return (lo << 14) | (more << 7) | back


def _unpack(place: np.ndarray):
    return (place >> 14) & ((1 << 31) - 1), (place >> 7) & 127, place & 127


_ROWS = "anchor long, whole long, doc long, tag long, place long, known int"


def _scan(batches):
    """Fragments of a task's rows. known 0: one of its kind here; 1: repeated here, sent for all; 2: repeated, settled here."""
    parts, held = [], 0

    def flush():
        doc, tag, place, anchor, whole = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((whole, anchor))
        a, w = anchor[order], whole[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])))
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        known = np.where(many, np.where(new, 1, 2), 0)
        # what is settled needs no company: spread it by its place
        a = np.where(known == 2, mix(doc[order].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tag[order].astype(np.uint64) + place[order].astype(np.uint64)), a)
        for k in range(0, len(order), 1 << 17):
            part = slice(k, k + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(a[part].view(np.int64)), pa.array(w[part].view(np.int64)), pa.array(doc[order][part]), pa.array(tag[order][part]), pa.array(place[order][part]), pa.array(known[part].astype(np.int32))], ["anchor", "whole", "doc", "tag", "place", "known"])

    for batch in batches:
        for part in slices(batch, 2):
            data, offs = buffer(part.column(2))
            row, lo, more, back, anchor, whole = fragments(data, offs)
            doc, tag = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if len(row):
                parts.append((doc[row], tag[row], _pack(lo, more, back), anchor, whole))
            held += len(data)
            if held >= LOCAL and parts:
                yield from flush()
                parts, held = [], 0
    if parts:
        yield from flush()


def _cut(batches):
    """Bytes of the wanted fragments of each row: those of small groups whole, those of large ones as window hashes."""
    for batch in batches:
        for part in slices(batch, 0):
            texts = part.column(0)
            data, offs = buffer(texts)
            pre = None
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            for i, (doc, tag, want) in enumerate(zip(*(part.column(k).to_pylist() for k in (1, 2, 3)))):
                for f in want:
                    lo, more, back = (int(x) for x in _unpack(np.int64(f["place"])))
                    a = offs[i] + lo
                    if not f["large"]:
                        rows = [(None, data[a:a + more + LENGTH].tobytes(), back)]
                    else:
                        pre = prefix(data) if pre is None else pre
                        w = np.arange(a, a + more + 1)
                        rows = [(int(h), None, k) for k, h in enumerate(mix(span(pre, w, w + LENGTH)).view(np.int64).tolist())]
                    for h, raw, k in rows:
                        for column, value in zip(out, (f["anchor"], doc, tag, f["place"], f["settled"], h, raw, k)):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], ["anchor", "doc", "tag", "place", "settled", "hash", "raw", "at"])


_CUT = "anchor long, doc long, tag long, place long, settled boolean, hash long, raw binary, at long"


def _columns(groups: list[tuple[int, bytes, int]]):
    """All fragments as one row of columns, aligned within a group at the gram they share, which is one column.

    (first column of each fragment, its columns, column's place in its group, column's value)."""
    core: dict = {}
    values, sizes, places = [], [], []
    number = -1
    for k, (group, raw, back) in enumerate(groups):
        number += k == 0 or group != groups[k - 1][0]
        s = np.frombuffer(raw, np.uint8)
        gram = core.setdefault((group, raw[back:back + GRAM]), 256 + len(core))
        values += [s[:back].astype(np.int64), [gram], s[back + GRAM:]]
        sizes.append(len(raw) - GRAM + 1)
        places.append(number * (2 * SPREAD) + SPREAD - back)
    size = np.array(sizes)
    start = np.cumsum(size) - size
    return start, size, _ragged(np.array(places), size), np.concatenate(values).astype(np.int64)


def repeated_windows(groups: list[tuple[int, bytes, int]]) -> list[np.ndarray]:
    """For fragments (group, bytes, anchor place), which of their windows occur in another fragment of their group.

    Fragments come group by group. Neighbouring columns that tell the fragments of a group apart in the same way are one
    symbol: a window agrees on a part of such a run of columns if and only if it agrees on all of it. So two long fragments
    that differ in one place have a handful of symbols."""
    start, size, place, value = _columns(groups)
    n, total = len(groups), int(size.sum())
    owner = np.repeat(np.arange(n), size)
    # of the fragments that have the same value in a column, the first
    kind = place * (int(value.max()) + 1) + value
    order = np.argsort(kind, kind="stable")
    new = np.concatenate(([True], kind[order[1:]] != kind[order[:-1]]))
    label = np.empty(total, np.int64)
    label[order] = owner[order[np.maximum.accumulate(np.where(new, np.arange(total), 0))]]
    # a run of columns ends where the labels of any fragment change, or where a fragment begins or ends
    split = np.zeros(int(place.max()) + 2, bool)
    split[place[start]] = True
    split[place[start + size - 1] + 1] = True
    inner = np.flatnonzero((label[1:] != label[:-1]) & (owner[1:] == owner[:-1])) + 1
    split[place[inner]] = True
    head = split[place]
    run = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    symbol = np.unique(place[heads] * n + label[heads], return_inverse=True)[1] + 1
    runs = np.bincount(owner[heads], minlength=n)
    # the symbols of all fragments, a 0 after each and a least one at the end
    spot = np.arange(len(heads)) + np.repeat(np.arange(n), runs)
    text = np.zeros(len(heads) + n + 1, np.int64)
    text[spot] = symbol
    text[-1] = -1
    sorted_ = np.array(suffix_array(text.tolist()))
    # what neighbours agree on, in symbols
    agree = np.zeros(len(text), np.int64)
    padded = np.concatenate((text, np.full(2 * SPREAD + 1, -2)))
    a, b = sorted_[:-1], sorted_[1:]
    alive = np.flatnonzero(text[a] > 0)
    for t in range(2 * SPREAD):
        alive = alive[(padded[a[alive] + t] == padded[b[alive] + t]) & (padded[a[alive] + t] > 0)]
        if not len(alive):
            break
        agree[a[alive]] = np.maximum(agree[a[alive]], t + 1)
        agree[b[alive]] = np.maximum(agree[b[alive]], t + 1)
    count = size - SPREAD + 1
    at = _ragged(start, count)
    hit = agree[spot[run[at]]] >= run[at + SPREAD - 1] - run[at] + 1
    return np.split(hit, np.cumsum(count)[:-1])


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


_SPANS = "doc long, tag long, start long, stop long"


def _sorted_groups(batches):
    """Rows sorted by anchor to spans of repeated windows, a block of whole groups at a time."""
    held: list[tuple] = []

    def flush(rows):
        out = []
        for (_, doc, tag, place, settled, _, _), hit in zip(rows, repeated_windows([(r[0], r[5], r[6]) for r in rows])):
            if not settled:
                lo = (place >> 14) & ((1 << 31) - 1)
                out += [(doc, tag, lo + a, lo + b - 1 + LENGTH) for a, b in _runs(hit)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["doc", "tag", "start", "stop"])

    size = 0
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= BLOCK and held[-1][0] != r[0]:
                yield from flush(held)
                held, size = [], 0
            held.append(r)
            size += len(r[5]) - GRAM + 2
    if held:
        yield from flush(held)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _tag(text: Column) -> Column:
    return F.xxhash64(text)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """doc (null as the least long), a 64-bit hash of the text (tag) that tells rows of one doc_id apart, and the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), _tag(t).alias("tag"), t.alias("text"))


def repeated_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(affected rows: doc, tag, text; stored), (doc, tag, spans: sorted disjoint byte spans of repeated strings)."""
    ship(docs.sparkSession)
    rows = _keyed(docs, text)
    found = rows.select("doc", "tag", "text").mapInArrow(_scan, _ROWS).repartition("anchor")
    by_anchor, by_whole = Window.partitionBy("anchor"), Window.partitionBy("anchor", "whole")
    found = found.withColumn("n", F.count("*").over(by_whole)).withColumn("low", F.min("whole").over(by_anchor)).withColumn("high", F.max("whole").over(by_anchor))
    found = found.withColumn("settled", (F.col("known") > 0) | (F.col("n") > 1)).withColumn("open", (F.col("known") < 2) & (F.col("low") != F.col("high")))
    hits = stored(found.where("settled or open").select("anchor", "whole", "doc", "tag", "place", "settled", "open"), "fragments")
    # one row for each different fragment of an open group
    one = hits.where("open").groupBy("anchor", "whole").agg(F.min(F.struct("doc", "tag", "place")).alias("f"), F.first("settled").alias("settled"))
    sizes = one.groupBy("anchor").agg((F.count("*") > GROUP).alias("large"))
    wanted = one.join(sizes, "anchor").groupBy(F.col("f.doc").alias("doc"), F.col("f.tag").alias("tag")).agg(F.collect_list(F.struct("anchor", F.col("f.place").alias("place"), "settled", "large")).alias("want"))
    touched = hits.select("doc", "tag").distinct()
    affected = stored(rows.join(touched.join(wanted, ["doc", "tag"], "left"), ["doc", "tag"]), "affected")
    cut = affected.where("want is not null").select(F.col("text").cast("binary").alias("text"), "doc", "tag", "want").mapInArrow(_cut, _CUT)
    cut = stored(cut, "cut")
    decided = cut.where("raw is not null").select("anchor", "doc", "tag", "place", "settled", "raw", "at").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sorted_groups, _SPANS)
    windows = cut.where("raw is null")
    place = F.col("place")
    lo, more = F.shiftright(place, 14).bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(place, 7).bitwiseAND(F.lit(127))
    shared = windows.groupBy("anchor", "hash").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "hash")
    counted = windows.where("not settled").join(shared, ["anchor", "hash"]).select("doc", "tag", (lo + F.col("at")).alias("start"), (lo + F.col("at") + LENGTH).alias("stop"))
    whole = hits.where("settled").select("doc", "tag", lo.alias("start"), (lo + more + LENGTH).alias("stop"))
    spans = whole.unionByName(decided).unionByName(counted).groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return affected.select("doc", "tag", "text"), spans


def _remove(batches):
    """(doc, tag, text bytes, spans) to what is removed and the digest of what is kept."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        for raw, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            gone = _union([(x["start"], x["stop"]) for x in spans])
            h, at = hashlib.sha256(), 0
            for a, b in gone:
                h.update(raw[at:a])
                at = b
            h.update(raw[at:])
            for column, value in zip(out, (sum(b - a for a, b in gone), len(gone), h.hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2])], ["doc", "tag", "n_removed", "n_spans", "kept"])


def kept_text(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without its spans; a character of which a span covers only a part stays."""
    out, at = [], 0
    for a, b in _union(spans):
        while a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append(raw[at:a])
            at = b
    out.append(raw[at:])
    return b"".join(out).decode()


def removed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    affected, spans = repeated_spans(docs)
    cut = affected.join(spans, ["doc", "tag"]).select("doc", "tag", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(_remove, "doc long, tag long, n_removed long, n_spans long, kept string").dropDuplicates(["doc", "tag"])
    base = _keyed(docs, "text").select("doc", "tag", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return base.join(cut, ["doc", "tag"], "left").select(F.when(F.col("doc") != F.lit(-(1 << 63)), F.col("doc")).alias("doc_id"), "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings removed from ``text`` (a null text stays null); other columns as they are."""
    _, spans = repeated_spans(docs, text)

    @F.arrow_udf("string")
    def cut(raw: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([kept_text(r, [(x["start"], x["stop"]) for x in g]) for r, g in zip(raw.to_pylist(), gone.to_pylist())], pa.string())

    t = F.coalesce(F.col(text), F.lit(""))
    names = [c for c in docs.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), _tag(t).alias("tag"))
    got = rows.join(spans, ["doc", "tag"], "left").withColumn("new", F.col(f"row.`{text}`"))
    hit = got.where("spans is not null").withColumn("new", cut(F.col("new").cast("binary"), F.col("spans")))
    both = got.where("spans is null").unionByName(hit)
    return both.select(*[F.col("new").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in names])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
