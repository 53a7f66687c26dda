"""I-Match document fingerprints over an inverse-document-frequency band.

Terms are the words of a text, A-Z lower-cased. The lexicon keeps the terms that occur in at least ``RARE`` and at most
``COMMON`` of all documents (so an idf between ln(1/COMMON) and ln(1/RARE)). A fingerprint hashes the sorted distinct
lexicon terms of a text once over the whole lexicon and once for each of several randomised sub-lexicons of falling
density; likeness is the share of sub-lexicons with equal hashes among those either text has terms of.

The lexicon is exact. Blocks of rows report the terms that at least ``RARE`` / 2 of their rows have; a term of at least
``RARE`` of all documents must add up to half of that in the reports, since what blocks do not report is less than the
other half. Those candidates are then counted over all rows. There are at most 2 (mean distinct terms of a document) /
RARE of them, whatever the number of documents, so they are broadcast.

Defined cases: null text is empty; a text without lexicon terms is hashed over all its terms (``whole``), so equal texts
have equal fingerprints always; two texts without any hash in common have likeness 0; documents are ordered by
(doc_id, text), null ids first; the one document of a table is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import ship, slices, table, texts
from culvert.llm.textnum import LOWER, buffer, mix, prefix, span, words

#: Band of document frequency, as shares of all documents.
RARE, COMMON = 1 / 2000, 1 / 5
#: Densities of the randomised sub-lexicons; the first is the whole lexicon.
DENSITY = (1.0, *(0.5,) * 3, *(0.25,) * 4, *(0.125,) * 4, *(0.0625,) * 4)
_SALT = np.random.RandomState(11).randint(1, 1 << 62, len(DENSITY), dtype=np.int64).astype(np.uint64)
_SIEVE = 22


def _terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term hash) of every word."""
    data, offs = buffer(col)
    lower = LOWER[data]
    start, end, row = words(lower, offs)
    return row, mix(span(prefix(lower), start, end) + (end - start).astype(np.uint64))


def _distinct(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    return row[new], term[new]


def _frequencies(batch: pa.RecordBatch, keep=None) -> tuple[np.ndarray, np.ndarray]:
    """Document frequency, within the batch, of its terms (of those that ``keep`` passes)."""
    parts = []
    for part in slices(batch, 0):
        row, term = _terms(part.column(0))
        if keep is not None:
            ok = keep(term)
            row, term = row[ok], term[ok]
        parts.append(_distinct(row, term)[1])
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Lexicon:
    """Sorted term hashes with a bit sieve before the search."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms)
        self.sieve = None

    def has(self, term: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(term), bool)
        if self.sieve is None:
            self.sieve = np.zeros(1 << _SIEVE, bool)
            self.sieve[self.terms >> np.uint64(64 - _SIEVE)] = True
        out = self.sieve[term >> np.uint64(64 - _SIEVE)]
        at = np.flatnonzero(out)
        pos = np.minimum(np.searchsorted(self.terms, term[at]), len(self.terms) - 1)
        out[at] = self.terms[pos] == term[at]
        return out


def lexicon(docs: DataFrame, text: str = "text") -> Lexicon:
    """Terms of the band, counted over all rows."""
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "term long, n long"

    def emit(term, n):
        return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    def local(batches):
        for b in batches:
            term, n = _frequencies(b)
            often = n >= RARE / 2 * b.num_rows
            yield emit(term[often], n[often])

    total = docs.count()
    found = rows.mapInArrow(local, schema).groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= RARE / 2 * total)
    candidates = found.select("term").toArrow().column("term").to_numpy().view(np.uint64)
    given = docs.sparkSession.sparkContext.broadcast(Lexicon(candidates))

    def exact(batches):
        for b in batches:
            yield emit(*_frequencies(b, given.value.has))

    counted = rows.mapInArrow(exact, schema).groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n").between(RARE * total, COMMON * total))
    return Lexicon(counted.select("term").toArrow().column("term").to_numpy().view(np.uint64))


def signatures(values: list[str], lex: Lexicon) -> np.ndarray:
    """Texts x (sub-lexicons + 1) hashes, 0 where a text has no term of the sub-lexicon; the last column is ``whole``."""
    out = np.zeros((len(values), len(DENSITY) + 1), np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.large_string())], ["t"])
    base = 0
    for part in slices(batch, 0):
        n = part.num_rows
        row, term = _distinct(*_terms(part.column(0)))
        ok = lex.has(term)
        bare = np.bincount(row[ok], minlength=n) == 0
        other = bare[row]
        at = lambda r: np.searchsorted(r, np.arange(n + 1))

        def sums(r, t, salt):
            c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(t ^ salt))))
            e = at(r)
            h = mix(c[e[1:]] - c[e[:-1]]) | np.uint64(1)
            return np.where(e[1:] > e[:-1], h, np.uint64(0))

        out[base:base + n, -1] = np.where(bare, sums(row[other], term[other], np.uint64(5)) | np.uint64(1), np.uint64(0))
        row, term = row[ok], term[ok]
        for k, (d, salt) in enumerate(zip(DENSITY, _SALT)):
            pick = slice(None) if d == 1 else mix(term + salt) < np.uint64(int(d * 2.0**64))
            out[base:base + n, k] = sums(row[pick], term[pick], salt)
        base += n
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among those that either side has."""
    either = ((a != 0) | (b != 0)).sum(1)
    return ((a == b) & (a != 0)).sum(1) / np.maximum(either, 1)


def fingerprint(sig: np.ndarray) -> list[str]:
    return ["".join("-" if not x else f"{int(x) >> 16:012x}" for x in r) for r in sig]


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, doc_id, copy, text) in ascending order, cut at id quantiles into buckets; each bucket ends with a copy
    of the row that follows it, so a bucket is self-contained and the texts are shuffled once."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    cuts = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.arrow_udf("int")
    def bucket(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, k.to_numpy(zero_copy_only=False), "left").astype(np.int32))

    rows = docs.select("doc_id", key.alias("k"), "text")
    firsts = rows.select(bucket("k").alias("b"), "k").groupBy("b").agg(F.min("k").alias("k")).collect()
    firsts = sorted((r["b"], r["k"]) for r in firsts)
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}  # the first row of all follows the last bucket
    ids, prev = np.array(sorted(before), np.int64), None
    prev = np.array([before[i] for i in ids], np.int32)

    @F.arrow_udf("array<int>")
    def places(k: pa.Array) -> pa.Array:
        v = k.to_numpy(zero_copy_only=False)
        own = np.searchsorted(cuts, v, "left").astype(np.int32)
        at = np.minimum(np.searchsorted(ids, v), len(ids) - 1)
        first = ids[at] == v
        size = 1 + first.astype(np.int32)
        offs = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        flat = np.empty(offs[-1], np.int32)
        flat[offs[:-1]] = own
        flat[offs[:-1][first] + 1] = prev[at[first]]
        return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))

    spread = rows.select("doc_id", "k", "text", F.posexplode(places("k")).alias("copy", "b"))
    return spread.repartition(n, "b").sortWithinPartitions("b", "copy", "k", "text").select("b", "doc_id", "copy", "text")


def _compare(lex_shared):
    def run(batches):
        lex = lex_shared.value
        held: list[tuple[int, int | None, int, str]] = []  # the last rows seen, whose next row is not yet known

        def flush(rows):
            """Rows whose next row is the one after them in the list; the last is only a next row."""
            own = [i for i in range(len(rows) - 1) if rows[i][2] == 0 and rows[i + 1][0] == rows[i][0]]
            if not own:
                return
            changed = [edited(rows[i][3], rows[i + 1][3]) for i in own]
            sig = signatures([r[3] for r in rows], lex)
            new = signatures(changed, lex)
            at = np.array(own)
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][1] for i in own], pa.int64()), pa.array([len(rows[i][3]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array(fingerprint(sig[at])), pa.array(fingerprint(new)),
                pa.array(likeness(sig[at], new)), pa.array(likeness(sig[at], sig[at + 1])),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            for part in slices(batch, 3, 8 << 20):
                rows = held + list(zip(*(part.column(i).to_pylist() for i in range(4))))
                yield from flush(rows)
                held = rows[-1:]

    return run


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    lex = spark.sparkContext.broadcast(lexicon(docs))
    return in_order(docs).mapInArrow(_compare(lex), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
