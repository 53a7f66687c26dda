"""Language identification with error-correcting output codes.

Each learned language gets a codeword of bits. One binary byte-trigram classifier per bit (log ratio of the
smoothed trigram distributions of the languages on either side of the bit) predicts that bit; decoding sums, over
the bits, a logistic loss of the predicted margin against the codeword's bit, weighted by how well that bit
separates that language, and takes the codeword of least loss. A text whose two best codewords are about as near
is flagged ambiguous.

Defined cases: null text, empty text or text without letters is ``und`` with score 0 and not ambiguous; rows with
null ``lang`` never train; without any training row every text is ``und``; with one learned language that one is
predicted with score 1; repeated rows are predicted each; a null ``doc_id`` counts as not held out; other columns
are neither read nor changed. The text is used whole.

The model is bounded: ``BUCKETS`` weights per bit, and the number of bits depends on the languages alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import ship, table
from culvert.llm.textnum import buffer

#: Hashed trigram space of the classifiers.
BUCKETS = 1 << 16
#: Additive smoothing of trigram counts.
SMOOTH = 0.1
#: A text is ambiguous when its best score is under this (two codewords are then about as near).
AMBIGUOUS_BELOW = 0.5
#: Slice of text that is turned to trigrams at once (bytes).
SLICE = 1 << 21

_KEEP = np.arange(256, dtype=np.uint8)
_KEEP[:97] = 32
_KEEP[123:128] = 32


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray       # languages x bits, +1 or -1
    weight: np.ndarray     # bits x (BUCKETS + 1); the last slot is 0
    loss_weight: np.ndarray  # languages x bits, rows sum to 1


def codewords(k: int) -> np.ndarray:
    """Exhaustive code for up to five classes, else about 10 log2 k distinct random balanced columns."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 5:
        return np.array([[1 if (c >> i) & 1 else -1 for c in range(1, 1 << (k - 1))] for i in range(k)], float)
    rng, columns = np.random.RandomState(7), {}
    while len(columns) < math.ceil(10 * math.log2(k)):
        c = np.where(rng.permutation(k) < k // 2, 1, -1)
        columns[tuple(c * c[0])] = 1
    return np.array(list(columns), float).T


def _trigrams(texts: list[str]):
    """Yield (first text, trigram buckets, offsets into them) of runs of texts; BUCKETS marks a trigram that does not count."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE):
            size += len(texts[j])
            j += 1
        data, offs = buffer(pa.array([f" {t.lower()} " for t in texts[i:j]], pa.large_string()))
        b = _KEEP[data].astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        slot = (code * np.uint32(2654435761)) >> np.uint32(16)
        slot[(b[1:-1] == 32) & ((b[:-2] == 32) | (b[2:] == 32))] = BUCKETS
        for cut in offs[1:-1]:  # trigrams never cross texts
            slot[cut - 2:cut] = BUCKETS
        yield i, slot, offs[:-1]
        i = j


def _count(batches):
    counts: dict[str, np.ndarray] = {}

    def rows():
        for lang, c in counts.items():
            at = np.flatnonzero(c[:BUCKETS])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], ["lang", "slot", "n"])

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs) if x == lang]
            if lang not in counts and len(counts) >= 64:
                yield from rows()
                counts.clear()
            c = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            for _, slot, _ in _trigrams(own):
                c += np.bincount(slot, minlength=BUCKETS + 1)
    yield from rows()


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count trigrams per language over all given rows and derive the bit classifiers."""
    ship(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    got = rows.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names, slots, n = got.column(0).to_pylist(), got.column(1).to_numpy(), got.column(2).to_numpy()
    langs = sorted(set(names))
    at = {x: i for i, x in enumerate(langs)}
    p = np.zeros((len(langs), BUCKETS))
    p[np.array([at[x] for x in names], int), slots] = n
    p = (p + SMOOTH) / (p.sum(1, keepdims=True) + SMOOTH * BUCKETS) if langs else p
    code = codewords(len(langs))
    weight = np.zeros((code.shape[1], BUCKETS + 1), np.float32)
    for b in range(code.shape[1]):
        weight[b, :BUCKETS] = np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0))
    # how far a text of language l is expected to lie on its own side of bit b
    reach = np.maximum(code * (p @ weight[:, :BUCKETS].T), 1e-6)
    return Model(langs, code, weight, reach / reach.sum(1, keepdims=True) if reach.size else reach)


def _predictor(spark: SparkSession, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double, ambiguous: boolean>")
    def predict(text: pa.Array) -> pa.Array:
        m = shared.value
        texts = [t or "" for t in text.to_pylist()]
        k, bits = m.code.shape
        best, score, vague = np.zeros(len(texts), int), np.ones(len(texts)), np.zeros(len(texts), bool)
        if k > 1:
            margin, used = np.zeros((len(texts), bits)), np.zeros(len(texts))
            for i, slot, offs in _trigrams(texts):
                if len(slot):
                    ok = np.minimum(offs, len(slot) - 1)
                    used[i:i + len(offs)] = np.add.reduceat((slot < BUCKETS).astype(np.int64), ok)
                    for b in range(bits):
                        margin[i:i + len(offs), b] = np.add.reduceat(m.weight[b][slot], ok, dtype=np.float64)
            margin /= np.sqrt(np.maximum(used, 1))[:, None]
            loss = np.einsum("lb,nlb->nl", m.loss_weight, np.logaddexp(0, -m.code[None] * margin[:, None]))
            e = np.exp(-bits * (loss - loss.min(1, keepdims=True)))
            e /= e.sum(1, keepdims=True)
            best, score = e.argmax(1), e.max(1)
            vague = score < AMBIGUOUS_BELOW
        names = [m.langs[i] if k else "und" for i in best]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1) if k else np.zeros(len(texts))), pa.array(vague)], ["lang", "score", "ambiguous"])

    return predict


def predict(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``out``: lang, score, ambiguous."""
    ship(docs.sparkSession)
    found = _predictor(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit("")))
    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    got = docs.withColumn(out, found)
    return got.withColumn(out, F.when(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)), F.col(out)).otherwise(none))


def language_id(docs: DataFrame) -> tuple[DataFrame, Model]:
    """Fit on the rows that are not held out; return all rows with the struct column ``_lang_id``."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model, "_lang_id"), model


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    got, _ = language_id(docs)
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("_lang_id.lang").alias("lang_pred"),
                      F.col("_lang_id.score").alias("score"), F.col("_lang_id.ambiguous").alias("ambiguous"))
