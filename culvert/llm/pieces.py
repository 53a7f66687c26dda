"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text is cut into marked words (a run of word marks with what follows; a character that no piece has beside another
one stands alone). The distinct words of a block of rows are sorted, which lays them out as a trie, and are visited depth
first: the forward state of a prefix (its last piece and where that begins) is computed once and reused by every word
that shares the prefix. For a merge-ranked (BPE) vocabulary, the only kind given here, the forward step keeps the one
last piece that is consistent with the merges: piece t may follow piece u when encoding u + t gives exactly [u, t].
That choice is unique, so the back pointers give the same ids as merging the whole text.

Characters without a piece become their UTF-8 byte pieces. Decoding joins the pieces and byte pieces and drops the mark
put before the text, so it gives the text back, with any literal U+2581 as a space.

Defined cases: null is empty; the empty text has no pieces and decodes to itself; equal texts have equal ids; texts are
encoded whole; other columns are neither read nor changed. State is bounded by the distinct words of one slice of rows
and a cache of at most ``CACHE`` words; a prefix keeps its last piece and a pointer back, so a word of any length takes memory in proportion to it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import slices, table, texts

MARK = "▁"
#: Words kept between slices.
CACHE = 200_000
#: Characters of a word that is not kept.
LONG = 256


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Coder:
    """Encoder and decoder of one SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk = sp.unk_id()
        self.byte = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        usable = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {pieces[i]: i for i in usable}
        self.score = {pieces[i]: sp.get_score(i) for i in usable}
        self.longest = max(map(len, self.id))
        self.bytes_of = [bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else pieces[i].replace(MARK, " ").encode() for i in range(n)]
        joined = {c for p in self.id if len(p) > 1 for c in p}
        self.alone = "\n" not in joined
        # no piece has a mark after another character, so a run of marks starts a word
        marked = not any(p[i] != MARK and p[i + 1] == MARK for p in self.id for i in range(len(p) - 1))
        if not marked:
            self.split = re.compile(r"(?s).+")
        else:
            self.split = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.alone else rf"{MARK}*[^{MARK}]+|{MARK}+")
        self.prefixes = {p[:k] for p in self.id for k in range(1, len(p) + 1)}
        self.names: list[str] = []          # pieces (and unknown characters) by local number
        self.number: dict[str, int] = {}
        self.packed: list[bytes] = []       # their ids, little-endian unsigned 32-bit
        self.pairs: dict[int, bool] = {}
        self.steps: dict[tuple[str, str], tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.whole: dict[str, bool] = {}
        self.cache: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short string: best score first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _piece(self, t: str) -> int:
        got = self.number.get(t)
        if got is None:
            got = self.number[t] = len(self.names)
            self.names.append(t)
            ids = [self.id[t]] if t in self.id else [self.byte.get(b, self.unk) for b in t.encode()] if self.byte else [self.unk]
            self.packed.append(np.array(ids, "<u4").tobytes())
        return got

    def _follows(self, key: int) -> bool:
        u, t = self.names[key >> 32], self.names[key & 0xFFFFFFFF]
        if len(self.pairs) > 300_000:
            self.pairs.clear()
        got = self.pairs[key] = self.merge(u + t) == [u, t]
        return got

    def _step(self, state: str, char: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """From the longest end of a prefix that begins some piece: that end after one more character, and the pieces that
        end there (length, number), longest first; a single character always ends there."""
        run = state + char
        ends = [run[k:] for k in range(len(run))]
        found = tuple((len(t), self._piece(t)) for t in ends if len(t) == 1 or t in self.id and self.merge(t) == [t])
        got = self.steps[(state, char)] = (next((t for t in ends if t in self.prefixes), ""), found)
        return got

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids (little-endian unsigned 32-bit) of distinct words, in one depth-first pass over their sorted order."""
        out: dict[str, bytes] = {}
        previous = ""
        # forward state of each prefix on the path: last piece, where it begins, automaton state
        last, back, states = array("q", [-1]), array("q", [0]), [""]
        steps, pairs, packed = self.steps, self.pairs, self.packed
        for w in sorted(words):
            same, most = 0, min(len(w), len(previous))
            while same < most and w[same] == previous[same]:
                same += 1
            del last[same + 1:], back[same + 1:], states[same + 1:]
            state = states[same]
            for i in range(same, len(w)):
                c = w[i]
                state, ends = steps.get((state, c)) or self._step(state, c)
                for size, t in ends:
                    j = i + 1 - size
                    if j and size > 1:  # one piece is consistent, so the shortest needs no test
                        key = last[j] << 32 | t
                        ok = pairs.get(key)
                        if not (self._follows(key) if ok is None else ok):
                            continue
                    break
                last.append(t)
                back.append(j)
                states.append(state)
            ends, i = [], len(w)
            while i:
                ends.append(packed[last[i]])
                i = back[i]
            out[w] = b"".join(reversed(ends))
            previous = w
        return out

    def encode(self, values: list[str]) -> list[np.ndarray]:
        """Ids of each text; the distinct words of all given texts are encoded together."""
        cut = [self.split.findall(MARK + t.replace(" ", MARK)) if t else [] for t in values]
        cache = self.cache
        new = {w for words in cut for w in words if w not in cache}
        if len(cache) + len(new) > CACHE:
            keep = {w for words in cut for w in words}
            for w in [w for w in cache if w not in keep]:
                del cache[w]
        cache.update(self.encode_words(list(new)))
        out = [np.frombuffer(b"".join([cache[w] for w in words]), "<u4") for words in cut]
        for w in new:
            if len(w) > LONG:
                del cache[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        pieces = self.bytes_of
        return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The coder of a model file, kept by the worker."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encoded(docs: DataFrame, out: str, model: str, text: str = "text") -> DataFrame:
    """``docs`` with the ids of ``text`` as array<int> in ``out``."""

    @F.arrow_udf("array<int>")
    def ids(v: pa.Array) -> pa.Array:
        got = coder(model).encode([t or "" for t in v.to_pylist()])
        offs = np.concatenate(([0], np.cumsum([len(x) for x in got]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([*got, np.zeros(0, np.uint32)]).astype(np.int32)))

    return docs.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decoded(docs: DataFrame, ids: str, out: str, model: str) -> DataFrame:
    """``docs`` with the text of the ids in ``out``."""

    @F.arrow_udf("string")
    def back(v: pa.Array) -> pa.Array:
        return pa.array([coder(model).decode(np.array(x or [], np.uint32)) for x in v.to_pylist()], pa.string())

    return docs.withColumn(out, back(ids))


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) to the digest of the ids and of the text they decode to, without moving the ids themselves."""

    def run(batches):
        c = coder(model)
        for batch in batches:
            for part in slices(batch, 1, 8 << 20):
                values = part.column(1).to_pylist()
                ids = c.encode(values)
                back = [c.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back]), pa.array([b == t.replace(MARK, " ") for b, t in zip(back, values)]),
                ], ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "same_text"])

    return texts(docs).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, same_text boolean")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"), default_model())
