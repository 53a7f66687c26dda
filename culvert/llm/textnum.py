"""Vectorised text primitives on UTF-8 buffers: words, 64-bit word and substring hashes (numpy, no per-word Python).

Hashes are polynomials over Z/2^64 on a random byte table, finished with a bit mixer. Equal strings have
equal hashes everywhere; different strings collide with probability about 2^-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(BASE, -1, 1 << 64)
_TABLE = np.random.RandomState(20240601).randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) for i < n, kept between calls."""
    key = "inv" if inverse else "fwd"
    have = _powers.get(key)
    if have is None or len(have) < n:
        a = np.full(max(n, 1 << 16), _INV if inverse else BASE, np.uint64)
        a[0] = 1
        have = np.multiply.accumulate(a)
        if n <= 1 << 23:
            _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without nulls; offsets start at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if not len(col) or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def prefix(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """Prefix polynomial sums; ``span`` turns them into substring hashes."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(table[data] * powers(len(data)), out=out[1:])
    return out


def span(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unmixed hash of data[start:end] for arrays of bounds, independent of the position."""
    inv = powers(len(pre), True)
    return (pre[end] - pre[start]) * inv[start]


def words(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of non-space bytes, not crossing rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~space[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | first[1:])) + 1
    row = np.searchsorted(offs, start, "right") - 1
    return start, end, row


_MUL = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row with fewer words has its whole sequence as one."""
    lower = LOWER[data]
    start, end, row = words(lower, offs)
    h = mix(span(prefix(lower), start, end) + (end - start).astype(np.uint64))
    count = np.bincount(row, minlength=len(offs) - 1)
    at = np.concatenate(([0], np.cumsum(count)))
    if len(h) >= size:
        s = np.zeros(len(h) - size + 1, np.uint64)
        for j in range(size):
            s += mix(h[j:len(h) - size + 1 + j] * _MUL[j % 5] + np.uint64(j))
        s = mix(s)
    out = []
    for i, c in enumerate(count):
        a = at[i]
        if c >= size:
            out.append(np.unique(s[a:a + c - size + 1]))
        elif c:
            v = np.array([c + 77], np.uint64)
            for j in range(c):
                v = mix(v + h[a + j:a + j + 1] * _MUL[j % 5])
            out.append(v)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
