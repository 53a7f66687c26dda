"""Plain versions of the fixed rules, over lists of (doc_id, text)."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(t: str | bytes) -> str:
    return hashlib.sha256(t.encode() if isinstance(t, str) else t).hexdigest()


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([" ".join(w)]) if w else frozenset()
    return frozenset(" ".join(w[i:i + 5]) for i in range(len(w) - 4))


def links(rows):
    """(doc_id, shingles, component) of each row."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[top(i)] = top(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(s), least.get(top(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def covered(rows, length=200):
    """Per row the mask of bytes inside a string of ``length`` bytes that also starts elsewhere."""
    raw = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                mask[i:i + length] = b"\x01" * length
        out.append(bytes(mask))
    return raw, out


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def personal(t):
    """Base spans of a text."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, t or ""):
            s, digits = m.group(), re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, s.split("."))) > 255 or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(grams)
    repeated = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines, seen, dup = [x for x in t.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated)
