"""Conversation repair against a plain shortest path over the grammar's states."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from edge_rows import SF

from culvert.llm import turn_repair as T
from culvert.llm.common import table

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of one conversation's rows (conv, turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, kinds = set(), []
    for _, _, role, text in rows:
        solid = SOLID.findall(text)
        kinds.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "k")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserted):
        """(cost, audit, lines) of the rest."""
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            c, a, x = best(i + 1, state, 0)
            options.append((c + 4, "D" + a, x))
            if kinds[i] in "tk":
                more = 3 * (kinds[i] == "t")
                for to in follow[state]:
                    c, a, x = best(i + 1, to, 0)
                    if rows[i][2][:1] == to:
                        options.append((c + more, "K" + a, ((rows[i][2], rows[i][3]), *x)))
                    if to in "ua":
                        options.append((c + 3 + more, "R" + a, (({"u": "user", "a": "assistant"}[to], rows[i][3]), *x)))
        if inserted < 4:
            for to in follow[state]:
                if to in "ua":
                    c, a, x = best(i, to, inserted + 1)
                    options.append((c + 3, "I" + a, (({"u": "user", "a": "assistant"}[to], ""), *x)))
        return min(options) if options else (10 ** 9, "", ())

    for i in range(len(rows), -1, -1):
        best(i, "", 0)
    cost, audit, lines = best(0, "", 0)
    return gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def expected(rows, damage):
    left = damage(rows)
    return {conv: plain([r for r in left if r[0] == conv]) for conv in {r[0] for r in rows}}


def random_rows(seed, conversations, most):
    r = random.Random(seed)
    rows = []
    for conv in range(conversations):
        n = r.randint(1, most)
        for t in range(n):
            role = r.choice(["user", "assistant"]) if r.random() < 0.3 else ["user", "assistant"][t % 2]
            role = r.choice(["system", "tool", "", "Usr", None]) if r.random() < 0.1 else role
            text = r.choice(["Hello.", "Fine!", "what", "", " \n", "Why? ", "one\x00.", None, f"Turn {t}.", f"Cut {t}"])
            rows.append((conv if conv else None, None if r.random() < 0.03 else t + 2 * (r.random() < 0.1), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "y", "z", 1) for x in rows], "conv_id long, turn long, role string, text string, conv string, kind string, k long")


@pytest.mark.parametrize("chunk, block, most", [(16, 256, 9), (3, 4, 40), (1, 1, 12), (16, 7, 120)])
def test_repairs_equal_a_shortest_path(spark, monkeypatch, chunk, block, most):
    monkeypatch.setattr(T, "CHUNK", chunk)
    monkeypatch.setattr(T, "BLOCK", block)
    T._aligned.clear()
    rows = random_rows(chunk, 60 if most < 50 else 8, most)
    df = frame(spark, rows)
    for damage, plain_damage in ((T.damaged, after_damage), (T.as_rows, lambda x: [(c, t, " " if r is None else r, " " if s is None else s) for c, t, r, s in x])):
        got = {r["conv_id"]: tuple(r[c] for c in T.RESULT) for r in T.every_conversation(df, damage(df)).collect()}
        assert got == expected(rows, plain_damage)


def test_edge_tables(spark):
    assert T.every_conversation(frame(spark, []), T.damaged(frame(spark, []))).count() == 0
    alone = frame(spark, [(3, None, None, None), (4, 1, "assistant", "x" * 3_000_000 + ".")])
    got = {r["conv_id"]: r for r in T.every_conversation(alone, T.as_rows(alone)).collect()}
    assert got[3]["blank"] == 1 and got[3]["cost"] == 4 and got[3]["audit"] == "D" and got[3]["gaps"] == 0
    assert got[4]["audit"] == "IK" and got[4]["cost"] == 3
    assert got[4]["repaired_sha256"] == hashlib.sha256(("user:\nassistant:" + "x" * 3_000_000 + ".").encode()).hexdigest()
    # every row of conversation 1 dropped
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    none = frame(spark, [(1, turn, "user", "Hi.")])
    r = T.every_conversation(none, T.damaged(none)).collect()
    assert [tuple(x) for x in r] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repeated_rows_of_one_turn(spark):
    rows = [(1, 0, "user", "Hi.")] * 500 + [(1, 1, "user", "Hi.")] * 3 + [(1, 1, "assistant", "Yes.")]
    df = frame(spark, rows)
    r = T.every_conversation(df, T.as_rows(df)).collect()[0]
    assert (r["duplicate"], r["illegal"], r["cost"], r["audit"]) == (502, 501, 4 * 502, "K" + "D" * 499 + "KDDD")


def test_the_whole_table(spark):
    df = table(spark, SF, "conversations").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()]
    got = {r["conv_id"]: tuple(r[c] for c in T.RESULT) for r in T.op12_turn_repair(spark, SF).collect()}
    assert got == expected(rows, after_damage)


def test_bands_lose_nothing():
    r = random.Random(3)
    for _ in range(300):
        turns = "".join(r.choice("suaoSUAO") for _ in range(r.randint(1, 7)))
        target = r.choice(T.targets(r.randrange(4), r.randint(0, 9)))
        free = T.wagner_fischer(turns, target, None)
        if free:
            for slack in (0, 1, 5):
                assert T.wagner_fischer(turns, target, free[0] + slack) == free
            assert T.wagner_fischer(turns, target, free[0] - 1) is None
