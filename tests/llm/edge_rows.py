"""Edge rows that every operator must take."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
#: Extra columns whose names clash with those the operators use inside.
CLASH = ["doc", "tag", "n", "node", "digest", "token", "row", "part", "spans", "set", "k", "b", "key", "anchor", "place", "part_", "_s", "t", "w", "new", "copy", "slot"]


def _rows():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgéñ") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, passage = prose(120), prose(60)
    near = base.split()
    near[50] = "changed"
    far = base.split()
    far[::4] = ["other"] * len(far[::4])
    long = prose(30000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, long), (6, long), (7, base), (8, base), (8, base), (9, " ".join(near)), (10, " ".join(far)),
        (None, "a null id " + prose(40)), (11, passage + " " + prose(50)), (12, prose(70) + "\n" + passage + "\n" + prose(10)), (13, "one two three"), (14, "One  TWO\nthree"),
        (15, "x" * 700), (16, "mail a.b+c@x-y.example.org or 10.0.0.1, card 4111 1111 1111 1111, call +1 (555) 123-4567 now"), (17, "€😀 " * 90), (18, prose(5)), (19, prose(90)),
        (20, "dup line here\ndup line here\n\n \nend"), (8, "another text under the same id " + prose(30)), (21, "\x00 nul " + prose(8)),
    ]


ROWS = _rows()


def frame(spark, rows=ROWS, source=lambda i: f"s{i % 3}" if i % 5 else None, lang=lambda i: ["en", "fr", None][i % 3]):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(d, t, lang(i), source(i), len(t or ""), *["x"] * len(CLASH)) for i, (d, t) in enumerate(rows)], schema)
