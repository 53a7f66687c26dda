"""Repair of a conversation's structure by Wagner-Fischer alignment with the alternating grammar ``(s?(ua)+)?``.

Every length has one target string (``uaua``, or ``suaua`` for odd lengths). A conversation's turns are aligned with the target of each
feasible length: keep a turn (0), give it the role that the target has there (3), delete it (4), insert an empty one (3); a kept or
re-roled truncated turn costs 3 more, blank and repeated turns must go. Lengths are tried from the likeliest on. The best cost
so far, the incumbent, rules out lengths whose least cost is above it, and gives the Ukkonen band of the others: a path
that leaves the diagonals between start and end by t pays for t insertions and t deletions. The edits are traced back with the
least letter (D < I < K < R) among cheapest ones, and the audits of equally cheap lengths are compared.

Long conversations are cut into chunks of ``CHUNK`` turns. A chunk is aligned from each state of the grammar (nothing yet, after s,
after u, after a) with the targets of each length that go on from there; the costs between states compose by addition and minimum, so
what a chunk's end costs from there on is known before its edits are chosen. Insertions belong to the turn after
them, so no chunk's audit is a prefix of another's, and comparing chunk by chunk compares the whole audits.

On Spark: faults are found by DataFrame functions (a repeated turn by the least turn of its conversation, role and text); equal rows are
one row with a count. Rows are sorted by ranges, so a conversation of any size is spread over tasks, which put up to
``BLOCK`` rows of one conversation into a block. A conversation of one block inside a partition is repaired there. The blocks of the others
carry their 4 x 4 costs; one pass from the last block to the first tells each what follows it, and one pass from first to last repairs
and hashes. Both passes stream: a task holds a block and the audit. The last one is a task for each conversation since SHA-256
over its whole text can only be computed in order.

Defined cases: a null conv_id is a conversation of its own; a null turn comes first; null role and text are one space; turns
of one number are ordered by role, then by the MD5 of the text; roles count by their first character; a conversation
without rows has an empty audit; an empty table gives no rows; other columns are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import stored, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Turns aligned at once; rows and text characters of a block; chunk alignments kept by a worker.
CHUNK, BLOCK, BLOCK_CHARS, CACHE = 16, 256, 1 << 20, 50_000
NEVER = 1 << 60
#: States of the grammar: nothing yet, after s, after u, after a. What ends a conversation in each: cost and insertions.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
NEXT = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
NAME = {"u": "user", "a": "assistant"}


def targets(state: int, length: int) -> list[str]:
    """The target strings of a length that may follow a state."""
    on = lambda first, n: ("ua" if first == "u" else "au") * (n // 2) + (first if n % 2 else "")
    if state == START:
        return [on("u", length)] + (["s" + on("u", length - 1)] if length else [])
    return [on("a" if state == AFTER_U else "u", length)]


def wagner_fischer(turns: str, target: str, incumbent: int | None) -> tuple[int, tuple[str, ...]] | None:
    """(cost, edits of each turn with the insertions before it) of the cheapest, then least edits that turn ``turns`` into
    ``target``; None if all cost more than ``incumbent``. A turn is its initial (o: any other), in capitals if truncated."""
    n, m = len(turns), len(target)
    least = INSERT * max(0, m - n) + DELETE * max(0, n - m)
    if incumbent is not None and least > incumbent or n == 0 and m > 0:
        return None
    aside = n + m if incumbent is None else (incumbent - least) // (INSERT + DELETE)
    low, high = min(0, m - n) - aside, max(0, m - n) + aside
    after, rows = {m: 0}, [{m: 0}]  # the costs to the end from each place of the target, last turn first
    for i in range(n - 1, -1, -1):
        turn, row = turns[i], {}
        extra = TRUNCATED if turn.isupper() else 0
        initial = turn.lower()
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = after.get(j, NEVER) + DELETE
            if j < m:
                c = target[j]
                step = KEEP if c == initial else REROLE if c != "s" else NEVER
                best = min(best, after.get(j + 1, NEVER) + step + extra)
                if c != "s":
                    best = min(best, row.get(j + 1, NEVER) + INSERT)
            row[j] = best
        rows.append(row)
        after = row
    cost = after.get(0, NEVER)
    if cost >= NEVER or incumbent is not None and cost > incumbent:
        return None
    edits, i, j, own = [], 0, 0, ""
    while i < n:
        row, below = rows[n - i], rows[n - i - 1]
        here, c = row[j], target[j] if j < m else None
        extra = TRUNCATED if turns[i].isupper() else 0
        if below.get(j, NEVER) + DELETE == here:
            letter = "D"
        elif c is not None and c != "s" and row.get(j + 1, NEVER) + INSERT == here:
            own, j = own + "I", j + 1
            continue
        else:
            letter, j = "K" if c == turns[i].lower() and below.get(j + 1, NEVER) + extra == here else "R", j + 1
        edits.append(own + letter)
        own, i = "", i + 1
    return cost, tuple(edits)


_aligned: dict[tuple[str, int], tuple] = {}


def chunk_edits(turns: str, state: int) -> tuple:
    """For each end state (cost, edits) of the best alignment of a chunk's turns from ``state``, over all feasible lengths."""
    got = _aligned.get((turns, state))
    if got is not None:
        return got
    best: list[tuple | None] = [None] * 4
    n = len(turns)
    # no length above this can be cheapest to any state: re-roling all turns, with two insertions, is cheaper
    most = n + 2 + (REROLE * n + TRUNCATED * n) // INSERT
    for length in sorted(range(most + 1), key=lambda m: (abs(m - n), m)):
        least = INSERT * max(0, length - n) + DELETE * max(0, n - length)
        for target in targets(state, length):
            end = NEXT[target[-1]] if target else state
            have = best[end]
            if have is not None and least > have[0]:
                continue
            found = wagner_fischer(turns, target, have[0] if have else None)
            if found and (have is None or (found[0], "".join(found[1])) < (have[0], "".join(have[1]))):
                best[end] = found
    if len(_aligned) >= CACHE:
        _aligned.clear()
    got = _aligned[turns, state] = tuple(best)
    return got


def costs(turns: str, after: list[int], state: int) -> int:
    """The least cost from ``state`` through a chunk and beyond, given what each end state costs."""
    return min((got[0] + after[end] for end, got in enumerate(chunk_edits(turns, state)) if got), default=NEVER)


def chunks(turns: str) -> list[str]:
    return [turns[k:k + CHUNK] for k in range(0, len(turns), CHUNK)]


def matrix(turns: str) -> list[int]:
    """The least cost between any two states through these turns, row by row."""
    out = []
    parts = chunks(turns)
    for end in range(4):
        after = [0 if s == end else NEVER for s in range(4)]
        for part in reversed(parts):
            after = [min(NEVER, costs(part, after, s)) for s in range(4)]
        out.append(after)
    return [out[end][s] for s in range(4) for end in range(4)]


def cheapest(turns: str, state: int, after: list[int]) -> tuple[int, list[str], int]:
    """(cost, edits of each turn, end state) of the cheapest, then least edits from ``state``; ``after``: what end states cost."""
    parts, follows = chunks(turns), [after]
    for part in reversed(parts):
        follows.append([min(NEVER, costs(part, follows[-1], s)) for s in range(4)])
    total, edits = 0, []
    for k, part in enumerate(parts):
        beyond = follows[len(parts) - 1 - k]
        cost, _, own, end = min((got[0] + beyond[e], "".join(got[1]), got[1], e) for e, got in enumerate(chunk_edits(part, state)) if got)
        total += cost - beyond[end]
        edits.extend(own)
        state = end
    return total, edits, state


class Repair:
    """A conversation's repair, fed block by block with rows (initial, class, copies, role, text, turn)."""

    def __init__(self):
        self.state, self.cost, self.audit, self.sha, self.some = START, 0, [], hashlib.sha256(), False
        self.n = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.last = 0, None
        self.low = self.high = None
        self.turns = 0

    def _say(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.some else "") + role + ":" + text).encode())
        self.some = True

    def _insert(self, letters: str) -> None:
        for _ in letters:
            c = "a" if self.state == AFTER_U else "u"
            self._say(NAME[c], "")
            self.state = NEXT[c]

    def feed(self, rows: list[tuple], after: list[int]) -> None:
        turns = turns_of(rows)
        cost, edits, _ = cheapest(turns, self.state, after)
        self.cost += cost
        edit = iter(edits)
        for initial, kind, copies, role, text, turn in rows:
            self.illegal += copies - 1 + (self.last is not None and self.last + initial not in ("su", "ua", "au"))
            self.last = initial
            if turn is not None:
                self.turns += turn != self.high  # rows come by turn
                self.low, self.high = turn if self.low is None else self.low, turn
            gone = copies
            if kind == "b":
                self.n["b"] += copies
            else:
                self.n["d"] += copies - 1 + (kind == "d")
                self.n["t"] += kind == "t"
                gone -= kind != "d"
            if gone < copies:
                own = next(edit)
                self.audit.append(own)
                self._insert(own[:-1])
                if own[-1] == "K":
                    self._say(role, text)
                    self.state = NEXT[initial]
                elif own[-1] == "R":
                    c = "a" if self.state == AFTER_U else "u"
                    self._say(NAME[c], text)
                    self.state = NEXT[c]
            self.cost += DELETE * gone
            self.audit.append("D" * gone)

    def close(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
        cost, letters = TAIL[self.state]
        self._insert(letters)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.n["b"], self.n["d"], self.n["t"], self.illegal, self.cost + cost, "".join(self.audit) + letters, self.sha.hexdigest()


def turns_of(rows: list[tuple]) -> str:
    """The turns that may stay, as ``wagner_fischer`` takes them."""
    letter = lambda initial: initial if initial in ("s", "u", "a") else "o"
    return "".join(letter(r[0]).upper() if r[1] == "t" else letter(r[0]) for r in rows if r[1] not in ("b", "d"))


# ------------------------------------------------------------------ Spark

RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_TYPES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_ARROW = [pa.int64()] * 6 + [pa.string()] * 2
ROW = "array<struct<initial:string,kind:string,copies:long,role:string,text:string,turn:long>>"
_ROW_ARROW = pa.list_(pa.struct([("initial", pa.string()), ("kind", pa.string()), ("copies", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("turn", pa.int64())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) of the rows that are left after the damage that the query prescribes."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    fate = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    rows = conversations.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) of a table of conversations, as it is."""
    space = F.lit(" ")
    return conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"), F.lit(1).cast("long").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv, turn, role, digest, text, copies, kind); kind: b blank, d duplicate, t truncated, else k."""
    rows = rows.withColumn("digest", F.md5("text"))
    own = rows.groupBy("conv", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("text").alias("text"))
    order = F.struct(F.col("turn").isNotNull(), "turn")
    # only texts that come back in another turn are joined, so mostly nothing is moved
    again = rows.groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first <> last")
    again = again.select(F.col("conv").alias("conv_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"), "first")
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_"))
    own = own.join(again, same, "left")
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    kind = (F.when(end == "", "b").when(F.col("first") < order, "d")
            .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "t").otherwise("k"))
    return own.select("conv", "turn", "role", "digest", "text", "copies", kind.alias("kind"))


def _finished(done: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*done), [pa.int64(), *_RESULT_ARROW])] if done else [pa.array([], t) for t in [pa.int64(), *_RESULT_ARROW]]


def _blocks(rows: DataFrame) -> DataFrame:
    """Sorted rows to finished conversations (rows is null) and blocks of the others (conv, part, k, rows, costs)."""
    keys = ["conv", "turn", "role", "digest"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        part = TaskContext.get().partitionId()
        out, conv, held, chars, k, runs = [], None, [], 0, 0, 0
        tail = [c for c, _ in TAIL]

        def block():
            out.append((conv, part, k, list(held), matrix(turns_of(held)), *[None] * len(RESULT)))

        def close(last):
            # the first and the last conversation of a partition may go on in another one
            if k or last or runs == 1:
                block()
            else:
                r = Repair()
                r.feed(held, tail)
                out.append((conv, part, k, None, None, *r.close()))

        def batch_of(rows):
            types = [pa.int64(), pa.int32(), pa.int64(), _ROW_ARROW, pa.list_(pa.int64()), *_RESULT_ARROW]
            cols = list(zip(*rows))
            cols[3] = [None if v is None else [dict(zip(("initial", "kind", "copies", "role", "text", "turn"), r)) for r in v] for v in cols[3]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["conv", "part", "k", "rows", "costs", *RESULT])

        for batch in batches:
            for c, turn, role, text, copies, kind in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if not runs or c != conv:
                    if runs:
                        close(False)
                    conv, held, chars, k, runs = c, [], 0, 0, runs + 1
                elif len(held) >= BLOCK or chars >= BLOCK_CHARS:
                    block()
                    held, chars, k = [], 0, k + 1
                held.append((role[:1], kind, copies, role, text, turn))
                chars += len(text)
            if out:
                yield batch_of(out)
                out.clear()
        if runs:
            close(True)
            yield batch_of(out)

    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("conv", "turn", "role", "text", "copies", "kind")
    return ordered.mapInArrow(run, f"conv long, part int, k long, rows {ROW}, costs array<long>, {RESULT_TYPES}")


def _follow(blocks: DataFrame) -> DataFrame:
    """(conv, part, k, after): what each state costs behind each block; from the last block of a conversation to its first."""

    def run(batches: Iterator[pa.RecordBatch]):
        conv, after, some = None, None, False
        for batch in batches:
            found = []
            for c, m in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if not some or c != conv:
                    conv, after, some = c, [t for t, _ in TAIL], True
                found.append(after)
                after = [min(NEVER, *(m[4 * s + e] + after[e] for e in range(4))) for s in range(4)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(found, pa.list_(pa.int64()))], ["conv", "part", "k", "after"])

    ordered = blocks.select("conv", "part", "k", "costs").repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("k"))
    return ordered.mapInArrow(run, "conv long, part int, k long, after array<long>")


def _repaired(blocks: DataFrame) -> DataFrame:
    """(conv, result columns) of conversations of blocks with ``after``, from the first block to the last."""

    def run(batches):
        conv, repair, done = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):  # a block at a time
                c, rows, after = (batch.column(n)[i].as_py() for n in ("conv", "rows", "after"))
                if repair is None or c != conv:
                    if repair is not None:
                        done.append((conv, *repair.close()))
                    conv, repair = c, Repair()
                repair.feed([tuple(r.values()) for r in rows], after)
            if done:
                yield pa.RecordBatch.from_arrays(_finished(done), ["conv", *RESULT])
                done = []
        if repair is not None:
            yield pa.RecordBatch.from_arrays(_finished([(conv, *repair.close())]), ["conv", *RESULT])

    ordered = blocks.select("conv", "part", "k", "rows", "after").repartition("conv").sortWithinPartitions("conv", "part", "k")
    return ordered.mapInArrow(run, f"conv long, {RESULT_TYPES}")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation in ``rows``
    (conv, turn, role, text, copies); no column is null but conv."""
    got = stored(_blocks(_faults(rows)), "blocks")
    finished = got.where("rows is null").select("conv", *RESULT)
    blocks = got.where("rows is not null")
    follow = stored(_follow(blocks), "follow").select(F.col("conv").alias("conv_"), F.col("part").alias("part_"), F.col("k").alias("k_"), "after")
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("part") == F.col("part_")) & (F.col("k") == F.col("k_"))
    return finished.unionByName(_repaired(blocks.join(follow, same)))


def every_conversation(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``repaired`` with conv_id, also for conversations that have no row left."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    got = repaired(rows)
    empty: dict[str, Column] = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return ids.join(got, ids["conv_id"].eqNullSafe(got["conv"]), "left").select("conv_id", *[F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in RESULT])


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return every_conversation(conversations, damaged(conversations))
