"""Exact Jaccard join on word shingles with a token-group matrix, and the components of its links.

1. Every text becomes the set of its distinct 5-word shingles (64-bit hashes). Equal sets are one class from there on.
2. Prefix rule: in one common order of all shingles, two sets of similarity 0.8 or more share one of the first
   n - ceil(0.8 n) + 1 shingles of each, and have their least overlap left from there on. The order puts the shingles that
   most documents have last, so common passages seldom reach a prefix. Classes that share no such shingle with a class of
   fitting size have no links, and their sets are not looked at again.
3. Groups: in each of some rounds, a class without a group is compared with one class of equal min-hash, the one with the fewest
   shingles of its own, and joins its group if they link. A group is connected by these links, and is cut into chunks of about ``CHUNK`` classes of like size.
4. The matrix has a row for each prefix shingle and chunk, however many members share it. A class probes it with its own
   prefix and gets candidate chunks of other groups. A chunk's union of shingles bounds the overlap: a link with a member of m
   shingles takes 80/180 of both sizes, so unless the class of n has 80/180 (n + least m) of its shingles in that union, no member
   can link with it, and the chunk is not opened.
5. Members of opened chunks are compared exactly. Links and groups give the components.

The order (step 2) only steers the work: any order gives the same links. It is taken from the most frequent shingles, at
most ``COMMON`` of them, so what is broadcast has a fixed bound. Nothing is capped: chunks and groups of any number are
handled by the same steps, and no step compares all pairs of a group.

Defined cases: a text with fewer than five words has its whole sequence as one shingle; null, empty and blank texts have no
shingles and link with nothing (their component is their own doc_id); repeated rows and equal texts are linked; a null
doc_id never names a component unless it has no other member; an empty table gives no rows; other columns are neither read
nor changed.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culvert.llm.common import delete, discard, ship, slices, stored, table, tidy
from culvert.llm.components import components
from culvert.llm.textnum import buffer, mix, shingle_sets
from culvert.session import checkpoint_dir

SHINGLE = 5
#: Similarity of a link, in hundredths.
PERCENT = 80
#: Shingles that are put last in the common order, at most; and how many different sets of a block make one a candidate.
COMMON, COMMON_FROM = 1 << 20, 2
#: Text bytes whose shingles are counted together for that.
BLOCK = 8 << 20
#: Rounds in which classes join groups.
ROUNDS = 6
CHUNK = 128
_SALT = np.random.RandomState(23).randint(1, 1 << 62, ROUNDS, dtype=np.int64).astype(np.uint64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, for sorted distinct arrays."""
    least, most = sorted((len(a), len(b)))
    if 100 * least < PERCENT * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _rows(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def common_shingles(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The most frequent shingles, rarest first; at most ``COMMON``."""

    def often(batches):
        for batch in batches:
            for block in slices(batch, 0, BLOCK):
                # equal texts count once: they become one class
                sets = {_digest(s): s for part in slices(block, 0) for s in shingle_sets(*buffer(part.column(0)))}
                token, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
                ok = n >= COMMON_FROM
                yield pa.RecordBatch.from_arrays([pa.array(token[ok].view(np.int64)), pa.array(n[ok].astype(np.int64))], ["token", "n"])

    rows = _rows(docs, text).select("text").mapInArrow(often, "token long, n long")
    top = rows.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    return top.column("token").to_numpy().view(np.uint64)[::-1].copy()


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _prefix(s: np.ndarray, tokens: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order (uncommon ones by hash, then common ones by rank)."""
    size = len(s) - (len(s) * PERCENT + 99) // 100 + 1
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
        last = tokens[at] == s
        if last.any():
            s = np.concatenate((s[~last], s[last][np.argsort(rank[at[last]])]))
    return s[:size]


def _classes(docs: DataFrame, text: str) -> DataFrame:
    """(digest, n, doc, prefix, node) of every different non-empty set, stored; doc is the least doc_id."""
    common = common_shingles(docs, text)
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], order))

    def sets(batches):
        tokens, rank = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                got = shingle_sets(*buffer(part.column(1)))
                pre = [_prefix(s, tokens, rank) for s in got]
                keep = pa.array([len(s) > 0 for s in got])
                yield pa.RecordBatch.from_arrays([
                    pa.array([_digest(s) for s in got], pa.binary()), part.column(0), pa.array([len(s) for s in got], pa.int64()),
                    pa.array([p.tobytes() for p in pre], pa.binary())], ["digest", "doc", "n", "prefix"]).filter(keep)

    got = _rows(docs, text).mapInArrow(sets, "digest binary, doc long, n long, prefix binary")
    one = got.groupBy("digest").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    return stored(one.withColumn("node", F.monotonically_increasing_id()), "classes")


def _postings(classes: DataFrame) -> DataFrame:
    """(token, node, n, rest) of prefix shingles that a class of fitting size shares; ``rest``: the set's shingles from there on.

    Of a linked pair, the first shingle in common has at least the least overlap, 80/180 of both sizes, left on both sides. So
    with a class only those of its shingles stay that another class has whose size allows that: the next smaller or the
    next larger size among the classes of the shingle decides."""

    def explode(batches):
        for batch in batches:
            raw, offs = buffer(batch.column(1))
            for k in range(0, batch.num_rows, 2000):
                o = offs[k:k + 2001]
                token = np.frombuffer(raw[o[0]:o[-1]].tobytes(), np.int64)
                size = np.diff(o) // 8
                node, n = (np.repeat(batch.column(i).slice(k, 2000).to_numpy(zero_copy_only=False), size) for i in (0, 2))
                place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(node), pa.array((n << 32) | (n - place))], ["token", "node", "sizes"])

    rows = classes.select("node", "prefix", "n").mapInArrow(explode, "token long, node long, sizes long")
    by_size = Window.partitionBy("token").orderBy("sizes")
    size = lambda c: F.shiftright(c, 32)
    near = rows.select("*", size(F.lag("sizes").over(by_size)).alias("smaller"), size(F.lead("sizes").over(by_size)).alias("larger"))
    n, rest = size("sizes"), F.col("sizes").bitwiseAND(F.lit(0xFFFFFFFF))
    most = F.least(100 * n / PERCENT, (100 + PERCENT) * rest / PERCENT - n)
    return near.where((100 * F.col("smaller") >= PERCENT * n) | (F.col("larger") <= most)).select("token", "node", n.alias("n"), rest.alias("rest"))


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def _sets(docs: DataFrame, text: str, wanted: DataFrame) -> tuple[str, DataFrame]:
    """The name of a table, and the table (node, n, set, keys) of the wanted classes, from the text of their least doc_id; a table bucketed by node, so that
    the joins below move pairs and not sets."""

    @F.arrow_udf("struct<ok: boolean, n: long, set: binary, keys: array<long>>")
    def cut(digests: pa.Array, texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["t"])
        wanted, ok, n, raw, keys = iter(digests.to_pylist()), [], [], [], []
        for part in slices(batch, 0):
            for s in shingle_sets(*buffer(part.column(0))):
                ok.append(_digest(s) == next(wanted))
                n.append(len(s))
                raw.append(s.tobytes() if ok[-1] else b"")
                keys.append([int(mix(s ^ x).min().view(np.int64)) for x in _SALT] if ok[-1] else None)
        return pa.StructArray.from_arrays([pa.array(ok, pa.bool_()), pa.array(n, pa.int64()), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["ok", "n", "set", "keys"])

    spark = docs.sparkSession
    absent = F.lit(-(1 << 63))
    rows = _rows(docs, text).select(F.coalesce("doc", absent).alias("doc"), "text")
    found = wanted.select("node", "digest", F.coalesce("doc", absent).alias("doc")).join(rows, "doc").select("node", cut("digest", "text").alias("c"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"culvert_sets_{uuid.uuid4().hex}"
    one = found.where("c.ok").select("node", "c.n", "c.set", "c.keys").repartition(parts, "node").dropDuplicates(["node"])
    one.write.bucketBy(parts, "node").option("path", _place(spark, name)).saveAsTable(name)
    return name, spark.table(name)


def _link(a: pa.Array, b: pa.Array) -> pa.Array:
    out = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(a, b)]
    tidy()
    return pa.array(out, pa.bool_())


def _may_link(a: pa.Array, union: pa.Array, low: pa.Array) -> pa.Array:
    """Whether a set has enough in a union to link with a member of at least ``low`` shingles."""
    out = []
    for x, y, m in zip(a, union, low.to_pylist()):
        s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        both = len(np.intersect1d(s, t, assume_unique=True))
        out.append((100 + PERCENT) * both >= PERCENT * (len(s) + max(m, both)))
    tidy()
    return pa.array(out, pa.bool_())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs that link; ``pairs`` is stored. Sets of impossible sizes are not compared."""
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("set").alias("sa"))
    b = sets.join(pairs.select(F.col("b").alias("node")).distinct(), "node").select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("set").alias("sb"))
    fits = (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    return pairs.join(a, "a").join(b, "b").where(fits).where(F.arrow_udf("boolean")(_link)("sa", "sb")).select("a", "b")


def _groups(sets: DataFrame, postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, links): (node, hub, chunk, many) of every class, and the links (a, b) that connect the groups; both stored.

    A round's bucket is a min-hash, so two classes share it with a chance of their similarity. Each class without a group is
    compared with one class of its bucket, so a round has at most as many comparisons as classes, whatever their groups' sizes.
    That one is the class with the fewest prefix shingles of its own: of a text and its changed copies, which often link with the text only, it is the text."""
    shared = postings.groupBy("node").agg(F.count("*").alias("shared"))
    own = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - F.col("shared")
    state = stored(sets.join(shared, "node").select("node", "n", "keys", own.alias("own"), F.lit(None).cast("long").alias("hub")), "state")
    links, temporary = None, []
    for r in range(ROUNDS):
        key = state.select("node", "hub", "own", F.col("keys")[r].alias("key"))
        order = F.struct("own", F.col("hub").isNull(), F.xxhash64("node", F.lit(r)))
        heads = key.groupBy("key").agg(F.count("*").alias("m"), F.min_by(F.struct("node", "hub"), order).alias("h")).where(F.col("m") > 1)
        pairs = stored(key.where("hub is null").join(heads, "key").where(F.col("node") != F.col("h.node")).select(F.col("node").alias("a"), F.col("h.node").alias("b"), F.coalesce("h.hub", "h.node").alias("g")), "heads")
        found = stored(_verified(pairs.select("a", "b"), sets).join(pairs.select("a", "g"), "a"), "joined")
        discard(pairs)
        links = found.select("a", "b") if links is None else links.unionByName(found.select("a", "b"))
        # a head without a group starts one; it is in no other bucket of this round, so it joins none
        got = found.select(F.col("a").alias("joined"), "g").unionByName(found.select(F.col("g").alias("joined"), "g").distinct())
        before, state = state, stored(state.join(got, state["node"] == got["joined"], "left").select("node", "n", "keys", "own", F.coalesce("hub", "g").alias("hub")), "state")
        discard(before)
        temporary.append(found)
    every = state.select("node", "n", F.coalesce("hub", "node").alias("hub"))
    # chunks are ranges of size, cut by the share of the group's classes that are smaller
    sizes = every.groupBy("hub").agg(F.count("*").alias("m"), F.percentile_approx("n", F.array(*[F.lit(x / 32) for x in range(1, 32)]), F.lit(1000)).alias("cuts"))
    band = F.size(F.filter("cuts", lambda c: c < F.col("n")))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / (CHUNK * (F.size(F.array_distinct("cuts")) + 1))))
    chunk = F.when(F.col("m") > CHUNK, band + 32 * part).otherwise(0).cast("int")
    groups = stored(every.join(sizes, "hub").select("node", "hub", chunk.alias("chunk"), (F.col("m") > 1).alias("many")), "groups")
    links = stored(links, "grouped")
    discard(state, *temporary)
    return groups, links


def _cross_links(postings: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): a class and a class of another group that link, at least one for any two groups that have such a link."""
    rows = stored(postings.join(groups, "node"), "matrix")
    matrix = rows.groupBy("token", F.col("hub").alias("g"), F.col("chunk").alias("c")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("most"), F.first("many").alias("many"))
    probes = rows.select("token", F.col("node").alias("a"), "hub", "n", "rest")
    least = PERCENT * (F.col("n") + F.col("low"))
    fits = (F.col("hub") < F.col("g")) & (PERCENT * F.col("n") <= 100 * F.col("high")) & (PERCENT * F.col("low") <= 100 * F.col("n"))
    fits = fits & ((100 + PERCENT) * F.col("rest") >= least) & ((100 + PERCENT) * F.col("most") >= least)
    candidates = stored(probes.join(matrix, "token").where(fits).select("a", "g", "c", "many").distinct(), "candidates")
    # chunks of one class are that class; of the others, the union bounds the overlap
    single = candidates.where("not many").select("a", F.col("g").alias("b"))
    many = candidates.where("many").select("a", "g", "c")
    members = groups.select(F.col("hub").alias("g"), F.col("chunk").alias("c"), "node")

    @F.arrow_udf("binary")
    def union(v: pa.Array) -> pa.Array:
        return pa.array([np.unique(np.frombuffer(b"".join(x), np.uint64)).tobytes() for x in v.to_pylist()], pa.binary())

    unions = members.join(many.select("g", "c").distinct(), ["g", "c"]).join(sets.select("node", "n", "set"), "node").groupBy("g", "c").agg(F.min("n").alias("low"), F.collect_list("set").alias("s")).select("g", "c", "low", union("s").alias("u"))
    own = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    opened = many.join(own, "a").join(unions, ["g", "c"]).where(F.arrow_udf("boolean")(_may_link)("sa", "u", "low")).select("a", "g", "c")
    pairs = single.unionByName(opened.join(members, ["g", "c"]).select("a", F.col("node").alias("b")))
    got = stored(_verified(stored(pairs, "pairs"), sets), "cross")
    discard(rows, candidates)
    return got


def _named(docs: DataFrame, text: str) -> DataFrame:
    """(digest, doc, root): every different set, its least doc_id and its component."""
    ship(docs.sparkSession)
    classes = _classes(docs, text)
    shared = stored(_postings(classes), "postings")
    wanted = classes.select("node", "digest", "doc").join(shared.select("node").distinct(), "node")
    name, sets = _sets(docs, text, wanted)
    groups, links = _groups(sets, shared)
    cross = _cross_links(shared, groups, sets)
    roots = components(links.unionByName(cross))
    spark = docs.sparkSession
    discard(shared, groups, links, cross)
    spark.sql(f"DROP TABLE {name}")
    delete(spark, _place(spark, name))
    return classes.select("node", "digest", "doc").join(roots, "node", "left").select("digest", "doc", F.coalesce("root", "node").alias("root"))


def _digests_udf():
    @F.arrow_udf("struct<n: long, digest: binary>")
    def digest(v: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([v], ["t"])
        got = [(len(s), _digest(s) if len(s) else None) for part in slices(batch, 0) for s in shingle_sets(*buffer(part.column(0)))]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in got], pa.int64()), pa.array([d for _, d in got], pa.binary())], ["n", "digest"])

    return digest


def linked_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc (doc_id as long), n (shingles) and component (least doc_id reachable by links, itself included)."""
    named = _named(docs, text)
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    by_digest = named.join(least, "root").select("digest", "component")
    own = _rows(docs, text).select("doc", _digests_udf()("text").alias("s")).select("doc", "s.n", "s.digest")
    return own.join(by_digest, "digest", "left").select("doc", "n", F.coalesce("component", "doc").alias("component"))


def representatives(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents, of the least doc_id; rows without shingles all stay."""
    named = _named(docs, text)
    absent = F.lit((1 << 63) - 1)
    stays = named.groupBy("root").agg(F.min(F.struct(F.coalesce("doc", absent).alias("doc"), "digest")).alias("k")).select("k.doc", "k.digest")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), absent).alias("doc"), _digests_udf()(F.coalesce(F.col(text), F.lit(""))).alias("s"))
    rows = rows.select("row", "doc", F.col("s.digest").alias("digest"))
    kept = rows.where("digest is not null").join(stays, ["doc", "digest"]).dropDuplicates(["doc", "digest"]).select("row")
    return kept.unionByName(rows.where("digest is null").select("row")).select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = linked_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
