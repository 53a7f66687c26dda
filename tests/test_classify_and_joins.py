"""Classification table, attribute switches and join helpers."""

from pyspark.sql import functions as F

from culvert.operators import classify as K
from culvert.operators.joins import left_join_spread_nulls, code_join
from culvert.sources.lookups import shape_lookup, wall_lookup

# (facilitytype, unknfactype) -> branches
CASES = [
    ((1, None), ["MACP"]), ((2, 5), ["MACP"]), ((4, None), ["LACP"]), ((8, None), ["PACP"]),
    ((10, 2), ["MACP"]), ((10, 3), ["MACP"]), ((10, 4), ["PACP"]), ((10, 5), ["PACP"]), ((10, 8), ["PACP"]),
    ((10, 6), ["PACP", "LACP"]), ((10, 7), ["PACP", "LACP"]), ((10, None), []), ((9, 2), []), ((None, None), []),
]


def test_branch_table(spark):
    df = spark.createDataFrame([(i, ft, ut) for i, ((ft, ut), _) in enumerate(CASES)], "id int, ft long, ut long")
    got = {r["id"]: r["b"] for r in df.select("id", K.branch_tags(F.col("ft"), F.col("ut")).alias("b")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, CASES[i]
    n = K.explode_branches(df, "ft", "ut").count()
    assert n == sum(len(w) for _, w in CASES)


def test_pick_vs_type1_differ_on_10_3(spark):
    df = spark.createDataFrame([(10, 3), (10, 2), (2, None), (1, None)], "ft long, ut long")
    ft, ut = F.col("ft"), F.col("ut")
    rows = df.select(K.pick_by_kind(ft, ut, F.lit("cb"), F.lit("mh")).alias("p"),
                     K.type1_only(ft, ut, F.lit("w")).alias("w"), K.access_type(ft, ut).alias("a")).collect()
    assert [r.p for r in rows] == ["mh", "cb", "cb", "mh"]
    assert [r.w for r in rows] == [None, None, None, "w"]
    assert [r.a for r in rows] == ["AMH", "ACB", "ACB", "AMH"]


def test_left_join_spread_nulls_equals_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else i % 5) for i in range(60)], "id long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(4)], "rk long, v string")
    got = sorted(left_join_spread_nulls(left, right, "k", "rk", salt_from=["id"]).select("id", "k", "v").collect())
    want = sorted(left.join(right, left.k == right.rk, "left").select("id", "k", "v").collect())
    assert got == want


def test_spread_nulls_salt_is_join_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.createDataFrame([(1, None)], "id long, k long")
        right = spark.createDataFrame([(1, "a")], "rk long, v string")
        plan = left_join_spread_nulls(left, right, "k", "rk", salt_from=["id"])._jdf.queryExecution() \
            .executedPlan().toString()
        assert "__salt_l" in plan.split("SortMergeJoin")[1].split("]")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_code_join_normalises_and_keeps_null_codes(spark):
    df = spark.createDataFrame([(" circular ",), ("Box",), ("nope",), (None,)], "s string")
    got = {r.s: r.c for r in code_join(df, F.col("s"), shape_lookup(spark), "c").collect()}
    assert got == {" circular ": "C", "Box": "S", "nope": None, None: None}
    w = spark.createDataFrame([("no cone",), ("brick",)], "s string")
    got = {r.s: r.c for r in code_join(w, F.col("s"), wall_lookup(spark), "c").collect()}
    assert got == {"no cone": None, "brick": "BR"}


def test_lookup_sizes(spark):
    from culvert.sources.lookups import MATERIAL_ROWS, MH_USE_ROWS, SHAPE_ROWS, WALL_ROWS
    assert (len(SHAPE_ROWS), len(MATERIAL_ROWS), len(WALL_ROWS), len(MH_USE_ROWS)) == (18, 67, 14, 5)
    assert sum(1 for _, c in WALL_ROWS if c is None) == 5
    assert dict(MATERIAL_ROWS)["WEEPING TILE"] == "PVC"


def test_split_by_keys_shuffles_no_wide_row(spark):
    from culvert.operators.joins import split_by_keys, split_rows
    rows = [(f"k{i % 400}" if i % 9 else None, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int")
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 400, 5)] + [(None,), ("k0",)], "key string")
    near, far = split_by_keys(df, "k", keys, "key")
    got_near, got_far = [tuple(r) for r in near.collect()], [tuple(r) for r in far.collect()]
    wanted = {f"k{i}" for i in range(0, 400, 5)}
    assert sorted(got_near + got_far, key=str) == sorted(rows, key=str)
    assert {r for r in rows if r[0] in wanted} <= set(got_near)
    assert not any(r[0] is None for r in got_near) and len(got_near) < 400
    for part in (near, far):
        assert "SortMergeJoin" not in part._jdf.queryExecution().toString()
    inside, rest, out = split_rows(df, "k", keys.distinct(), "key")
    assert sorted(tuple(r) for r in inside.collect()) == sorted(r for r in rows if r[0] in wanted)
    assert sorted([tuple(r) for r in rest.unionByName(out).collect()], key=str) == sorted([r for r in rows if r[0] not in wanted], key=str)
    # the exact join comes after the filter
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("__key") < plan.index("__word") and "LeftSemi" not in plan
    none = split_by_keys(df, "k", keys.where("key is null"), "key")
    assert none[0].count() == 0 and none[1].count() == 2000


def test_join_tasks_shuffles_a_task_text_once(spark):
    """All rows of the plain joins, for tasks, assets and work orders that repeat or are null; the wide columns meet one exchange."""
    from culvert.plans.spine import join_tasks, task_rows
    tasks = [(1, 10, 5, 1, "a", "u1", "d1"), (1, 10, 5, 1, "a", "u1", "d1"), (1, 10, 5, 2, "b", "u2", None), (1, 11, 5, 1, "c", None, "d"),
             (1, None, 5, 1, "e", "u", "d"), (2, None, None, 1, "f", "0" * 32, "<x"), (2, 10, None, 1, "g", "A" * 32, ""),
             (3, 99, 98, None, None, "x", "y"), (None, 10, 5, 1, "h", "u", "d"), (4, 10, 5, 1, "i", "u", "d")]
    src = {
        "workordertask": spark.createDataFrame(tasks, "workordertaskoi long, workorder_oi long, asset_oi long, tasknumber long, "
                                                      "wotasktitle string, uuid string, longdescript string"),
        "workorders": spark.createDataFrame([(10, "W", "0" * 32), (10, "W", "0" * 32), (11, None, "w"), (None, "N", "n")],
                                            "workordersoi long, wonumber string, uuid string"),
        "asset": spark.createDataFrame([(5, "A"), (5, "B"), (None, "N")], "assetoi long, assetnumber string")}
    hist = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 2, 3, None, 7])], "h long, task long")
    wide = join_tasks(hist, src, "task", between=lambda d: d)
    plain = task_rows(src)
    plain = hist.join(plain, hist["task"] == plain["__task_key"]).select(*[c for c in wide.columns if c != "__task_key"])
    rows = lambda df: sorted(map(str, df.select(*plain.columns).collect()))
    assert rows(wide) == rows(plain) and wide.count() == 2 * (3 * 4 + 2 + 2) + (1 + 2) + 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_tasks(hist, src, "task", between=lambda d: d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # task#, __task_key and __l_key of the joins by task, the distinct triple, and both sides of the two links
    assert len(dealt) == 8 and sum("__task_key" in d and "workorder_oi" not in d for d in dealt) == 1
