"""What a batch puts on disk on the way: deleted as soon as it is not needed any more."""

import datetime as dt
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from culvert.functions.ids import canonical_uuid
from culvert.plans.inspections import unified_inspections
from culvert.session import checkpoint_dir, materialise, scratch, settle
from culvert.sources.lookups import all_lookups
from culvert.sources.schemas import CR_INSPECT_SCHEMA, FEED_SCHEMA, SOURCE_SCHEMAS, WOT_STG1_SCHEMA, WOT_STG_SCHEMA
from culvert.streaming import rules as R
from culvert.streaming import state as S
from culvert.streaming.sync import init_state, make_batch_fn, read_state


def shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def made(spark):
    """The tables in the checkpoint folder, by either way of storing them."""
    top = checkpoint_dir(spark).removeprefix("file:")
    return {d for d, *_ in os.walk(top) if os.path.basename(d).startswith(("made-", "rdd-"))}


def gone(found, before):
    """What is there now and was not before; files are deleted a moment after their execution."""
    for _ in range(50):
        if not (left := found() - before):
            break
        time.sleep(0.2)
    return left


def frame(spark, schema, rows):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def h(x):
    return f"{x:032x}"


def view_sources(spark, uuids):
    """One manhole, and one history row (key = place + 1) of one task for each id."""
    rows = {n: [] for n in SOURCE_SCHEMAS}
    rows["epdrdrainfacility"] = [{"epdrdrainagefacilityoi": 1, "facilityid": "MH1", "facilitytype": 1}]
    rows["workordertask"] = [{"workordertaskoi": 1, "workorder_oi": 1, "tasknumber": 1, "uuid": h(1), "wotasktitle": "t", "longdescript": "<p>x</p>"}]
    rows["workorders"] = [{"workordersoi": 1, "wonumber": "W", "uuid": h(2)}]
    rows["epdrfacworkhistory"] = [{"epdrfacilityworkhistoryoi": i + 1, "wotask_oi": 1, "epdrfacility_oi": 1, "uuid": u} for i, u in enumerate(uuids)]
    return {n: frame(spark, t, rows[n]) for n, t in SOURCE_SCHEMAS.items()}


@pytest.fixture
def state(spark):
    stg = [{"task_uuid": h(k), "workorder_uuid": h(1000 + k // 4), "wotasktitle": f"t{k}", "feed_status": "SENT"} for k in range(40)]
    queue = [{"task_uuid": h(1000 + k), "wotasktitle": "q", "feed_status": "NEW"} for k in range(5)]
    return {"stg": frame(spark, WOT_STG_SCHEMA, stg), "queue": frame(spark, WOT_STG1_SCHEMA, queue), "cr": spark.createDataFrame([], CR_INSPECT_SCHEMA)}


@pytest.fixture
def feed(spark):
    events = [{"seq": 0, "source": "history", "history_oi": 1}, {"seq": 1, "source": "workorder", "wo_uuid": h(1001), "site_oi": 58, "reqcompdate_dttm": dt.datetime(2020, 1, 1)},
              {"seq": 2, "source": "queue", "queue_uuid": h(1002), "old_status": "NEW", "new_status": "SENT"},
              {"seq": 3, "source": "staging", "task_uuid": h(5), "wotasktitle": "lost", "feed_status": "NEW"},
              {"seq": 4, "source": "staging", "task_uuid": h(9), "workorder_uuid": h(1002), "wotasktitle": "s", "feed_status": "NEW"}]
    return frame(spark, FEED_SCHEMA, events)


def test_a_materialised_table_leaves_no_shuffle_and_scratch_no_table(spark):
    files, tables = shuffles(spark), made(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with scratch(spark):
        kept = materialise(df)
        assert gone(lambda: shuffles(spark), files) == set()
        twice = settle(lambda: materialise(kept).unionByName(kept))
        assert len(made(spark) - tables) == 2 and twice.count() == 14
    assert made(spark) - tables == set()


def test_a_batch_leaves_only_its_parts_of_the_state(spark, state, feed):
    folder = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    files, tables = shuffles(spark), made(spark)
    init_state(folder, state)
    make_batch_fn(folder, view_sources(spark, [h(7)]), all_lookups(spark), query="q")(feed, 0)
    assert made(spark) - tables == set()
    assert gone(lambda: shuffles(spark), files) == set()
    assert read_state(spark, folder)["cr"].count() == 1


def test_a_cascade_leaves_no_shuffles_behind(spark, state, feed):
    files = shuffles(spark)
    out = R.run_cascade(state, feed, view_sources(spark, [h(7)]), all_lookups(spark))
    assert gone(lambda: shuffles(spark), files) == set()     # of all the steps before the result is run
    got = {r.task_uuid: (r.workorder_uuid, r.wotasktitle, r.feed_status) for r in out["stg"].collect()}
    assert got[h(5)] == (None, "lost", "NEW") and got[h(4)][2] == "UPDATED" and got[h(9)] == (h(1002), "s", "NEW") and got[h(8)][2] == "SENT"
    assert len(got) == 40 and out["quarantine_queue"].count() == 1


@pytest.mark.parametrize("dedupe", ["raw", "canonical"])
def test_ids_that_repeat_or_are_stored(spark, dedupe):
    dashed = f"{h(3)[:8]}-{h(3)[8:12]}-{h(3)[12:16]}-{h(3)[16:20]}-{h(3)[20:]}"
    uuids = [h(3), dashed, dashed.upper(), h(4), h(4), None, None, "zz", "zz", h(5), h(6), "yy", "yy"]
    src = view_sources(spark, uuids)
    stored = spark.createDataFrame([("yy",), (dashed.replace("3", "5"),), (None,)], "inspectionid string")
    order = list(range(len(uuids)))[::-1]
    keys = spark.createDataFrame([(i, k + 1) for i, k in enumerate(order)], "seq long, history_oi long")
    got = R.collect_inspections(stored, keys, src, all_lookups(spark), dedupe=dedupe)
    canonical = {u: c for u, c in spark.createDataFrame([(u,) for u in set(uuids)], "u string").select("u", canonical_uuid(F.col("u"))).collect()}
    seen, want = {r[0] for r in stored.collect() if r[0]}, []
    for i, k in enumerate(order):    # one at a time
        u = uuids[k]
        if (u if dedupe == "raw" else canonical[u]) not in seen:
            want.append((i, canonical[u]))
            seen |= {canonical[u]} - {None}
    assert sorted((r["__seq"], r["inspectionid"]) for r in got.collect()) == sorted(want)


def test_ids_of_a_bucket_are_written_as_they_were(spark):
    folder = os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")
    rows = [{"task_uuid": u, "workorder_uuid": w} for u, w in ((h(0xabc), h(1).upper()), ("plain", None), (None, "x-y"), (None, None), ("", h(2)))]
    df = frame(spark, WOT_STG_SCHEMA, rows)
    note = {"buckets": 4, "stg": {}}
    with scratch(spark):
        note["stg"] = S.write_buckets(df, folder, "stg", 0, note, set(range(4)))
    assert sorted(map(str, S.read(spark, folder, note, "stg").collect())) == sorted(map(str, df.collect()))


def test_the_stored_view_has_the_rows_of_the_view_and_one_shuffle(spark):
    src, lk = view_sources(spark, []), all_lookups(spark)
    tasks = [(1, 1, 1, h(1)), (1, 1, 1, h(1)), (1, 2, None, "odd id"), (2, None, 1, None), (3, 9, 9, h(3).upper()), (None, 1, 1, h(4)), (4, 2, 2, "")]
    history = [(i, t, f, u) for i, (t, f, u) in enumerate([(1, 1, h(11)), (1, 1, h(11)), (2, 1, "x"), (3, 2, None), (None, 1, h(12)), (4, None, h(13)), (4, 2, h(14)), (7, 1, h(15)), (1, 5, h(16))])]
    src["workordertask"] = frame(spark, SOURCE_SCHEMAS["workordertask"], [
        {"workordertaskoi": t, "workorder_oi": w, "asset_oi": a, "tasknumber": t, "uuid": u, "wotasktitle": f"t{t}", "longdescript": "<p>x</p>"} for t, w, a, u in tasks])
    src["workorders"] = frame(spark, SOURCE_SCHEMAS["workorders"], [{"workordersoi": w, "wonumber": n, "uuid": u} for w, n, u in [(1, "W1", h(21)), (2, "W2", "odd"), (2, "W3", None), (None, "W", h(22))]])
    src["asset"] = frame(spark, SOURCE_SCHEMAS["asset"], [{"assetoi": a, "assetnumber": n} for a, n in [(1, "A1"), (1, "A1"), (2, None), (None, "A")]])
    src["epdrdrainfacility"] = frame(spark, SOURCE_SCHEMAS["epdrdrainfacility"], [
        {"epdrdrainagefacilityoi": f, "facilityid": i, "facilitytype": k, "epdrunknownf_oi": n} for f, i, k, n in [(1, "MH1", 1, None), (2, "SC-1-2", 10, 1), (2, "CB1", 2, None), (5, "X", 9, None)]])
    src["epdrunknfac"] = frame(spark, SOURCE_SCHEMAS["epdrunknfac"], [{"epdrunknownfacilityoi": 1, "unknfactype": 6}])
    src["epdrfacworkhistory"] = frame(spark, SOURCE_SCHEMAS["epdrfacworkhistory"], [
        {"epdrfacilityworkhistoryoi": i, "wotask_oi": t, "epdrfacility_oi": f, "uuid": u} for i, t, f, u in history])
    rows = lambda df: sorted(map(str, df.collect()))
    want = rows(unified_inspections(src, lk))
    tables, known = made(spark), {t.name for t in spark.catalog.listTables()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            with scratch(spark):
                got = unified_inspections(src, lk, stored=True)
                assert rows(got) == want and len(want) > 10
            if limit == "-1":   # no table is broadcast, and only the histories are still to be shuffled
                assert got._jdf.queryExecution().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert made(spark) == tables and {t.name for t in spark.catalog.listTables()} == known
