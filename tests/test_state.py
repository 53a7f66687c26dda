"""Ordered intake and state in parts."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from culvert.session import checkpoint_dir
from culvert.sources import io
from culvert.sources.lookups import all_lookups
from culvert.sources.schemas import CR_INSPECT_SCHEMA, FEED_SCHEMA, SOURCE_SCHEMAS, WOT_STG1_SCHEMA, WOT_STG_SCHEMA
from culvert.streaming import intake
from culvert.streaming import rules as R
from culvert.streaming import state as S
from culvert.plans.outbound import OUTBOUND_COLUMNS, extract_to_send
from culvert.operators import quality as Q
from culvert.streaming import watch
from culvert.streaming.sync import init_state, make_batch_fn, read_held, read_outbound, read_state, send_outbound, stream_sync

FIELDS = [f.name for f in FEED_SCHEMA.fields]


def h(x):
    return f"{x:032x}"


@pytest.fixture
def folder(spark):
    return os.path.join(checkpoint_dir(spark), f"t-{uuid.uuid4().hex}")


@pytest.fixture
def sources(spark):
    return {n: spark.createDataFrame([], t) for n, t in SOURCE_SCHEMAS.items()}, all_lookups(spark)


def events_frame(spark, rows):
    return spark.createDataFrame([tuple((dict.fromkeys(FIELDS) | e)[f] for f in FIELDS) for e in rows], FEED_SCHEMA)


def stored(spark, n):
    stg = [(h(k), h(10_000 + k // 4), f"t{k}", None, None, k, "SENT", None) for k in range(n)]
    cr = spark.createDataFrame([(h(k), "SENT", f"W{k % 50}") for k in range(n)], "inspectionid string, feed_status string, workorder string")
    return {"stg": spark.createDataFrame(stg, WOT_STG_SCHEMA), "queue": spark.createDataFrame([(h(10_000 + k), "q", None, None, None, "NEW") for k in range(0, n // 4, 2)], WOT_STG1_SCHEMA),
            "cr": spark.createDataFrame([], CR_INSPECT_SCHEMA).unionByName(cr, allowMissingColumns=True)}


def feed_rows(n, wos, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(wos)
        out.append({"seq": 3 * i} | r.choice([
            {"source": "staging", "task_uuid": h(4 * w + r.randrange(5)), "workorder_uuid": h(10_000 + w), "wotasktitle": f"s{i}", "feed_status": r.choice(["NEW", "SENT"])},
            {"source": "workorder", "wo_uuid": h(10_000 + w), "site_oi": 58, "reqcompdate_dttm": dt.datetime(2020, 1, 1 + r.randrange(3))},
            {"source": "queue", "queue_uuid": h(10_000 + w), "old_status": "NEW", "new_status": r.choice(["SENT", "OTHER"])},
            {"source": "inspection", "inspectionid": h(w), "project_sid": h(4 * w), "work_order_uuid": h(10_000 + w), "feed_status": r.choice(["NEW", "DONE"])}]))
    return out


def text(df):
    return sorted(map(str, df.collect()))


def test_contiguous_files():
    files = {"b": (10, 20), "a": (None, 10), "d": (30, 40), "c": (20, 30)}
    assert intake.contiguous(None, files) == (["a", "b", "c", "d"], 40)
    assert intake.contiguous(None, {k: files[k] for k in "bd"}) == ([], None)
    assert intake.contiguous(20, {k: files[k] for k in "dc"}) == (["c", "d"], 40)
    assert intake.contiguous(10, {k: files[k] for k in "bd"}) == (["b"], 20)
    with pytest.raises(ValueError):
        intake.contiguous(None, {"a": (None, 10), "b": (None, 20)})


def test_feed_files_and_manifest(spark, folder):
    rows = feed_rows(60, [1, 2], 1)
    io.write_feed(events_frame(spark, rows[:40]), folder, files=3)
    io.write_feed(events_frame(spark, rows[40:]), folder, files=2)
    got = {r["file"]: r for r in io.feed_manifest(spark, folder).collect()}
    names = {f for f in io.folders(spark, folder) if f.endswith(".parquet")}
    assert set(got) == names and len(names) == 5 and sum(r["n"] for r in got.values()) == 60
    order, end = intake.contiguous(None, {f: (r["after"], r["last"]) for f, r in got.items()})
    assert len(order) == 5 and end == 59 * 3
    assert spark.read.schema(FEED_SCHEMA).parquet(folder).count() == 60
    with pytest.raises(ValueError):
        io.write_feed(events_frame(spark, rows[:5]), folder)


@pytest.mark.parametrize("seed", [1])
def test_files_in_any_order_give_the_state_of_one_batch(spark, folder, sources, seed):
    rows = feed_rows(80, list(range(12)), seed)
    feed_dir, arrived, state_dir = (os.path.join(folder, x) for x in ("feed", "arrived", "state"))
    io.write_feed(events_frame(spark, rows), feed_dir, files=4)
    state = stored(spark, 60)
    init_state(state_dir, state, buckets=8)
    apply = make_batch_fn(state_dir, *sources, query="q", feed_dir=feed_dir)
    files = [f for f in io.folders(spark, feed_dir) if f.endswith(".parquet")]
    random.Random(seed).shuffle(files)
    # two files at first, then one by one; a batch comes twice
    for k, part in enumerate([files[:2], files[2:3], files[2:3], files[3:]]):
        batch = spark.read.schema(FEED_SCHEMA).parquet(*[os.path.join(feed_dir, f) for f in part]).select("*", F.col("_metadata.file_name").alias(io.FILE))
        apply(batch, [0, 1, 1, 2][k])
    assert read_held(spark, state_dir).isEmpty() and S.last_version(spark, state_dir)[1]["frontier"] == 79 * 3
    want = R.run_cascade(state, events_frame(spark, rows), *sources)
    got = read_state(spark, state_dir)
    for t in ("stg", "queue", "cr"):
        assert text(got[t]) == text(want[t])


def test_a_missing_file_holds_back_what_follows(spark, folder, sources):
    rows = feed_rows(40, [1, 2, 3], 5)
    feed_dir, state_dir = os.path.join(folder, "feed"), os.path.join(folder, "state")
    io.write_feed(events_frame(spark, rows), feed_dir, files=2)
    init_state(state_dir, stored(spark, 20), buckets=4)
    last = max(io.feed_manifest(spark, feed_dir).collect(), key=lambda r: r["last"])
    before = {t: text(df) for t, df in read_state(spark, state_dir).items()}
    batch = spark.read.schema(FEED_SCHEMA).parquet(os.path.join(feed_dir, last["file"])).select("*", F.col("_metadata.file_name").alias(io.FILE))
    make_batch_fn(state_dir, *sources, query="q", feed_dir=feed_dir)(batch, 0)
    assert read_held(spark, state_dir).count() == last["n"] > 0
    assert {t: text(df) for t, df in read_state(spark, state_dir).items()} == before


def test_a_stream_over_late_files(spark, folder, sources):
    rows = feed_rows(60, list(range(6)), 7)
    feed_dir, state_dir, ckpt = (os.path.join(folder, x) for x in ("feed", "state", "ckpt"))
    state = stored(spark, 30)
    init_state(state_dir, state, buckets=8)
    for part in (rows[:30], rows[30:]):
        io.write_feed(events_frame(spark, part), feed_dir, files=3)
        stream_sync(spark, feed_dir, state_dir, ckpt, *sources, max_files_per_trigger=2).awaitTermination()
    want, got = R.run_cascade(state, events_frame(spark, rows), *sources), read_state(spark, state_dir)
    assert read_held(spark, state_dir).isEmpty()
    for t in ("stg", "queue", "cr"):
        assert text(got[t]) == text(want[t])


def _bytes(spark, path):
    fs, p, _ = io._hadoop_fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def test_a_batch_writes_what_it_touches(spark, folder, sources, monkeypatch):
    monkeypatch.setattr(S, "COMPACT", 2)
    state = stored(spark, 4000)
    init_state(folder, state, buckets=64)
    apply = make_batch_fn(folder, *sources, query="q", with_backfill=True)
    all_rows = []
    for k in range(4):
        rows = [e | {"seq": 1000 * k + e["seq"]} for e in feed_rows(12, [5 + k], k)] + [{"seq": 1000 * k + 900, "source": "vendor", "workorder": "W7", "inspection_sid": f"sid{k}"}]
        if k == 2:
            rows.append({"seq": 2950, "source": "staging", "task_uuid": h(40), "workorder_uuid": None, "wotasktitle": "lost", "feed_status": "SENT"})
        all_rows += rows
        apply(events_frame(spark, rows), k)
        version, note = S.last_version(spark, folder)
        wide = 3 if k == 2 else 1  # a row that loses its work order touches where it was and where it goes
        for t in S.BUCKETED:
            assert sum(v == version for v in note[t].values()) <= wide
            assert _bytes(spark, S._part(folder, t, version)) < 0.15 * _bytes(spark, S._part(folder, t, 0)) or _bytes(spark, S._part(folder, t, 0)) == 0
        merged = not note["changes"] and not note["sids"]
        if not merged:  # no old inspection row is written
            assert _bytes(spark, S._part(folder, "cr", version)) == 0 and version in note["sids"]
        if k == 3:
            want, got = R.run_cascade(state, events_frame(spark, all_rows), *sources, with_backfill=True), read_state(spark, folder)
            for t in ("stg", "queue", "cr"):
                assert text(got[t]) == text(want[t]), (k, t)
    # only parts of kept versions are left
    versions = io.committed_versions(spark, folder)
    assert len(versions) == S.KEEP_VERSIONS
    listed = set().union(*[S._places(folder, S.note_of(spark, folder, v)) for v in versions])
    there = {os.path.join(folder, "data", t, v, b) for t in S.BUCKETED for v in io.folders(spark, os.path.join(folder, "data", t)) for b in io.folders(spark, os.path.join(folder, "data", t, v)) if b.startswith("bucket=")}
    there |= {os.path.join(folder, "data", t, v) for t in S.PARTS for v in io.folders(spark, os.path.join(folder, "data", t))}
    assert there == listed


def test_a_status_change_meets_only_rows_that_were_there(spark):
    cr = spark.createDataFrame([("a", "NEW", None, 5), ("a", "NEW", None, 1), ("a", "NEW", None, None), ("b", "NEW", None, 1)], "inspectionid string, feed_status string, additional_information string, __seq long")
    changes = spark.createDataFrame([("a", "X", 2), ("a", "Y", 3)], "inspectionid string, feed_status string, seq long")
    got = {(r["inspectionid"], r["__seq"]): r["feed_status"] for r in R.set_inspection_status(cr, changes).collect()}
    assert got == {("a", 5): "NEW", ("a", 1): "Y", ("a", None): "Y", ("b", 1): "NEW"}


def _batches(n):
    """Events of a batch each, among them status changes of stored inspections and rows without a date."""
    for k in range(n):
        rows = [e | {"seq": 1000 * k + e["seq"]} for e in feed_rows(10, [3 + k, 4], k)]
        yield rows + [{"seq": 1000 * k + 500 + j, "source": "inspection", "inspectionid": h(20 + k + j), "project_sid": h(4), "work_order_uuid": h(10_001), "feed_status": "NEW" if j else "DONE"} for j in range(3)]


def test_outbound_by_cursor(spark, folder, sources, monkeypatch):
    monkeypatch.setattr(S, "COMPACT", 1)  # merged in the second batch
    state_dir, out_dir = os.path.join(folder, "state"), os.path.join(folder, "out")
    state = stored(spark, 60)
    init_state(state_dir, state | {"cr": state["cr"].withColumn("feed_status", F.when(F.col("workorder").endswith("1"), "NEW").otherwise(F.col("feed_status")))}, buckets=4)
    assert send_outbound(spark, state_dir, out_dir) == 0 and send_outbound(spark, state_dir, out_dir) is None
    assert spark.read.parquet(io.version_path(out_dir, 0)).count() == read_state(spark, state_dir)["cr"].where("feed_status = 'NEW'").count() > 0
    apply = make_batch_fn(state_dir, *sources, query="q")
    for k, rows in enumerate(_batches(2)):
        before, cursor = S.last_version(spark, state_dir)[1]["seq"], read_outbound(spark, state_dir)[1]
        assert before == cursor
        apply(events_frame(spark, rows), k)
        now = read_state(spark, state_dir)["cr"]
        assert text(read_outbound(spark, state_dir)[0]) == text(extract_to_send(now))
        # since the cursor: the rows whose last status of this batch is NEW
        last = {e["inspectionid"]: e["feed_status"] for e in rows if e["source"] == "inspection"}
        want = sorted(r["inspectionid"] for r in now.select("inspectionid").collect() if last.get(r["inspectionid"]) == "NEW")
        assert send_outbound(spark, state_dir, out_dir) == k + 1
        got = spark.read.parquet(io.version_path(out_dir, k + 1))
        assert got.columns == OUTBOUND_COLUMNS and sorted(r["inspectionid"] for r in got.collect()) == want


def test_outbound_of_several_parts(spark, folder):
    init_state(folder, stored(spark, 6), buckets=2)
    _, note = S.last_version(spark, folder)
    cr = spark.createDataFrame([], CR_INSPECT_SCHEMA)
    for v, rows in enumerate([[("a", "NEW", 5), ("b", "SENT", 6)], [("c", "NEW", 9), ("d", "", 9), ("e", None, 9)]], 1):
        new = spark.createDataFrame(rows, "inspectionid string, feed_status string, __seq long")
        note["cr"] += S.write_inspections(cr.unionByName(new, allowMissingColumns=True), folder, v)
    changes = spark.createDataFrame([("b", "NEW", 10), ("c", "DONE", 11), ("e", "NEW", 2), (h(0), "NEW", 7)], "inspectionid string, feed_status string, seq long")
    plain = {None: ["a", "c"], 5: ["c"]}
    merged = {None: [h(0), "a", "b"], 5: [h(0), "b"], 7: ["b"], 10: []}
    for parts, want in (([], plain), (S.write_part(changes, folder, "changes", 3), merged)):
        note["changes"] = parts
        for after, ids in want.items():
            assert sorted(r["inspectionid"] for r in S.to_send(spark, folder, note, after).collect()) == ids
    got = {r["inspectionid"]: r["feed_status"] for r in S.inspections(spark, folder, note).where("length(inspectionid) = 1").collect()}
    assert got == {"a": "NEW", "b": "NEW", "c": "DONE", "d": "", "e": None}


def test_outbound_reads_only_the_folder_of_rows_to_send(spark, folder, sources):
    init_state(folder, stored(spark, 20), buckets=2)
    _, note = S.last_version(spark, folder)
    scan = [x for x in S.to_send(spark, folder, note, 7)._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert len(scan) == 1
    assert "PartitionFilters: [isnotnull(outbound" in scan[0] and "GreaterThan(__status_seq,7)" in scan[0]


def test_kept_counters_equal_the_reports_of_the_whole_state(spark, folder, sources, monkeypatch):
    state = stored(spark, 60)
    twice = state["stg"].where("plndcompdate_dttm is null").limit(3)
    state["stg"] = state["stg"].unionByName(twice).unionByName(twice.limit(1).withColumn("workorder_uuid", F.lit(h(99))))
    init_state(folder, state, buckets=16, quality=True)
    apply = make_batch_fn(folder, *sources, query="q")
    read, seen = S.read, []
    monkeypatch.setattr(watch.S, "read", lambda spark, d, note, t, only=None: seen.append((t, only)) or read(spark, d, note, t, only))
    for k, rows in enumerate([None, *_batches(2)]):
        if rows:
            seen.clear()
            apply(events_frame(spark, rows), k)
            assert all(only is not None and len(only) < 16 for t, only in seen if t in ("stg", "queue"))
        now = read_state(spark, folder)
        want = Q.duplicate_keys(now["stg"], ["task_uuid"]).withColumn("t", F.lit("stg")).unionByName(Q.duplicate_keys(now["queue"], ["task_uuid"]).withColumn("t", F.lit("queue")))
        assert sorted(map(tuple, watch.kept_duplicates(spark, folder).collect())) == sorted((r["t"], r["key"], r["n"]) for r in want.collect()) != []
        nulls = Q.null_violations(now["stg"], watch.REQUIRED["stg"], "stg").unionByName(Q.null_violations(now["queue"], watch.REQUIRED["queue"], "queue"))
        assert sorted(map(tuple, watch.kept_nulls(spark, folder).collect())) == sorted(map(tuple, nulls.collect()))


def test_a_state_without_counters_has_no_kept_report(spark, folder):
    init_state(folder, stored(spark, 4), buckets=2)
    with pytest.raises(ValueError):
        watch.kept_nulls(spark, folder)
