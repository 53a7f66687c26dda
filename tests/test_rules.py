"""State-machine tests of the sync rules against row-by-row simulations written here."""

import datetime as dt
import random

from pyspark.sql import functions as F

from culvert.sources.schemas import WOT_STG1_SCHEMA, WOT_STG_SCHEMA
from culvert.streaming import rules as R

D1, D2, S = dt.datetime(2020, 1, 1), dt.datetime(2021, 6, 1), dt.datetime(1900, 1, 1)


def stg_rows(spark, rows):
    """rows: (task, wo, date, status)"""
    full = [(t, w, "title " + t, d, None, 1, s, None) for t, w, d, s in rows]
    return spark.createDataFrame(full, WOT_STG_SCHEMA)


def queue_rows(spark, rows):
    return spark.createDataFrame([(k, "q", None, None, None, s) for k, s in rows], WOT_STG1_SCHEMA)


def wo_feed(spark, rows):
    return spark.createDataFrame(rows, "seq long, wo_uuid string, site_oi long, reqcompdate_dttm timestamp_ntz")


def as_map(df, key="task_uuid", cols=("plndcompdate_dttm", "feed_status")):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


def test_due_date_goldens(spark):
    stg = stg_rows(spark, [("t1", "w57", D1, "NEW"), ("t2", "wsame", D1, "NEW"), ("t3", "wnull", None, "NEW"),
                           ("t4", "w1900", None, "NEW"), ("t5", "wsent", D1, "SENT"), ("t6", "wsent", D2, "SENT"),
                           ("t7", "waba", D1, "NEW")])
    feed = wo_feed(spark, [(1, "w57", 57, D2), (2, "wsame", 58, D1), (3, "wnull", 58, None), (4, "w1900", 58, S),
                           (5, "wsent", 58, D2), (6, "waba", 58, D2), (7, "waba", 58, D1)])
    got = as_map(R.propagate_due_date(stg, feed))
    assert got["t1"] == (D1, "NEW")          # site 57 ignored
    assert got["t2"] == (D1, "NEW")          # same date ignored
    assert got["t3"] == (None, "NEW")        # both null ignored
    assert got["t4"] == (None, "NEW")        # null against 1900-01-01 ignored
    assert got["t5"] == (D2, "UPDATED")      # SENT rows are updated too
    assert got["t6"] == (D2, "SENT")         # same date on that row: untouched
    assert got["t7"] == (D1, "UPDATED")      # A -> B -> A: date A, status UPDATED


def simulate_due(stg, events):
    rows = {t: [w, d, s] for t, w, d, s in stg}
    for seq, wo, site, d in sorted(events):
        if site != 58:
            continue
        for t, r in rows.items():
            if r[0] == wo and (r[1] or S) != (d or S):
                r[1], r[2] = d, "UPDATED"
    return {t: (r[1], r[2]) for t, r in rows.items()}


def test_due_date_matches_row_by_row(spark):
    rnd = random.Random(7)
    pool = [None, D1, D2, S]
    stg, events, seq = [], [], 0
    for w in range(60):
        wo = f"w{w}"
        for k in range(rnd.randint(0, 3)):
            stg.append((f"t{w}_{k}", wo, rnd.choice(pool), rnd.choice([None, "NEW", "SENT", "UPDATED"])))
        for _ in range(rnd.randint(0, 5)):
            seq += rnd.randint(1, 3)
            events.append((seq, wo, rnd.choice([58, 58, 57]), rnd.choice(pool)))
    got = as_map(R.propagate_due_date(stg_rows(spark, stg), wo_feed(spark, events)))
    assert got == simulate_due(stg, events)


def test_transition_goldens(spark):
    df = spark.createDataFrame([(None, "SENT"), ("NEW", " send "), ("SENT", "SEND"), ("   ", "SENT"), ("NEW", "OTHER"),
                                ("OTHER", "Sent")], "o string, n string")
    got = [r[0] for r in df.select(R.is_sent_transition(F.col("o"), F.col("n"))).collect()]
    assert got == [True, True, False, False, False, True]


def simulate_ack(stg, queue, events):
    stg = {t: [w, s] for t, w, s in stg}
    queue = dict(queue)
    for seq, key, old, new in sorted(events):
        if key not in queue:
            continue
        norm = lambda x: (x.strip().upper() or None) if x is not None else None
        if norm(new) in ("SEND", "SENT") and (old is None or (norm(old) is not None and norm(old) not in ("SEND", "SENT"))):
            for r in stg.values():
                if r[0] == key:
                    r[1] = "SENT"
            del queue[key]
        else:
            queue[key] = new
    return {t: r[1] for t, r in stg.items()}, queue


def test_acknowledge_matches_row_by_row(spark):
    rnd = random.Random(11)
    statuses = ["NEW", "SENT", " send ", "Sent", "OTHER", "   ", "UPDATED"]
    queue = {f"w{i}": rnd.choice(["NEW", "UPDATED", "OTHER"]) for i in range(40)}
    stg = [(f"t{i}_{k}", f"w{i}", rnd.choice(["NEW", "UPDATED", None])) for i in range(45) for k in range(2)]
    events, cur, seq = [], dict(queue), 0
    for _ in range(120):
        key = rnd.choice(list(cur)) if cur else None
        if key is None:
            break
        new = rnd.choice(statuses)
        seq += 1
        events.append((seq, key, cur[key], new))
        norm = lambda x: (x.strip().upper() or None) if x is not None else None
        old = cur[key]
        if norm(new) in ("SEND", "SENT") and (old is None or (norm(old) is not None and norm(old) not in ("SEND", "SENT"))):
            del cur[key]
        else:
            cur[key] = new
    want_stg, want_q = simulate_ack(stg, queue, events)
    s_df = stg_rows(spark, [(t, w, None, s) for t, w, s in stg])
    q_df = queue_rows(spark, list(queue.items()))
    f_df = spark.createDataFrame(events, "seq long, queue_uuid string, old_status string, new_status string")
    got_s, got_q = R.acknowledge_sent(s_df, q_df, f_df)
    assert {r.task_uuid: r.feed_status for r in got_s.collect()} == want_stg
    assert {r.task_uuid: r.feed_status for r in got_q.collect()} == want_q


def test_enqueue_one_row_per_work_order_and_no_refresh(spark):
    stg = stg_rows(spark, [("tb", "w1", D1, "NEW"), ("ta", "w1", D2, "UPDATED"), ("tc", "w2", D1, "NEW"),
                           ("td", "w3", D1, "SENT"), ("te", None, D1, "NEW")])
    queue = queue_rows(spark, [("w2", "OLD")])
    q, bad = R.enqueue_work_orders(queue, stg)
    got = {r.task_uuid: (r.wotasktitle, r.feed_status) for r in q.collect()}
    assert got == {"w1": ("title ta", "UPDATED"), "w2": ("q", "OLD")}
    assert [r.task_uuid for r in bad.collect()] == ["te"]


def test_enqueue_changed_rows_only_first_by_seq(spark):
    stg = stg_rows(spark, [("ta", "w1", D1, "UPDATED"), ("tb", "w1", D2, "UPDATED"), ("tc", "w2", D1, "UPDATED")])
    stg = stg.withColumn(R.CHG, F.when(F.col("task_uuid") == "ta", 9).when(F.col("task_uuid") == "tb", 3)
                         .otherwise(F.lit(None)).cast("long"))
    q, _ = R.enqueue_work_orders(queue_rows(spark, []), stg)
    assert {r.task_uuid: r.plndcompdate_dttm for r in q.collect()} == {"w1": D2}


def test_reflag_needs_both_keys_and_skips_updated(spark):
    tid, wid = "0123456789abcdef0123456789abcdef", "fedcba9876543210fedcba9876543210"
    stg = stg_rows(spark, [(tid, wid, D1, "NEW"), (tid, "other", D1, "NEW"), ("x" * 32, wid, D1, None)])
    dashed = lambda h: f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"
    cr = spark.createDataFrame([(dashed(tid), dashed(wid), "NEW", 5), ("zz-not-hex", dashed(wid), "NEW", 6),
                                (dashed("x" * 32), dashed(wid), "SENT", 7)],
                               "project_sid string, work_order_uuid string, feed_status string, __seq long")
    out, bad = R.reflag_tasks(stg, cr)
    got = {(r.task_uuid, r.workorder_uuid): (r.feed_status, r[R.CHG]) for r in out.collect()}
    assert got[(tid, wid)] == ("UPDATED", 5)
    assert got[(tid, "other")] == ("NEW", None)
    assert got[("x" * 32, wid)] == (None, None)
    assert [r.project_sid for r in bad.collect()] == ["zz-not-hex"]


def test_backfill_last_wins_and_only_if_null(spark):
    cr = spark.createDataFrame([("WO1.1", None, "<b>x</b>"), ("WO1.1", "old", "y"), ("WO2.1", "keep", "z")],
                               "workorder string, inspection_sid string, additional_information string")
    vf = spark.createDataFrame([(1, "WO1.1", "a"), (5, "WO1.1", "b"), (3, None, "c")],
                               "seq long, workorder string, inspection_sid string")
    got = sorted((r.workorder, r.inspection_sid, r.additional_information) for r in R.backfill_sid(cr, vf).collect())
    assert got == [("WO1.1", "b", "x"), ("WO1.1", "b", "y"), ("WO2.1", "keep", "z")]
    got2 = sorted((r.workorder, r.inspection_sid) for r in R.backfill_sid(cr, vf, overwrite=False).collect())
    assert got2 == [("WO1.1", "b"), ("WO1.1", "old"), ("WO2.1", "keep")]


def test_old_status_from_previous_event(spark):
    q = queue_rows(spark, [("w1", "NEW"), ("w2", "SENT")])
    f = spark.createDataFrame([(1, "w1", "OTHER"), (2, "w1", "SENT"), (3, "w2", "SEND"), (4, "w3", "SENT")],
                              "seq long, queue_uuid string, new_status string")
    got = {r.seq: r.old_status for r in R.with_old_status(f, q).collect()}
    assert got == {1: "NEW", 2: "OTHER", 3: "SENT", 4: None}
    keys = sorted(r.key for r in R.sent_transitions(f, q).collect())
    assert keys == ["w1"]      # w2 was already SENT; w3 is not queued


def test_reflag_checks_ids_after_the_joins(spark):
    stg = stg_rows(spark, [("aa", "bb", D1, "NEW"), ("", "bb", D1, "NEW"), ("zz", "bb", D1, "NEW")])
    ids = spark.createDataFrame([("AA", 1), ("-", 2), (None, 3), ("ZZ", 4)], "project_sid string, n int")
    wos = spark.createDataFrame([(n, "BB", n + 10) for n in range(1, 5)], "n int, work_order_uuid string, __seq long")
    cr = ids.join(wos, "n").withColumn("feed_status", F.lit("NEW"))
    out, bad = R.reflag_tasks(stg, cr)
    assert as_map(out.drop(R.CHG_DATE), cols=("feed_status", R.CHG)) == {"aa": ("UPDATED", 11), "": ("UPDATED", 12), "zz": ("NEW", None)}
    assert [r.project_sid for r in bad.collect()] == ["ZZ"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and ("RLIKE" in line or "upper" in line) for line in plan.split("\n"))
