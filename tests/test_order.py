"""The cascade follows ``seq``: equal to a row-by-row simulation, for any split of the feed."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from culvert.sources.lookups import all_lookups
from culvert.sources.schemas import CR_INSPECT_SCHEMA, FEED_SCHEMA, SOURCE_SCHEMAS, WOT_STG1_SCHEMA, WOT_STG_SCHEMA
from culvert.streaming import rules as R

DATES = [None, dt.datetime(1900, 1, 1), dt.datetime(2020, 1, 1), dt.datetime(2021, 6, 1), dt.datetime(2022, 3, 3)]
FIELDS = [f.name for f in FEED_SCHEMA.fields]


@pytest.fixture
def sources(spark):
    """Empty source tables and the lookups: these feeds bring no histories."""
    return {n: spark.createDataFrame([], t) for n, t in SOURCE_SCHEMAS.items()}, all_lookups(spark)


def h(x):
    return f"{x:032x}"


def norm(x):
    return (x.strip().upper() or None) if x is not None else None


def s(d):
    return d or DATES[1]


def simulate(stg, queue, events):
    """One event after the other, one row after the other, as the triggers fire."""
    stg = {t: dict(r) for t, r in stg.items()}
    queue = {k: dict(r) for k, r in queue.items()}

    def fire(r):
        if r["st"] in ("NEW", "UPDATED") and r["wo"] is not None and r["wo"] not in queue:
            queue[r["wo"]] = {k: r[k] for k in ("title", "d", "start", "cls", "st")}

    for e in sorted(events, key=lambda e: e["seq"]):
        if e["source"] == "queue" and e["queue_uuid"] in queue:
            old = norm(e["old_status"])
            if norm(e["new_status"]) in ("SEND", "SENT") and (e["old_status"] is None or (old is not None and old not in ("SEND", "SENT"))):
                for r in stg.values():
                    if r["wo"] == e["queue_uuid"]:
                        r["st"] = "SENT"
                del queue[e["queue_uuid"]]
            else:
                queue[e["queue_uuid"]]["st"] = e["new_status"]
        elif e["source"] == "workorder" and e["site_oi"] == 58:
            for t in sorted(stg):
                r = stg[t]
                if r["wo"] == e["wo_uuid"] and s(r["d"]) != s(e["reqcompdate_dttm"]):
                    r.update(d=e["reqcompdate_dttm"], st="UPDATED")
                    fire(r)
        elif e["source"] == "inspection" and e["feed_status"] == "NEW" and e["project_sid"]:
            r = stg.get(e["project_sid"])
            if r and r["wo"] == e["work_order_uuid"] and r["st"] != "UPDATED":
                r["st"] = "UPDATED"
                fire(r)
        elif e["source"] == "staging":
            stg[e["task_uuid"]] = r = {"wo": e["workorder_uuid"], "title": e["wotasktitle"], "d": e["plndcompdate_dttm"], "start": e["plndstrtdate_dttm"], "cls": e["workclassifi_oi"], "st": e["feed_status"]}
            fire(r)
    return stg, queue


def world(seed):
    r = random.Random(seed)
    stg, queue, events = {}, {}, []
    for w in range(14):
        for k in range(r.randint(0, 3)):
            stg[h(w * 10 + k)] = {"wo": h(900 + w), "title": f"t{w}{k}", "d": r.choice(DATES), "start": None, "cls": k, "st": r.choice([None, "NEW", "SENT", "UPDATED"])}
        if r.random() < 0.4:
            queue[h(900 + w)] = {"title": "q", "d": None, "start": None, "cls": None, "st": "NEW"}
    for i in range(90):
        w = r.randrange(15)
        e = dict.fromkeys(FIELDS) | {"seq": i, "source": r.choice(["queue", "workorder", "inspection", "staging"])}
        if e["source"] == "queue":
            e.update(queue_uuid=h(900 + w), old_status=r.choice([None, "NEW", "SENT", "  "]), new_status=r.choice(["SENT", " send ", "OTHER", "NEW"]))
        elif e["source"] == "workorder":
            e.update(wo_uuid=h(900 + w), site_oi=r.choice([58, 58, 57]), reqcompdate_dttm=r.choice(DATES))
        elif e["source"] == "inspection":
            e.update(project_sid=h(w * 10 + r.randrange(3)), work_order_uuid=h(900 + w), feed_status=r.choice(["NEW", "NEW", "SENT"]))
        else:
            t = h(w * 10 + r.randrange(4))
            e.update(task_uuid=t, workorder_uuid=h(900 + w), wotasktitle=f"s{i}", plndcompdate_dttm=r.choice(DATES), workclassifi_oi=i, feed_status=r.choice(["NEW", "UPDATED", "SENT", None]))
        events.append(e)
    return stg, queue, events


@pytest.mark.parametrize("seed,cuts", [(1, 0), (2, 2), (3, 1), (4, 0), (5, 0)])
def test_cascade_equals_row_by_row_for_any_split(spark, sources, seed, cuts):
    stg, queue, events = world(seed)
    frame = lambda rows: spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in rows], FEED_SCHEMA)
    state = {
        "stg": spark.createDataFrame([(t, r["wo"], r["title"], r["d"], r["start"], r["cls"], r["st"], None) for t, r in stg.items()], WOT_STG_SCHEMA),
        "queue": spark.createDataFrame([(k, r["title"], r["d"], r["start"], r["cls"], r["st"]) for k, r in queue.items()], WOT_STG1_SCHEMA),
        "cr": spark.createDataFrame([], CR_INSPECT_SCHEMA),
    }
    at = sorted(random.Random(seed).sample(range(1, len(events)), cuts))
    for a, b in zip([0, *at], [*at, len(events)]):
        state = R.run_cascade(state, frame(events[a:b]), *sources)
        state = {k: R.materialise(state[k]) for k in ("stg", "queue", "cr")}
    want_stg, want_queue = simulate(stg, queue, events)
    got = {r.task_uuid: (r.workorder_uuid, r.wotasktitle, r.plndcompdate_dttm, r.workclassifi_oi, r.feed_status) for r in state["stg"].collect()}
    assert got == {t: (r["wo"], r["title"], r["d"], r["cls"], r["st"]) for t, r in want_stg.items()}
    got = {r.task_uuid: (r.wotasktitle, r.plndcompdate_dttm, r.workclassifi_oi, r.feed_status) for r in state["queue"].collect()}
    assert got == {k: (r["title"], r["d"], r["cls"], r["st"]) for k, r in want_queue.items()}


def test_null_ids_are_no_bad_hex_and_null_work_orders_go_to_quarantine(spark, sources):
    rows = [dict.fromkeys(FIELDS) | e for e in (
        {"seq": 1, "source": "inspection", "feed_status": "NEW", "project_sid": None, "work_order_uuid": h(1)},
        {"seq": 2, "source": "inspection", "feed_status": "NEW", "project_sid": "zz", "work_order_uuid": h(1)},
        {"seq": 3, "source": "staging", "task_uuid": h(5), "workorder_uuid": None, "feed_status": "NEW", "wotasktitle": "x"},
        {"seq": 4, "source": "inspection", "feed_status": "NEW", "inspectionid": "i1"})]
    empty = lambda schema: spark.createDataFrame([], schema)
    cr = spark.createDataFrame([("i1", "SENT"), ("i2", "SENT")], "inspectionid string, feed_status string")
    cr = empty(CR_INSPECT_SCHEMA).unionByName(cr, allowMissingColumns=True)
    out = R.run_cascade({"stg": empty(WOT_STG_SCHEMA), "queue": empty(WOT_STG1_SCHEMA), "cr": cr}, spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in rows], FEED_SCHEMA), *sources)
    assert [r.seq for r in out["quarantine_ids"].collect()] == [2]
    assert [r.task_uuid for r in out["quarantine_queue"].collect()] == [h(5)]
    assert out["queue"].count() == 0 and out["stg"].count() == 1
    assert {r.inspectionid: r.feed_status for r in out["cr"].collect()} == {"i1": "NEW", "i2": "SENT"}


def test_staging_rows_without_task_id_get_one(spark, sources):
    stg, queue, events = world(4)
    events = [e for e in events if e["seq"] < 40] + [dict.fromkeys(FIELDS) | {"seq": 40 + i, "source": "staging", "workorder_uuid": h(990 + i % 3), "wotasktitle": f"n{i}", "feed_status": ["NEW", "SENT"][i % 2]} for i in range(6)]
    lacking = [e for e in events if e["source"] == "staging" and (e["task_uuid"] is None or e["seq"] % 3 == 0)]
    for e in lacking:
        e["task_uuid"] = None
    assert len(lacking) > 6
    frame = spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in events], FEED_SCHEMA)
    state = {
        "stg": spark.createDataFrame([(t, r["wo"], r["title"], r["d"], r["start"], r["cls"], r["st"], None) for t, r in stg.items()], WOT_STG_SCHEMA),
        "queue": spark.createDataFrame([(k, r["title"], r["d"], r["start"], r["cls"], r["st"]) for k, r in queue.items()], WOT_STG1_SCHEMA),
        "cr": spark.createDataFrame([], CR_INSPECT_SCHEMA),
    }
    out = R.run_cascade(state, frame, *sources)
    for e in lacking:
        e["task_uuid"] = hashlib.md5(f"staging-{e['seq']}".encode()).hexdigest()
    want_stg, want_queue = simulate(stg, queue, events)
    got = {r.task_uuid: (r.workorder_uuid, r.wotasktitle, r.plndcompdate_dttm, r.feed_status) for r in out["stg"].collect()}
    assert got == {t: (r["wo"], r["title"], r["d"], r["st"]) for t, r in want_stg.items()}
    got = {r.task_uuid: (r.wotasktitle, r.plndcompdate_dttm, r.feed_status) for r in out["queue"].collect()}
    assert got == {k: (r["title"], r["d"], r["st"]) for k, r in want_queue.items()}


def test_many_events_of_one_work_order(spark, sources):
    kinds = [{"source": "staging", "task_uuid": h(1), "workorder_uuid": h(9), "feed_status": "NEW"}, {"source": "workorder", "wo_uuid": h(9), "site_oi": 58},
             {"source": "queue", "queue_uuid": h(9), "old_status": "NEW", "new_status": "SENT"}, {"source": "staging", "task_uuid": h(2), "workorder_uuid": h(9), "feed_status": "SENT"}]
    events = [dict.fromkeys(FIELDS) | kinds[i % 4] | {"seq": i, "wotasktitle": f"t{i}", "reqcompdate_dttm": DATES[i // 4 % 5]} for i in range(402)]
    empty = {t: spark.createDataFrame([], x) for t, x in (("stg", WOT_STG_SCHEMA), ("queue", WOT_STG1_SCHEMA), ("cr", CR_INSPECT_SCHEMA))}
    out = R.run_cascade(empty, spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in events], FEED_SCHEMA), *sources)
    want_stg, want_queue = simulate({}, {}, events)
    assert {r.task_uuid: (r.wotasktitle, r.plndcompdate_dttm, r.feed_status) for r in out["stg"].collect()} == {t: (r["title"], r["d"], r["st"]) for t, r in want_stg.items()}
    assert {r.task_uuid: (r.wotasktitle, r.feed_status) for r in out["queue"].collect()} == {k: (r["title"], r["st"]) for k, r in want_queue.items()}


def _check(spark, sources, stg, queue, events):
    state = {
        "stg": spark.createDataFrame([(t, r["wo"], r["title"], r["d"], r["start"], r["cls"], r["st"], None) for t, r in stg.items()], WOT_STG_SCHEMA),
        "queue": spark.createDataFrame([(k, r["title"], r["d"], r["start"], r["cls"], r["st"]) for k, r in queue.items()], WOT_STG1_SCHEMA),
        "cr": spark.createDataFrame([], CR_INSPECT_SCHEMA),
    }
    out = R.run_cascade(state, spark.createDataFrame([tuple(e[f] for f in FIELDS) for e in events], FEED_SCHEMA), *sources)
    want_stg, want_queue = simulate(stg, queue, events)
    got = {r.task_uuid: (r.workorder_uuid, r.wotasktitle, r.plndcompdate_dttm, r.workclassifi_oi, r.feed_status) for r in out["stg"].collect()}
    assert got == {t: (r["wo"], r["title"], r["d"], r["cls"], r["st"]) for t, r in want_stg.items()}
    got = {r.task_uuid: (r.wotasktitle, r.plndcompdate_dttm, r.workclassifi_oi, r.feed_status) for r in out["queue"].collect()}
    assert got == {k: (r["title"], r["d"], r["cls"], r["st"]) for k, r in want_queue.items()}


def test_sixty_random_feeds_at_once(spark, sources):
    """Work orders never meet, so many random feeds are one batch: 840 work orders, 5400 events."""
    ids = ["task_uuid", "workorder_uuid", "queue_uuid", "wo_uuid", "project_sid", "work_order_uuid"]
    all_stg, all_queue, all_events = {}, {}, []
    for seed in range(60):
        move = lambda x: x and f"{int(x, 16) + seed * 100_000:032x}"  # noqa: B023, E731
        stg, queue, events = world(100 + seed)
        all_stg |= {move(t): r | {"wo": move(r["wo"])} for t, r in stg.items()}
        all_queue |= {move(k): r for k, r in queue.items()}
        all_events += [e | {k: move(e[k]) for k in ids} | {"seq": e["seq"] * 60 + seed} for e in events]
    _check(spark, sources, all_stg, all_queue, all_events)


def test_a_work_order_with_a_third_of_all_events(spark, sources):
    r = random.Random(11)
    stg, queue, events = world(12)
    hot = h(900 + 3)
    for k in range(300):
        stg[h(50_000 + k)] = {"wo": hot, "title": f"hot{k}", "d": r.choice(DATES), "start": None, "cls": k, "st": r.choice([None, "NEW", "SENT", "UPDATED"])}
    for i in range(1500):
        e = dict.fromkeys(FIELDS) | {"seq": 90 + i, "source": r.choice(["queue", "workorder", "inspection", "staging"])}
        t = h(50_000 + r.randrange(320))
        e |= {"queue": {"queue_uuid": hot, "old_status": r.choice([None, "NEW"]), "new_status": r.choice(["SENT", "OTHER", "NEW"])},
              "workorder": {"wo_uuid": hot, "site_oi": 58, "reqcompdate_dttm": r.choice(DATES)},
              "inspection": {"project_sid": t, "work_order_uuid": hot, "feed_status": "NEW"},
              "staging": {"task_uuid": t, "workorder_uuid": hot, "wotasktitle": f"s{i}", "plndcompdate_dttm": r.choice(DATES), "workclassifi_oi": i, "feed_status": r.choice(["NEW", "SENT", None])}}[e["source"]]
        events.append(e)
    _check(spark, sources, stg, queue, events)


def test_a_hot_key_is_spread_and_looked_along(spark):
    from culvert.operators.changes import previous_value
    from culvert.operators.scan import PART, along
    r = random.Random(4)
    rows = [("hot" if i % 3 else (None if i % 5 == 0 else f"k{i % 7}"), i, r.choice(["a", "b", None])) for i in range(4000)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "key string, seq long, v string").repartition(5)
    want, last, seen = {}, {}, {}
    for k, i, v in rows:
        want[i] = (seen.get(k, "first"), last.get(k))
        seen[k] = v
        last[k] = v if v is not None else last.get(k)
    got = previous_value(df, "key", "seq", "v", seed=F.lit("first"))
    assert {x["seq"]: x["prev_v"] for x in got.collect()} == {i: a for i, (a, _) in want.items()}
    both = along(df, ["key"], ["seq"], before={"b": F.col("v")}, after={"a": F.col("v")}).collect()
    assert {x["seq"]: x["b"] for x in both} == {i: b for i, (_, b) in want.items()}
    following, nxt = {}, {}
    for k, i, v in reversed(rows):
        nxt[i] = following.get(k)
        following[k] = v if v is not None else following.get(k)
    assert {x["seq"]: x["a"] for x in both} == nxt
    # every window is within one range partition, so the hot key is in all of them
    plan = along(df, ["key"], ["seq"], before={"b": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    assert f"[{PART}" in plan.replace("(", "[") and "Window" in plan
