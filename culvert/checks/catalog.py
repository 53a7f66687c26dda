"""

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the tables derived from the
driver's parquet (whole tables, no sampling). The matching DuckDB statement is in
``checks.oracle``.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import ids as I
from ..functions.text import clean_longdesc, strip_html
from ..operators import classify as K
from ..operators import quality as Q
from ..operators.changes import changed_keys, first_per_key, last_per_key
from ..operators.joins import code_join, delete_by_keys, not_present, only_keys
from ..plans.inspections import unified_inspections
from ..plans.outbound import extract_to_send, register_views
from ..plans.spine import task_dim
from ..session import checkpoint_dir
from ..sources import fixtures as FX
from ..sources.lookups import all_lookups
from ..sources.schemas import CR_INSPECT_COLUMNS, CR_INSPECT_SCHEMA, SOURCE_NAMES
from ..streaming import rules as R
from ..streaming.sync import init_state, make_batch_fn, read_outbound, read_state, stream_sync


class Ctx:
    """Derived tables for one (spark, sf_dir); DataFrames are lazy, nothing is collected."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self._src = self._lk = self._state = self._feed = None

    # built on first use: each query only pays for the tables it reads
    @property
    def src(self) -> dict[str, DataFrame]:
        if self._src is None:
            self._src = FX.derive_sources(self.spark, self.sf)
        return self._src

    @property
    def lk(self):
        if self._lk is None:
            self._lk = all_lookups(self.spark)
        return self._lk

    @property
    def stg(self) -> DataFrame:
        if self._state is None:
            self._state = FX.derive_state(self.spark, self.sf)
        return self._state["wot_stg"]

    @property
    def queue(self) -> DataFrame:
        if self._state is None:
            self._state = FX.derive_state(self.spark, self.sf)
        return self._state["wot_stg1"]

    @property
    def feed(self) -> DataFrame:
        if self._feed is None:
            self._feed = FX.derive_feed(self.spark, self.sf)
        return self._feed

    def unified(self, stored: bool = False) -> DataFrame:
        return unified_inspections(self.src, self.lk, stored=stored)

    def part(self, source: str, cols: list[str]) -> DataFrame:
        return R.feed_part(self.feed, source, cols)

    def empty_cr(self) -> DataFrame:
        return self.spark.createDataFrame([], CR_INSPECT_SCHEMA)

    def collected(self) -> DataFrame:
        hf = self.part("history", ["history_oi"])
        base = self.spark.createDataFrame([], "inspectionid string")
        return R.collect_inspections(base, hf, self.src, self.lk)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


HIST = "epdrfacilityworkhistoryoi"


# ------------------------------------------------------------------ A: scans, lookups, sinks

@_q
def src_scan_counts(c: Ctx):
    parts = [c.src[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n in SOURCE_NAMES]
    return reduce(DataFrame.unionByName, parts)


@_q
def lookup_mh_use(c: Ctx):
    rows = (c.src["epdrmanhole"].select(F.col("manholeid").alias("src_id"), "wwtype")
            .unionByName(c.src["epdrcatchbasin"].select(F.col("catchbasinid").alias("src_id"), "wwtype")))
    return code_join(rows, F.col("wwtype"), c.lk["mh_use"], "mh_use")


@_q
def lookup_shape(c: Ctx):
    return code_join(c.src["epdrpipe"].select("epdrpipeoi", "shape"), F.col("shape"), c.lk["shape"], "shape_code")


@_q
def lookup_material(c: Ctx):
    return code_join(c.src["epdrserviceconnect"].select("wass_appid", "pipetype"), F.col("pipetype"),
                     c.lk["material"], "material_code")


@_q
def lookup_wall(c: Ctx):
    df = c.src["epdrmanhole"].select("manholeid", "cone", "bench", "channel")
    for p in ("cone", "bench", "channel"):
        df = code_join(df, F.col(p), c.lk["wall"], f"{p}_code")
    return df


@_q
def lookup_listing(c: Ctx):
    mats = (c.src["epdrpipe"].select(F.col("material").alias("raw"))
            .unionByName(c.src["epdrserviceconnect"].select(F.col("pipetype").alias("raw"))))
    m = code_join(mats, F.col("raw"), c.lk["material"], "code").select("code", C.norm_key(F.col("raw")).alias("src_text"))
    return (m.groupBy("code", "src_text").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("code").asc_nulls_last(), F.col("src_text").asc_nulls_last()))


@_q
def view_registered(c: Ctx):
    register_views(c.spark, c.src)
    return c.spark.sql("SELECT inspection_type, count(*) AS n FROM inspections_v GROUP BY inspection_type")


@_q
def outbound_extract(c: Ctx):
    return extract_to_send(c.collected().select(*CR_INSPECT_COLUMNS))


def feed_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming replay of the whole feed (several micro-batches), then the
    final staging state: the same as one batch gives, as events follow ``seq``."""
    c = Ctx(spark, sf_dir)
    base = os.path.join(checkpoint_dir(spark), f"replay-{uuid.uuid4().hex}")
    feed_dir, state_dir, ckpt = (os.path.join(base, x) for x in ("feed", "state", "ckpt"))
    from ..sources.io import write_feed
    write_feed(c.feed, feed_dir, files=4)
    init_state(state_dir, {"stg": c.stg, "queue": c.queue, "cr": c.empty_cr()})
    q = stream_sync(spark, feed_dir, state_dir, ckpt, c.src, c.lk, max_files_per_trigger=1)
    q.awaitTermination()
    return read_state(spark, state_dir)["stg"]


@_q
def outbound_since(c: Ctx):
    """What is to be sent after the first half of the history feed was sent: two batches, the extract beyond the first one's cursor."""
    base = os.path.join(checkpoint_dir(c.spark), f"outbound-{uuid.uuid4().hex}")
    init_state(base, {"stg": c.stg, "queue": c.queue, "cr": c.empty_cr()})
    apply = make_batch_fn(base, c.src, c.lk, query="outbound")
    feed = c.feed.where(F.col("source") == "history")
    half = (feed.agg(F.max("seq")).first()[0] or 0) // 2
    apply(feed.where(F.col("seq") <= half), 0)
    cursor = read_outbound(c.spark, base)[1]
    apply(feed.where(F.col("seq") > half), 1)
    return read_outbound(c.spark, base, cursor)[0]


@_q
def view_outbound(c: Ctx):
    register_views(c.spark, c.src, c.collected().select(*CR_INSPECT_COLUMNS))
    return c.spark.sql("SELECT inspection_type, count(*) AS n FROM cr_inspect_to_send_v GROUP BY inspection_type")


# ------------------------------------------------------------------ B: projections, predicates

@_q
def layout_cast(c: Ctx):
    u = c.unified()
    return u.groupBy("inspection_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.length("work_order_task_title")).alias("max_title_len"),
        F.count("pip_type").alias("n_pip_type"), F.count("access_type").alias("n_access_type"),
        F.count("shape").alias("n_shape"), F.count("height").alias("n_height"),
        F.count("size").alias("n_size"), F.count("wall_bysize").alias("n_wall_bysize"))


def _fac_unk(c: Ctx) -> DataFrame:
    f = c.src["epdrdrainfacility"].select("epdrdrainagefacilityoi", "facilitytype", "epdrunknownf_oi")
    u = c.src["epdrunknfac"]
    return f.join(u, f["epdrunknownf_oi"] == u["epdrunknownfacilityoi"], "left").drop(
        "epdrunknownf_oi", "epdrunknownfacilityoi")


@_q
def classify_kinds(c: Ctx):
    return K.classify(_fac_unk(c)).drop("branches")


@_q
def access_type(c: Ctx):
    df = _fac_unk(c)
    return df.select("epdrdrainagefacilityoi", K.access_type(F.col("facilitytype"), F.col("unknfactype")).alias("access_type"))


@_q
def pick_by_kind(c: Ctx):
    return (c.unified().where(F.col("inspection_type") == "MACP")
            .select(HIST, "facility_type", "unknown_type", "street", "drainage_area", "wall_bysize", "wall_depth",
                    "elevation", "frame_material", "cover_shape"))


@_q
def wall_bench_channel(c: Ctx):
    return (c.unified().where(F.col("inspection_type") == "MACP")
            .select(HIST, "facility_type", "unknown_type", "wall_material", "bench_material", "channel_material"))


@_q
def segment_refs(c: Ctx):
    return c.unified().select(HIST, "inspection_type", "pipe_segment_reference", "lateral_segment_reference")


@_q
def null_safe_changed(c: Ctx):
    wo = c.src["workorders"].select(F.col("uuid").alias("wo_uuid"), "reqcompdate_dttm")
    j = c.stg.join(wo, c.stg["workorder_uuid"] == wo["wo_uuid"], "inner")
    return j.select("task_uuid", C.null_safe_changed(F.col("plndcompdate_dttm"), F.col("reqcompdate_dttm"),
                                                     F.lit(R.DATE_SENTINEL).cast("timestamp_ntz")).alias("changed"))


@_q
def status_transition(c: Ctx):
    qf = c.part("queue", ["queue_uuid", "old_status", "new_status"])
    return qf.select("seq", "queue_uuid", "old_status", "new_status",
                     R.is_sent_transition(F.col("old_status"), F.col("new_status")).alias("is_transition"))


# ------------------------------------------------------------------ C: joins

@_q
def spine_inner(c: Ctx):
    t = c.src["workordertask"].select("workordertaskoi", "tasknumber")
    h = c.src["epdrfacworkhistory"].select(HIST, "wotask_oi")
    return h.join(t, h["wotask_oi"] == t["workordertaskoi"], "inner").select(HIST, "workordertaskoi", "tasknumber")


@_q
def spine_left(c: Ctx):
    return task_dim(c.src).select(F.col("__task_key").alias("workordertaskoi"), "work_orders_number",
                                  "asset_number", "work_order_uuid")


@_q
def spine_facility(c: Ctx):
    f = _fac_unk(c).where(F.col("facilitytype").isin(1, 2, 4, 8, 10))
    h = c.src["epdrfacworkhistory"].select(HIST, "epdrfacility_oi")
    j = h.join(f, h["epdrfacility_oi"] == f["epdrdrainagefacilityoi"], "inner")
    ft, ut = F.col("facilitytype"), F.col("unknfactype")
    return (j.where(K.is_macp(ft, ut) | K.is_pacp(ft, ut) | K.is_lacp(ft, ut))
            .select(HIST, F.col("epdrdrainagefacilityoi").alias("facilityoi"), "facilitytype", "unknfactype"))


@_q
def branch_attach(c: Ctx):
    return c.unified().select("facilityoi", "inspection_type", "street", "drainage_area", "total_length").distinct()


@_q
def code_join_shape(c: Ctx):
    return (c.unified().where(F.col("inspection_type").isin("MACP", "PACP"))
            .select(HIST, "inspection_type", "shape", "cover_shape"))


@_q
def code_join_material(c: Ctx):
    return (c.unified().where(F.col("inspection_type").isin("PACP", "LACP"))
            .select(HIST, "inspection_type", "material"))


@_q
def mh_use_code(c: Ctx):
    return c.unified().where(F.col("inspection_type") == "MACP").select(HIST, "facility_type", "unknown_type", "mh_use")


@_q
def clean_longdesc_q(c: Ctx):
    t = c.src["workordertask"]
    return t.select("workordertaskoi", clean_longdesc(F.col("longdescript")).alias("additional_information"))


@_q
def anti_join_new(c: Ctx):
    wos = c.stg.select("workorder_uuid").where(F.col("workorder_uuid").isNotNull()).distinct()
    return not_present(wos, c.queue.select(F.col("task_uuid").alias("__q")), [("workorder_uuid", "__q")])


@_q
def semi_join_keys(c: Ctx):
    keys = changed_keys(c.part("history", ["history_oi"]), "history_oi")
    return only_keys(c.src["epdrfacworkhistory"].select(HIST, "wotask_oi"), keys, HIST, "history_oi")


@_q
def update_by_key(c: Ctx):
    from ..operators.joins import update_by_key as upd
    keys = c.queue.select(F.col("task_uuid").alias("key")).distinct()
    out = upd(c.stg, keys, [("workorder_uuid", "key")], {"feed_status": F.lit("SENT")})
    return out.select("task_uuid", "workorder_uuid", "feed_status")


@_q
def update_by_two_keys(c: Ctx):
    u = c.unified().select(I.canonical_uuid(F.col("work_order_task_uuid")).alias("project_sid"),
                           I.canonical_uuid(F.col("work_order_uuid")).alias("work_order_uuid"),
                           F.lit("NEW").alias("feed_status"))
    stg, _ = R.reflag_tasks(c.stg, u)
    return stg.select("task_uuid", "workorder_uuid", "feed_status")


@_q
def delete_by_keys_q(c: Ctx):
    qf = c.part("queue", ["queue_uuid", "old_status", "new_status"])
    keys = R.sent_transitions(qf, c.queue)
    return delete_by_keys(c.queue, keys, "task_uuid", "key")


# ------------------------------------------------------------------ D, E: key sets and orderings

@_q
def changed_keys_q(c: Ctx):
    return changed_keys(c.part("history", ["history_oi"]), "history_oi")


@_q
def first_per_key_q(c: Ctx):
    cand = c.stg.where(F.col("feed_status").isin("NEW", "UPDATED"))
    return first_per_key(cand, "workorder_uuid", ["task_uuid"], ["task_uuid"])


@_q
def last_per_key_q(c: Ctx):
    return last_per_key(c.part("vendor", ["workorder", "inspection_sid"]).where(F.col("workorder").isNotNull()),
                        "workorder", "seq", ["inspection_sid"])


@_q
def previous_value_q(c: Ctx):
    qf = c.part("queue", ["queue_uuid", "new_status"])
    return R.with_old_status(qf, c.queue).select("seq", "queue_uuid", "new_status",
                                                 F.col("old_status").alias("prev_status"))


# ------------------------------------------------------------------ G: the view

@_q
def unified_q(c: Ctx):
    return c.unified(stored=True)


# ------------------------------------------------------------------ H: scalar functions

def strip_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = FX.read_table(spark, sf_dir, "pages").select("page_id", "html")
    return p.select("page_id", strip_html(F.col("html")).alias("html_clean"))


def strip_html_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = FX.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", strip_html(F.col("text")).alias("text_clean"))


@_q
def canonical_uuid(c: Ctx):
    h = c.src["epdrfacworkhistory"]
    return h.select(HIST, F.col("uuid").alias("dr_uuid"), I.canonical_uuid(F.col("uuid")).alias("canonical"))


@_q
def compact_uuid(c: Ctx):
    h = c.src["epdrfacworkhistory"]
    comp = I.compact_uuid(I.canonical_uuid(F.col("uuid")))
    return h.select(HIST, comp.alias("compact"), I.raw_hex(I.hex_raw(comp)).alias("roundtrip"),
                    I.is_valid_hex(F.col("uuid")).alias("valid"))


@_q
def manhole_number(c: Ctx):
    return c.unified().where(F.col("inspection_type") == "MACP").select(HIST, "facility_id", "manhole_number")


@_q
def pipe_base_ref(c: Ctx):
    p = c.src["epdrpipe"]
    return p.select("epdrpipeoi", "pipeid", I.pipe_base_ref(F.col("pipeid")).alias("base_ref"))


@_q
def lateral_base_ref(c: Ctx):
    s = c.src["epdrserviceconnect"]
    return s.select("wass_appid", I.drop_last_segment(F.col("wass_appid")).alias("base_ref"))


@_q
def pipe_use_code(c: Ctx):
    p = c.src["epdrpipe"].select(F.lit("PACP").alias("kind"), F.col("epdrpipeoi").cast("string").alias("src_id"),
                                 F.col("wwtype").alias("raw"), C.pipe_use_code(F.col("wwtype"), True).alias("code"))
    s = c.src["epdrserviceconnect"].select(F.lit("LACP").alias("kind"), F.col("wass_appid").alias("src_id"),
                                           F.col("recordtype").alias("raw"),
                                           C.pipe_use_code(F.col("recordtype"), False).alias("code"))
    return p.unionByName(s)


@_q
def grade_to_invert(c: Ctx):
    p = c.src["epdrpipe"]
    return p.select("epdrpipeoi",
                    C.grade_to_invert(F.col("usgroundelev_fl"), F.col("usinvertelev_fl")).cast("double").alias("up_grade"),
                    C.grade_to_invert(F.col("dsgroundelev_fl"), F.col("dsinvertelev_fl")).cast("double").alias("down_grade"))


@_q
def task_number(c: Ctx):
    return task_dim(c.src).select(F.col("__task_key").alias("workordertaskoi"), "work_orders_number")


# ------------------------------------------------------------------ I: sync rules

@_q
def enqueue_work_orders(c: Ctx):
    q, _ = R.enqueue_work_orders(c.queue, c.stg)
    return q


@_q
def acknowledge_sent_stg(c: Ctx):
    qf = c.part("queue", ["queue_uuid", "old_status", "new_status"])
    stg, _ = R.acknowledge_sent(c.stg, c.queue, qf)
    return stg


@_q
def acknowledge_sent_queue(c: Ctx):
    qf = c.part("queue", ["queue_uuid", "old_status", "new_status"])
    _, q = R.acknowledge_sent(c.stg, c.queue, qf)
    return q


@_q
def propagate_due_date(c: Ctx):
    wf = c.part("workorder", ["wo_uuid", "site_oi", "reqcompdate_dttm"])
    return R.propagate_due_date(c.stg, wf).drop(R.CHG, R.CHG_DATE)


@_q
def collect_inspections(c: Ctx):
    return c.collected().select(*CR_INSPECT_COLUMNS)


@_q
def reflag_tasks(c: Ctx):
    stg, _ = R.reflag_tasks(c.stg, c.collected())
    return stg.drop(R.CHG, R.CHG_DATE)


@_q
def backfill_sid(c: Ctx):
    cr = c.collected().select(*CR_INSPECT_COLUMNS)
    vf = c.part("vendor", ["workorder", "inspection_sid"])
    return R.backfill_sid(cr, vf)


def _cascade(c: Ctx) -> dict[str, DataFrame]:
    state = {"stg": c.stg, "queue": c.queue, "cr": c.empty_cr()}
    return R.run_cascade(state, c.feed, c.src, c.lk)


@_q
def cascade_stg(c: Ctx):
    return _cascade(c)["stg"]


@_q
def cascade_queue(c: Ctx):
    return _cascade(c)["queue"]


# ------------------------------------------------------------------ K: quality reports

@_q
def cascade_quarantine(c: Ctx):
    out = _cascade(c)
    seqs = c.part("staging", ["task_uuid", "workorder_uuid", "wotasktitle"]).where(F.col("workorder_uuid").isNull())
    lost = out["quarantine_queue"].join(seqs.select("seq", R.staged_task().alias("task_uuid")), "task_uuid")
    return (out["quarantine_ids"].select(F.lit("inspection.bad_hex").alias("rule"), "seq")
            .unionByName(lost.select(F.lit("staging.null_work_order").alias("rule"), "seq")))


@_q
def dq_coverage(c: Ctx):
    return Q.coverage(c.src, c.lk)


@_q
def dq_lookups(c: Ctx):
    return Q.lookup_report(c.lk)


@_q
def dq_duplicate_keys(c: Ctx):
    parts = [
        Q.duplicate_keys(c.queue, ["task_uuid"]).select(F.lit("queue.task_uuid").alias("check_name"), "key", "n"),
        Q.duplicate_keys(c.stg, ["task_uuid"]).select(F.lit("stg.task_uuid").alias("check_name"), "key", "n"),
        Q.duplicate_keys(c.src["epdrdrainfacility"], ["epdrdrainagefacilityoi"])
         .select(F.lit("facility.oi").alias("check_name"), "key", "n"),
        Q.duplicate_keys(c.src["epdrmanhole"], ["manholeid"]).select(F.lit("manhole.id").alias("check_name"), "key", "n"),
        Q.duplicate_keys(c.src["epdrserviceconnect"], ["wass_appid"])
         .select(F.lit("service.id").alias("check_name"), "key", "n"),
        Q.duplicate_keys(c.unified(), ["work_orders_number"])
         .select(F.lit("view.work_orders_number").alias("check_name"), "key", "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


@_q
def dq_nulls(c: Ctx):
    return (Q.null_violations(c.stg, ["task_uuid", "workorder_uuid", "plndcompdate_dttm"], "wot_stg")
            .unionByName(Q.null_violations(c.queue, ["task_uuid"], "wot_stg1"))
            .unionByName(Q.null_violations(c.src["workorders"], ["wonumber"], "workorders"))
            .unionByName(Q.null_violations(c.src["epdrpipe"], ["pipeid", "usgroundelev_fl"], "epdrpipe")))


@_q
def dq_quarantine(c: Ctx):
    _, bad_q = Q.split_valid(c.stg, Q.queue_key_rule())
    h = c.src["epdrfacworkhistory"]
    _, bad_h = Q.split_valid(h, F.coalesce(Q.hex_id_rule("uuid"), F.col("uuid").isNull()))
    _, bad_p = Q.split_valid(c.src["epdrpipe"], F.col("pipeid").isNotNull())
    return (bad_q.agg(F.count(F.lit(1)).alias("n")).select(F.lit("stg.null_workorder").alias("rule"), "n")
            .unionByName(bad_h.agg(F.count(F.lit(1)).alias("n")).select(F.lit("history.bad_hex").alias("rule"), "n"))
            .unionByName(bad_p.agg(F.count(F.lit(1)).alias("n")).select(F.lit("pipe.null_id").alias("rule"), "n")))


@_q
def dq_unmapped(c: Ctx):
    return Q.unmapped_codes(c.unified())


@_q
def dq_double_branch(c: Ctx):
    return Q.double_branch(c.unified())


@_q
def default_task_uuid(c: Ctx):
    df = c.stg.select(F.when(F.col("task_uuid").endswith("0"), F.lit(None)).otherwise(F.col("task_uuid"))
                      .alias("task_uuid"), "workorder_uuid")
    return Q.with_default_uuid(df).select(F.length("task_uuid").alias("len"), "workorder_uuid")


QUERIES = {
    "src_scan_counts": src_scan_counts, "lookup_mh_use": lookup_mh_use, "lookup_shape": lookup_shape,
    "lookup_material": lookup_material, "lookup_wall": lookup_wall, "lookup_listing": lookup_listing,
    "view_registered": view_registered, "outbound_extract": outbound_extract, "outbound_since": outbound_since,
    "feed_stream_replay": feed_stream_replay,
    "layout_cast": layout_cast, "classify_kinds": classify_kinds, "access_type": access_type,
    "pick_by_kind": pick_by_kind, "wall_bench_channel": wall_bench_channel, "segment_refs": segment_refs,
    "null_safe_changed": null_safe_changed, "status_transition": status_transition,
    "spine_inner": spine_inner, "spine_left": spine_left, "spine_facility": spine_facility,
    "branch_attach": branch_attach, "code_join_shape": code_join_shape, "code_join_material": code_join_material,
    "mh_use_code": mh_use_code, "clean_longdesc": clean_longdesc_q, "anti_join_new": anti_join_new,
    "semi_join_keys": semi_join_keys, "update_by_key": update_by_key, "update_by_two_keys": update_by_two_keys,
    "delete_by_keys": delete_by_keys_q, "changed_keys": changed_keys_q, "first_per_key": first_per_key_q,
    "last_per_key": last_per_key_q, "previous_value": previous_value_q, "unified_inspections": unified_q,
    "strip_html": strip_html_pages, "strip_html_documents": strip_html_documents,
    "canonical_uuid": canonical_uuid, "compact_uuid": compact_uuid, "manhole_number": manhole_number,
    "pipe_base_ref": pipe_base_ref, "lateral_base_ref": lateral_base_ref, "pipe_use_code": pipe_use_code,
    "grade_to_invert": grade_to_invert, "task_number": task_number,
    "enqueue_work_orders": enqueue_work_orders, "acknowledge_sent_stg": acknowledge_sent_stg,
    "acknowledge_sent_queue": acknowledge_sent_queue, "propagate_due_date": propagate_due_date,
    "collect_inspections": collect_inspections, "reflag_tasks": reflag_tasks, "backfill_sid": backfill_sid,
    "cascade_stg": cascade_stg, "cascade_queue": cascade_queue,
    "dq_duplicate_keys": dq_duplicate_keys, "dq_nulls": dq_nulls, "dq_quarantine": dq_quarantine,
    "cascade_quarantine": cascade_quarantine, "view_outbound": view_outbound,
    "dq_coverage": dq_coverage, "dq_lookups": dq_lookups, "dq_unmapped": dq_unmapped, "dq_double_branch": dq_double_branch, "default_task_uuid": default_task_uuid,
}
