"""Change-driven sync rules as set-based DataFrame functions.

Each rule maps (state, feed rows) -> new state. The same functions run in batch
(``run_cascade`` over a whole feed) and per micro-batch inside ``foreachBatch``
(``streaming.sync``). The state is three tables:

  stg    staging rows, one per task          (task_uuid, workorder_uuid, .., feed_status)
  queue  outbound work-order queue           (task_uuid = the work-order id, .., feed_status)
  cr     inspection rows for the vendor feed (CR_INSPECT_COLUMNS)

Staging updates carry helper columns: ``__chg_seq``, the first feed sequence that changed the row, and
``__chg_date``, its planned date right then, so that the enqueue rule sees what it would have seen at that moment.

Order. Events follow ``seq``, as if they came one by one, so a batch gives the same state however the feed is cut.
Events of different work orders never meet, and what all events of a work order do to its rows together is computed by
aggregates (``effects``), for any number of events and tasks. One event that changes several tasks is taken in the order of
their ids. A null work-order id would break the queue key: such rows go to quarantine.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import null_safe_changed
from ..functions.ids import canonical_uuid, is_valid_hex, raw_key
from ..functions.text import nn, strip_html
from ..operators.changes import changed_keys, first_per_key, last_per_key, previous_value
from ..operators.joins import delete_by_keys, mark_keys, not_present, split_by_keys, split_rows
from ..plans.inspections import unified_inspections
from ..session import materialise, settle
from . import effects
from ..sources.lookups import Lookup
from ..sources.schemas import CR_INSPECT_COLUMNS, WOT_STG1_SCHEMA, WOT_STG_SCHEMA

DATE_SENTINEL = _dt.datetime(1900, 1, 1)
STATUS_SENTINEL = "~"
CHG, CHG_DATE = "__chg_seq", "__chg_date"
QUEUE_COLUMNS = [f.name for f in WOT_STG1_SCHEMA.fields]


def _with_chg(stg: DataFrame) -> DataFrame:
    if CHG not in stg.columns:
        stg = stg.withColumn(CHG, F.lit(None).cast("long"))
    return stg if CHG_DATE in stg.columns else stg.withColumn(CHG_DATE, F.lit(None).cast("timestamp_ntz"))


def _plain(stg: DataFrame) -> DataFrame:
    return stg.drop(CHG, CHG_DATE)


def _min_seq(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.least(a, b))


def feed_part(feed: DataFrame, source: str, cols: list[str]) -> DataFrame:
    return feed.where(F.col("source") == source).select("seq", *cols)


# --------------------------------------------------------------------------- I2 / I3

def norm_status(c: Column) -> Column:
    """Trimmed, upper-cased status; blank reads as null."""
    return nn(F.trim(F.upper(c)))


def is_sent_transition(old: Column, new: Column) -> Column:
    """New status SEND/SENT and (old is null, or old not SEND/SENT). Three-valued: a blank
    old status normalises to null, the NOT IN is unknown and there is no transition."""
    sent = ["SEND", "SENT"]
    t = norm_status(new).isin(*sent) & (old.isNull() | ~norm_status(old).isin(*sent))
    return F.coalesce(t, F.lit(False))


def with_old_status(queue_feed: DataFrame, queue: DataFrame | None) -> DataFrame:
    """Old image for a feed that carries only new statuses: the previous update's status
    of the same queue row, the first one seeded from the stored queue row."""
    seed = None
    if queue is not None:
        q = queue.select(F.col("task_uuid").alias("__qk"), F.col("feed_status").alias("__seed"))
        q = q.join(queue_feed.select(F.col("queue_uuid").alias("__qk")).distinct(), "__qk", "left_semi")
        queue_feed = queue_feed.join(q, queue_feed["queue_uuid"] == q["__qk"], "left").drop("__qk")
        seed = F.col("__seed")
    out = previous_value(queue_feed, "queue_uuid", "seq", "new_status", seed=seed, alias="old_status")
    return out.drop("__seed") if seed is not None else out


def sent_transitions(queue_feed: DataFrame, queue: DataFrame | None = None) -> DataFrame:
    """Distinct work-order ids whose queue row turned to SEND/SENT. With ``queue`` given,
    only rows that exist fire (an UPDATE of a missing row changes nothing)."""
    if "old_status" not in queue_feed.columns:
        queue_feed = with_old_status(queue_feed, queue)
    t = queue_feed.where(is_sent_transition(F.col("old_status"), F.col("new_status")))
    keys = changed_keys(t, "queue_uuid", "key")
    if queue is not None:
        # the queue rows of those keys (the queue is filtered by the small key set)
        keys = (queue.select(F.col("task_uuid").alias("key")).join(keys, "key", "left_semi")
                .dropDuplicates())
    return keys


def acknowledge_sent(stg: DataFrame, queue: DataFrame, queue_feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a batch of queue status updates: every staging row of a transitioned work
    order becomes SENT; transitioned queue rows are deleted; other updated queue rows
    take the status of their last update."""
    if "old_status" not in queue_feed.columns:
        queue_feed = with_old_status(queue_feed, queue)
    acks = (queue_feed.where(F.col("queue_uuid").isNotNull()).groupBy(F.col("queue_uuid").alias("__q"))
            .agg(F.max(is_sent_transition(F.col("old_status"), F.col("new_status"))).alias("__sent"),
                 F.max_by("new_status", "seq").alias("__ns")))
    q = queue.join(acks, queue["task_uuid"] == acks["__q"], "left")
    sent = F.coalesce(F.col("__sent"), F.lit(False))
    k = q.where(sent).select(F.col("task_uuid").alias("__ack")).distinct()
    stg2 = (stg.join(k, stg["workorder_uuid"] == k["__ack"], "left")
            .withColumn("feed_status", F.when(F.col("__ack").isNotNull(), F.lit("SENT"))
                        .otherwise(F.col("feed_status")))
            .drop("__ack"))
    status = F.when(F.col("__q").isNotNull(), F.col("__ns")).otherwise(F.col("feed_status"))
    return stg2, q.where(~sent).withColumn("feed_status", status).select(*queue.columns)


# --------------------------------------------------------------------------- I4

def due_date_summary(wo_feed: DataFrame) -> DataFrame:
    """Per work order (site 58 only): what a run of required-date updates does to a
    staging row.

      first_s / first_date / first_seq  the first update (compared with the stored date)
      any_later                         some later update differs from the one before it
      next_date / next_seq              the first update that differs from the first one
      run_date / run_seq                the update that starts the final run of equal
                                        values (the last one that changed anything)
    Dates compare through NVL(date, 1900-01-01).
    """
    ev = (wo_feed.where((F.col("site_oi") == 58) & F.col("wo_uuid").isNotNull())
          .select("seq", "wo_uuid", F.col("reqcompdate_dttm").alias("d"),
                  F.coalesce(F.col("reqcompdate_dttm"), F.lit(DATE_SENTINEL).cast("timestamp_ntz")).alias("s")))
    # Associative aggregates joined back, so a work order of any number of updates is combined before each shuffle: the first
    # update and the last one; then the first that differs from the first, and the last that differs from the last;
    # the final run starts right after that one.
    event = F.struct("s", "d", "seq")
    ends = ev.groupBy("wo_uuid").agg(F.min_by(event, "seq").alias("first"), F.max_by("s", "seq").alias("last_s"))
    seen = ev.join(ends.select(F.col("wo_uuid").alias("__w"), F.col("first.s").alias("__first"), F.col("last_s").alias("__last")), F.col("wo_uuid") == F.col("__w"))
    other = F.col("s") != F.col("__first")
    turns = seen.groupBy("wo_uuid").agg(
        F.max(other).alias("any_later"), F.min_by(F.when(other, event), F.when(other, F.col("seq"))).alias("next"),
        F.max(F.when(F.col("s") != F.col("__last"), F.col("seq"))).alias("turn"))
    after = ev.join(turns.select(F.col("wo_uuid").alias("__w"), "turn"), F.col("wo_uuid") == F.col("__w")).where(F.col("seq") > F.col("turn"))
    run = after.groupBy(F.col("wo_uuid").alias("__r")).agg(F.min_by(event, "seq").alias("run"))
    a = (ends.join(turns.withColumnRenamed("wo_uuid", "__w"), F.col("wo_uuid") == F.col("__w"))
         .join(run, F.col("wo_uuid") == F.col("__r"), "left"))
    return a.select("wo_uuid", F.col("first.s").alias("first_s"), F.col("first.d").alias("first_date"),
                    F.col("first.seq").alias("first_seq"), "any_later", F.col("next.d").alias("next_date"),
                    F.col("next.seq").alias("next_seq"), F.col("run.d").alias("run_date"), F.col("run.seq").alias("run_seq"))


def propagate_due_date(stg: DataFrame, wo_feed: DataFrame) -> DataFrame:
    """Required-date updates of site-58 work orders reach every staging row of the work
    order whose planned date really differs: date set, status UPDATED (SENT included)."""
    stg = _with_chg(stg)
    sm = due_date_summary(wo_feed)
    j = stg.join(sm, stg["workorder_uuid"] == sm["wo_uuid"], "left")
    matched = F.col("wo_uuid").isNotNull()
    changed1 = matched & null_safe_changed(F.col("plndcompdate_dttm"), F.col("first_s"),
                                           F.lit(DATE_SENTINEL).cast("timestamp_ntz"))
    later = matched & F.coalesce(F.col("any_later"), F.lit(False))
    changed = changed1 | later
    new_date = (F.when(later, F.col("run_date")).when(changed1, F.col("first_date"))
                .otherwise(F.col("plndcompdate_dttm")))
    seq = F.when(changed1, F.col("first_seq")).when(later, F.col("next_seq"))
    at = F.when(changed1, F.col("first_date")).otherwise(F.col("next_date"))
    sooner = changed & (F.col(CHG).isNull() | (seq < F.col(CHG)))
    # all outputs are computed from the pre-update row in one projection
    outs = {"plndcompdate_dttm": new_date,
            "feed_status": F.when(changed, F.lit("UPDATED")).otherwise(F.col("feed_status")),
            CHG: _min_seq(F.col(CHG), seq),
            CHG_DATE: F.when(sooner, at).otherwise(F.col(CHG_DATE))}
    return j.select(*[(outs[c] if c in outs else F.col(c)).alias(c) for c in stg.columns])


# --------------------------------------------------------------------------- I5 / I6

def clean_before_write(cr_rows: DataFrame) -> DataFrame:
    """Write-path cleaner on every inserted or updated inspection row."""
    return cr_rows.withColumn("additional_information", strip_html(F.col("additional_information")))


def to_cr_rows(view_rows: DataFrame) -> DataFrame:
    """View rows -> inspection rows: ids canonicalised, columns renamed, status NEW."""
    v = view_rows
    cols = {
        "project_sid": canonical_uuid(F.col("work_order_task_uuid")),
        "inspection_type": F.col("inspection_type"),
        "inspectionid": canonical_uuid(F.col("dr_uuid")),
        "work_order_uuid": canonical_uuid(F.col("work_order_uuid")),
        "workorder": F.col("work_orders_number"),
        "project": F.col("work_order_task_title"),
        "po_number": F.col("asset_number"),
        "feed_status": F.lit("NEW"),
        "inspection_sid": F.lit(None).cast("string"),
    }
    return v.select(*[(cols[c] if c in cols else F.col(c)).alias(c) for c in CR_INSPECT_COLUMNS],
                    F.col("dr_uuid").alias("__raw_dr_uuid"),
                    F.col("epdrfacilityworkhistoryoi").alias("__key"),
                    F.col("epdrfacilityworkhistoryoi").cast("string").alias("__key_txt"),
                    *[F.col(c) for c in v.columns if c == "__seq"])


def collect_inspections(cr: DataFrame, hist_feed: DataFrame, src: dict[str, DataFrame],
                        lookups: dict[str, Lookup], dedupe: str = "raw") -> DataFrame:
    """New inspection rows for the history keys a batch inserted.

    The key set restricts the history table before any join (semi join), then the
    unified view runs on that slice. A row is skipped when its id is already stored:
    ``dedupe='raw'`` compares the stored (canonical) id with the raw DR_UUID as the
    integration does; ``'canonical'`` compares canonical forms. Inside the batch a row is also skipped
    when an earlier key (by sequence; one statement's keys in text order) inserts the id it is compared
    with. Returns the rows to append, cleaned, with ``__seq`` (the feed sequence of their key).
    """
    key = "epdrfacilityworkhistoryoi"
    keys = materialise(hist_feed.where(F.col("history_oi").isNotNull())
                       .groupBy(F.col("history_oi").alias(key)).agg(F.min("seq").alias("__seq")))
    # the slice restricts every other table, so it is read many times: computed once
    hist = materialise(split_by_keys(src["epdrfacworkhistory"], key, keys, key)[0].join(keys, key, "inner"))
    # The rows, too: what follows reads their ids only, and all rows but those of doubtful ids pass as they are, unshuffled.
    rows = to_cr_rows(unified_inspections(src, lookups, history=hist, carry=["__seq"])).drop("__key")
    cmp = "__raw_dr_uuid" if dedupe == "raw" else "inspectionid"
    rows = materialise(clean_before_write(rows))
    # only the stored ids that the slice can compare with
    ids = rows.select(F.col(cmp).alias("__old_id")).where(F.col("__old_id").isNotNull()).dropDuplicates()
    stored = split_by_keys(cr.select(F.col("inspectionid").alias("__old_id")), "__old_id", rows, cmp)[0]
    existing = materialise(stored.join(ids, "__old_id", "left_semi").dropDuplicates())
    # Doubtful are ids that more than one key carries, and those of rows that are there already.
    order = F.struct("__seq", "__key_txt")
    known = rows.where(F.col("inspectionid").isNotNull())
    twice = known.groupBy("inspectionid").agg(F.min(order).alias("__a"), F.max(order).alias("__b")).where(F.col("__a") != F.col("__b"))
    there = known.join(existing, F.col(cmp) == existing["__old_id"], "left_semi")
    doubtful = materialise(twice.select("inspectionid").unionByName(there.select("inspectionid")).distinct())
    near, rest = split_by_keys(rows, "inspectionid", doubtful, "inspectionid")
    near_too, far = split_by_keys(rest, cmp, existing, "__old_id")
    near = near.unionByName(near_too)
    near = near.join(existing, near[cmp] == existing["__old_id"], "left").where(F.col("__old_id").isNull())  # an anti join would be moved below the filter
    # Inside the batch an id is inserted by the first key (by sequence, then text) carrying it. A row can only meet another
    # row's id when its compared value equals its own canonical id, so the first key per canonical id decides it (null
    # ids never match anything). An aggregate joined back: a hot id is combined before the shuffle, at every size.
    first = (near.where(F.col("inspectionid").isNotNull())
             .groupBy(F.col("inspectionid").alias("__iid")).agg(F.min(order).alias("__first")))
    near = near.join(first, near["inspectionid"] == first["__iid"], "left")
    keep = F.col("__first").isNull() | (F.col("__first") == order)
    if dedupe == "raw":
        keep = keep | ~F.col("__raw_dr_uuid").eqNullSafe(F.col("inspectionid"))
    out = [*CR_INSPECT_COLUMNS, "__seq"]
    return far.select(*out).unionByName(near.where(keep).select(*out))


# --------------------------------------------------------------------------- I7

def reflag_tasks(stg: DataFrame, cr_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inspection rows with status NEW re-flag their staging row (same task and work
    order) to UPDATED unless it already is. Returns (new stg, rows whose ids are not
    valid hex, i.e. would fail the binary conversion upstream)."""
    stg = _with_chg(stg)
    new = cr_rows.where(F.col("feed_status") == "NEW")
    seqc = F.col("__seq") if "__seq" in cr_rows.columns else F.lit(None).cast("long")
    # a null id matches no row and raises nothing; only text that is not hex does
    broken = lambda c: F.col(c).isNotNull() & ~F.coalesce(is_valid_hex(F.col(c)), F.lit(False))
    bad = new.where(broken("project_sid") | broken("work_order_uuid"))
    ok = F.coalesce(is_valid_hex(F.col("project_sid")) & is_valid_hex(F.col("work_order_uuid")), F.lit(False))
    # The check is an aggregate and the keys are never null: a filter on either would be moved below all joins of the view and
    # work on every row of its sources. Rows of one key are all valid or not, but for null ids, which ``ok`` leaves out.
    key = lambda c: F.coalesce(raw_key(F.col(c)), F.lit(""))
    keys = (new.select(key("project_sid").alias("__t"), key("work_order_uuid").alias("__w"), seqc.alias("__s"), ok.alias("__ok"))
            .groupBy("__t", "__w").agg(F.min(F.when(F.col("__ok"), F.col("__s"))).alias("__s"), F.bool_or("__ok").alias("__ok"))
            .where("__ok").drop("__ok"))
    j = stg.join(keys, (stg["task_uuid"] == keys["__t"]) & (stg["workorder_uuid"] == keys["__w"]), "left")
    hit = F.col("__t").isNotNull() & null_safe_changed(F.col("feed_status"), F.lit("UPDATED"), STATUS_SENTINEL)
    out = (j.withColumn("__hit", hit)
           .withColumn("feed_status", F.when(F.col("__hit"), F.lit("UPDATED")).otherwise(F.col("feed_status")))
           .withColumn(CHG_DATE, F.when(F.col("__hit") & F.col(CHG).isNull(), F.col("plndcompdate_dttm")).otherwise(F.col(CHG_DATE)))
           .withColumn(CHG, F.when(F.col("__hit"), _min_seq(F.col(CHG), F.col("__s"))).otherwise(F.col(CHG)))
           .select(*stg.columns))
    return out, bad


# --------------------------------------------------------------------------- I1

def enqueue_work_orders(queue: DataFrame, stg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staging rows changed in this batch (``__chg_seq`` set; or all rows when the column
    is absent, i.e. an initial load) with status NEW/UPDATED (exact case) put their work
    order on the queue when it is not there yet; a queued row is not refreshed.
    Returns (new queue, quarantined rows with a null work-order id)."""
    if CHG in stg.columns:
        ch = stg.where(F.col(CHG).isNotNull())
        if CHG_DATE in stg.columns:
            ch = ch.withColumn("plndcompdate_dttm", F.col(CHG_DATE))
        seq = F.col(CHG)
    else:
        ch, seq = stg, F.lit(None).cast("long")
    cand = ch.where(F.col("feed_status").isin("NEW", "UPDATED")).withColumn("__seq", seq)
    bad = cand.where(F.col("workorder_uuid").isNull())
    vals = ["task_uuid", "wotasktitle", "plndcompdate_dttm", "plndstrtdate_dttm", "workclassifi_oi", "feed_status"]
    first = first_per_key(cand, "workorder_uuid", ["__seq", "task_uuid"], vals)
    new = first.select(F.col("workorder_uuid").alias("task_uuid"), *[c for c in vals if c != "task_uuid"])
    queued = queue.select(F.col("task_uuid").alias("__q")).join(new.select(F.col("task_uuid").alias("__q")), "__q", "left_semi")
    new = not_present(new, queued, [("task_uuid", "__q")])
    return queue.select(*QUEUE_COLUMNS).unionByName(new.select(*QUEUE_COLUMNS)), bad.drop("__seq", CHG, CHG_DATE)


# --------------------------------------------------------------------------- I8

def _was_there(cr: DataFrame) -> Column:
    """Whether a row was inserted (``__seq``, if there is such a column) before the change at ``__at``."""
    return F.col("__seq").isNull() | (F.col("__at") > F.col("__seq")) if "__seq" in cr.columns else F.lit(True)


def backfill_sid(cr: DataFrame, vendor_feed: DataFrame, overwrite: bool = True) -> DataFrame:
    """Vendor rows with a work-order number set the vendor id on every inspection row of
    that number (the last update per number wins). Updated rows are cleaned again."""
    last = last_per_key(vendor_feed.where(F.col("workorder").isNotNull()), "workorder", "seq", ["inspection_sid"])
    lk = last.select(F.col("workorder").alias("__wo"), F.col("inspection_sid").alias("__sid"), F.col("seq").alias("__at"))
    j = cr.join(lk, cr["workorder"] == lk["__wo"], "left")
    hit = F.col("__wo").isNotNull() & _was_there(cr)
    if not overwrite:
        hit = hit & F.col("inspection_sid").isNull()
    outs = {"inspection_sid": F.when(hit, F.col("__sid")).otherwise(F.col("inspection_sid")),
            "additional_information": F.when(hit, strip_html(F.col("additional_information")))
                                      .otherwise(F.col("additional_information"))}
    return j.select(*[(outs[c] if c in outs else F.col(c)).alias(c) for c in cr.columns])


# --------------------------------------------------------------------------- staging and inspection sources

STG_COLUMNS = [f.name for f in WOT_STG_SCHEMA.fields]
STAGED = ["task_uuid", "workorder_uuid", "wotasktitle", "plndcompdate_dttm", "plndstrtdate_dttm", "workclassifi_oi", "feed_status"]


def staged_task() -> Column:
    """The task id of a staging event. One written without an id gets one, as the column's default does upstream; it is
    made from ``seq``, so a replay gives the same."""
    return F.coalesce(F.col("task_uuid"), F.md5(F.concat(F.lit("staging-"), F.col("seq").cast("string")).cast("binary")))


def write_staging(stg: DataFrame, staged: DataFrame) -> DataFrame:
    """Inserts and updates of staging rows: the last image of a task wins; its status time is kept. A task keeps its work order."""
    last = last_per_key(staged.where(F.col("task_uuid").isNotNull()), "task_uuid", "seq", STAGED[1:])
    new = last.select(F.col("task_uuid").alias("__t"), *[F.col(c).alias(f"__{c}") for c in STAGED[1:]])
    j = stg.select(*STG_COLUMNS).join(new, stg["task_uuid"] == new["__t"], "full_outer")
    hit = F.col("__t").isNotNull()
    value = lambda c: F.coalesce("task_uuid", "__t") if c == "task_uuid" else F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) if c in STAGED else F.col(c)
    return j.select(*[value(c).alias(c) for c in STG_COLUMNS])


def _as_changed(staged: DataFrame) -> DataFrame:
    """Written staging rows as the enqueue rule sees them, with the values as they were written."""
    rows = staged.withColumn("feed_status_dttm", F.lit(None).cast("timestamp")).withColumn(CHG, F.col("seq"))
    return rows.withColumn(CHG_DATE, F.col("plndcompdate_dttm")).select(*STG_COLUMNS, CHG, CHG_DATE)


def set_inspection_status(cr: DataFrame, changes: DataFrame) -> DataFrame:
    """Inspection rows whose status changed upstream take the last one (an update also cleans the row again)."""
    last = last_per_key(changes.where(F.col("inspectionid").isNotNull()), "inspectionid", "seq", ["feed_status"])
    k = last.select(F.col("inspectionid").alias("__id"), F.col("feed_status").alias("__st"), F.col("seq").alias("__at"))
    j = cr.join(k, cr["inspectionid"] == k["__id"], "left")
    hit = F.col("__id").isNotNull() & _was_there(cr)
    outs = {"feed_status": F.when(hit, F.col("__st")).otherwise(F.col("feed_status")),
            "additional_information": F.when(hit, strip_html(F.col("additional_information"))).otherwise(F.col("additional_information")),
            "__status_seq": F.when(hit, F.col("__at")).otherwise(F.col("__status_seq")) if "__status_seq" in cr.columns else None}
    return j.select(*[(outs[c] if c in outs else F.col(c)).alias(c) for c in cr.columns])


# --------------------------------------------------------------------------- I9

EVENT_COLUMNS = ["seq", "kind", "wo", "task", "date", "old_status", "new_status", "title", "start", "class"]


def work_order_events(feed: DataFrame, flagged: DataFrame) -> DataFrame:
    """All events of a batch that a work order sees: (seq, kind, wo, task, ...).

    ``flagged`` are the inspection rows set to NEW (inserted or changed), with ``__seq``. Events without a work order match
    nothing and are left out."""
    def part(df: DataFrame, kind: str, **cols: str | Column) -> DataFrame:
        types = {"seq": "long", "date": "timestamp_ntz", "start": "timestamp_ntz", "class": "long"}
        value = lambda c: cols[c] if c in cols else F.lit(kind) if c == "kind" else F.lit(None)
        return df.select(*[(F.col(value(c)) if isinstance(value(c), str) else value(c)).cast(types.get(c, "string")).alias(c) for c in EVENT_COLUMNS])

    source = F.col("source")
    ok = is_valid_hex(F.col("project_sid")) & is_valid_hex(F.col("work_order_uuid"))
    events = (part(feed.where(source == "queue"), "queue", seq="seq", wo="queue_uuid", old_status="old_status", new_status="new_status")
              .unionByName(part(feed.where((source == "workorder") & (F.col("site_oi") == 58)), "due", seq="seq", wo="wo_uuid", date="reqcompdate_dttm"))
              .unionByName(part(feed.where(source == "staging"), "staging", seq="seq", wo="workorder_uuid", task="task_uuid", date="plndcompdate_dttm",
                                new_status="feed_status", title="wotasktitle", start="plndstrtdate_dttm", **{"class": "workclassifi_oi"}))
              .unionByName(part(flagged.where(ok), "flag", seq="__seq", wo=raw_key(F.col("work_order_uuid")), task=raw_key(F.col("project_sid"))).distinct()))
    return events.where(F.col("wo").isNotNull())


def prepare(cr: DataFrame, feed: DataFrame, src: dict[str, DataFrame], lookups: dict[str, Lookup], dedupe: str = "raw") -> dict[str, DataFrame]:
    """What a batch brings, each computed once: ``feed``, ``new_cr`` (new inspection rows with ``__seq``; I5 with I6), ``changed`` (status
    changes of inspection rows), ``flagged`` (rows set to NEW), ``events`` (see ``work_order_events``) and ``lost`` (staging events without a work order).
    Of the stored inspections only the ids are read."""
    task = F.when(F.col("source") == "staging", staged_task()).otherwise(F.col("task_uuid"))
    feed = materialise(feed.withColumn("task_uuid", task))
    new_cr = settle(lambda: collect_inspections(cr, feed_part(feed, "history", ["history_oi"]), src, lookups, dedupe))
    changed = feed_part(feed, "inspection", ["inspectionid", "project_sid", "work_order_uuid", "feed_status"])
    ids = ["project_sid", "work_order_uuid", "feed_status", "__seq"]
    flagged = new_cr.select(*ids).unionByName(changed.withColumnRenamed("seq", "__seq").select(*ids)).where(F.col("feed_status") == "NEW")
    lost = feed_part(feed, "staging", STAGED).where(F.col("workorder_uuid").isNull())
    return {"feed": feed, "new_cr": new_cr, "changed": changed, "flagged": flagged, "events": materialise(work_order_events(feed, flagged)), "lost": lost}


def apply_prepared(stg: DataFrame, queue: DataFrame, batch: dict[str, DataFrame]) -> dict:
    """Staging and queue after a prepared batch (whole, and parted into ``near`` and ``far`` rows), and its quarantine. The events of each work order are applied in turn: queue
    acknowledgements (I2, I3), written staging rows, re-flags (I7), due dates (I4), each followed by the enqueue rule (I1).
    ``stg`` and ``queue`` may be the rows of the touched work orders only; others pass through."""
    stg, queue, events, lost = stg.select(*STG_COLUMNS), queue.select(*QUEUE_COLUMNS), batch["events"], batch["lost"]
    # Rows that no event can touch pass through without a shuffle; the others are looked up once.
    written = materialise(lost.select(F.col("task_uuid").alias("__t")).distinct())
    wos = materialise(events.select(F.col("wo").alias("__wo")).distinct())
    marked = mark_keys(mark_keys(stg, "workorder_uuid", wos, "__wo", "__seen"), "task_uuid", written, "__t", "__lost")
    touched = F.col("__seen") | F.col("__lost")
    stg_far = marked.where(~touched).select(*STG_COLUMNS)
    near = marked.where(touched)
    near = materialise(near.join(wos, near["workorder_uuid"] == wos["__wo"], "left").select(*STG_COLUMNS, "__lost", F.col("__wo").isNotNull().alias("__in")))
    # Rows that lose their work order are few.
    kept, few = near.where(~F.col("__lost")).drop("__lost"), near.where("__lost").drop("__lost")
    hit = lambda how: few.join(written, few["task_uuid"] == written["__t"], how)
    few = materialise(hit("left_anti").unionByName(write_staging(hit("left_semi"), lost).withColumn("__in", F.lit(False))))
    part = lambda which: kept.unionByName(few).where(which).select(*STG_COLUMNS)
    stg_in, stg_out = part(F.col("__in")), part(~F.col("__in"))
    _, bad_queue = enqueue_work_orders(queue, _as_changed(lost))
    queue_in, queue_out, queue_far = split_rows(queue, "task_uuid", wos, "__wo")
    new_stg, new_queue = effects.apply_events(stg_in, queue_in, events, is_sent_transition(F.col("old_status"), F.col("status")))
    # near: rows that may have changed, far: all others, as they were
    near = {"stg": stg_out.unionByName(new_stg), "queue": queue_out.unionByName(new_queue)}
    far = {"stg": stg_far, "queue": queue_far}
    broken = lambda c: F.col(c).isNotNull() & ~F.coalesce(is_valid_hex(F.col(c)), F.lit(False))
    bad_ids = batch["flagged"].where(broken("project_sid") | broken("work_order_uuid")).select(F.col("__seq").alias("seq"), "project_sid", "work_order_uuid")
    whole = {t: far[t].unionByName(near[t]) for t in far}
    return {**whole, "near": near, "far": far, "quarantine_ids": bad_ids, "quarantine_queue": bad_queue.select(*STG_COLUMNS)}


def run_cascade(state: dict[str, DataFrame], feed: DataFrame, src: dict[str, DataFrame],
                lookups: dict[str, Lookup], dedupe: str = "raw", with_backfill: bool = False) -> dict[str, DataFrame]:
    """One batch of the whole trigger chain in the order of ``seq``, however the batch was cut from the feed: ``prepare``,
    ``apply_prepared``, then status changes of inspection rows and the optional vendor back-fill (I8)."""
    batch = prepare(state["cr"], feed, src, lookups, dedupe)
    out = apply_prepared(state["stg"], state["queue"], batch)
    cr = state["cr"].select(*CR_INSPECT_COLUMNS).withColumn("__seq", F.lit(None).cast("long")).unionByName(batch["new_cr"])
    cr = set_inspection_status(cr, batch["changed"])
    if with_backfill:
        cr = backfill_sid(cr, feed_part(batch["feed"], "vendor", ["workorder", "inspection_sid"]))
    return {**{t: out[t] for t in ("stg", "queue", "quarantine_ids", "quarantine_queue")}, "cr": cr.select(*CR_INSPECT_COLUMNS)}
