"""What all events of a batch do to the staging rows and the queue row of their work orders, by aggregates.

The rules fire one after another, yet no step-by-step pass is needed, as the state depends on few of the events:

* Dates. A due-date event changes the rows whose date differs. So a row's date comes from the value it was given last
  (stored or written), the next due-date event, and the last due-date event that differs from the one before it. None of these
  depends on the queue.
* Queue row. It is there exactly if the last event that counts was a firing one (a row turned to NEW or UPDATED: puts it there) and not
  an acknowledgement (takes it away). So the last acknowledgement and the first firing after it give the final row.
  An acknowledgement counts if the queue row is there: the first one after a firing.
* Status. The last of these has the say: the row as written, a due date that changed it, a flag, an acknowledgement that counts.
* A flag does nothing to a row that is UPDATED already. A row that an event made UPDATED has put its work order on the
  queue, where it still is, or an acknowledgement has made it SENT; so such a flag fires without effect. Only rows
  stored as UPDATED differ: their flags count only once there has been a queue row (``weak``).

All of it is grouped by work order, or work order and task, with partial aggregation before each shuffle; only the dates before and after an event
need an order, which ``scan.along`` takes over range partitions. A work order may hold any share of the events or tasks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_by_keys
from ..operators.scan import along
from ..session import materialise, settle

_NO_DATE = _dt.datetime(1900, 1, 1)
_ROW = ["title", "date", "start", "class", "status"]


def _moment(seq: Column, kind: Column, task: Column) -> Column:
    """The place of an event among all events of its work order; stored rows come before all."""
    return F.struct(seq.cast("long").alias("seq"), kind.alias("kind"), F.coalesce(task, F.lit("")).alias("task"))


def _date_key(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(_NO_DATE).cast("timestamp_ntz"))


def _stored(stg: DataFrame) -> DataFrame:
    """(wo, task, o, row columns, s, stamp, stored) of the staging rows before the batch."""
    return stg.select(F.col("workorder_uuid").alias("wo"), F.col("task_uuid").alias("task"), _moment(F.lit(-(1 << 63)), F.lit(""), F.col("task_uuid")).alias("o"),
                      F.col("wotasktitle").alias("title"), F.col("plndcompdate_dttm").alias("date"), F.col("plndstrtdate_dttm").alias("start"), F.col("workclassifi_oi").alias("class"),
                      F.col("feed_status").alias("status"), _date_key("plndcompdate_dttm").alias("s"), F.col("feed_status_dttm").alias("stamp"), F.lit(True).alias("stored"))


def _dated(stg: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(due, base, dated). ``due``: the due-date events (wo, o, d, s) with ``prev``, the one before. ``base``: stored and written rows
    with ``next``, the first due-date event after them. ``dated``: the work orders with such events, each once."""
    ev = events.where(F.col("kind").isin("due", "staging")).select("wo", "seq", "kind", "task", *_ROW, _date_key("date").alias("s"))
    ev = ev.withColumn("o", _moment(F.col("seq"), F.col("kind"), F.col("task")))
    is_due = F.when(F.col("kind") == "due", F.struct("o", F.col("date").alias("d"), "s"))
    ev = settle(lambda: along(ev, ["wo"], ["seq", "kind", "task"], before={"prev": is_due}, after={"next": is_due}))
    due = ev.where(F.col("kind") == "due").select("wo", "o", F.col("date").alias("d"), "s", "prev")
    first = materialise(due.groupBy(F.col("wo").alias("__w")).agg(F.min_by(F.struct("o", "d", "s"), "o").alias("next")))
    old = _looked_up(first, lambda rows: rows, _stored(stg))
    new = ev.where(F.col("kind") == "staging").select("wo", "task", "o", *_ROW, "s", F.lit(None).cast("timestamp").alias("stamp"), F.lit(False).alias("stored"), "next")
    return due, materialise(old.unionByName(new)), first.select("__w")


def _looked_up(table: DataFrame, build: Callable[..., DataFrame], *parts: DataFrame) -> DataFrame:
    """``build(*parts)`` with the columns of ``table``, which has one row for each of a few work orders ``__w``. All is grouped by work
    order, so parts are split by it before, and only the rows of those few are shuffled for the look-up."""
    split = [split_by_keys(p, "wo", table, "__w") for p in parts]
    near, far = build(*[near for near, _ in split]), build(*[far for _, far in split])
    values = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name != "__w"]
    return near.join(table, near["wo"] == table["__w"], "left").drop("__w").unionByName(far.select("*", *values))


def _firing_dates(due: DataFrame, base: DataFrame, dated: DataFrame) -> DataFrame:
    """The due-date events that change some row: of the value before, or one written since then."""
    # of a task's rows with the same next date, the last one meets it
    met = base.where(F.col("next").isNotNull()).groupBy("wo", "task", "next").agg(F.max_by("s", "o").alias("s"))
    met = met.where(F.col("s") != F.col("next.s")).select(F.col("wo").alias("__w"), F.col("next.o").alias("__o")).distinct()
    born = split_by_keys(base, "wo", dated, "__w")[0].groupBy(F.col("wo").alias("__b")).agg(F.min("o").alias("born"))
    j = due.join(met, (due["wo"] == met["__w"]) & (due["o"] == met["__o"]), "left").join(born, due["wo"] == born["__b"], "left")
    turned = (F.col("s") != F.col("prev.s")) & (F.col("born") < F.col("prev.o"))
    return j.where(F.col("__o").isNotNull() | F.coalesce(turned, F.lit(False))).select("wo", "o", "d", "s")


def _flags(events: DataFrame, base: DataFrame) -> DataFrame:
    """(wo, task, o, weak) of the flags on rows that exist by then."""
    flags = events.where(F.col("kind") == "flag").select("wo", "task", _moment(F.col("seq"), F.col("kind"), F.col("task")).alias("o"))
    tasks = base.groupBy(F.col("wo").alias("__w"), F.col("task").alias("__t")).agg(
        F.max("stored").alias("was"), F.max(F.col("stored") & F.col("status").eqNullSafe("UPDATED")).alias("updated"),
        F.min(F.when(~F.col("stored"), F.col("o"))).alias("written"))
    j = flags.join(tasks, (flags["wo"] == tasks["__w"]) & (flags["task"] == tasks["__t"]))
    anew = F.coalesce(F.col("written") < F.col("o"), F.lit(False))
    return j.where(F.col("was") | anew).select("wo", "task", "o", (~anew & F.col("updated")).alias("weak"))


def _join(left: DataFrame, *tables: DataFrame, how: str = "left") -> DataFrame:
    """``left`` with tables of one row for each work order."""
    return reduce(lambda a, b: a.join(b, "wo", how), tables, left)


def _decided(events: DataFrame, queue: DataFrame, fired: DataFrame, acks: DataFrame) -> DataFrame:
    """Per work order: ``queued`` (stored on the queue), ``acked`` (last acknowledgement), ``sent`` (the last one that counts) and ``put``
    (the firing that puts the final queue row there, if the stored one does not stay)."""
    ends = acks.groupBy("wo").agg(F.max("o").alias("acked"), F.min("o").alias("first_ack"))
    strong = fired.where(~F.col("weak")).groupBy("wo").agg(F.min("o").alias("first_fired"))
    queued = queue.select(F.col("task_uuid").alias("wo"), F.lit(True).alias("queued")).distinct()
    wos = _join(events.select("wo").distinct(), ends, strong, queued).withColumn("queued", F.coalesce("queued", F.lit(False)))
    counts = ~F.col("weak") | F.col("queued") | F.coalesce(F.col("o") > F.col("first_fired"), F.lit(False))
    heard = _join(fired, wos, how="inner").where(counts)
    later = F.col("acked").isNull() | (F.col("o") > F.col("acked"))
    put = heard.groupBy("wo").agg(F.min_by(F.when(later, F.struct("o", "kind", "task", "v")), F.when(later, F.col("o"))).alias("put"),
                                  F.max(F.when(F.col("o") < F.col("acked"), F.col("o"))).alias("before"))
    wos = _join(wos, put)
    since = _join(acks, wos.select("wo", "before"), how="inner").where(F.col("o") > F.col("before")).groupBy("wo").agg(F.min("o").alias("__sent"))
    sent = F.when(F.col("before").isNotNull(), F.col("__sent")).when(F.col("queued"), F.col("first_ack"))
    stays = F.col("queued") & F.col("acked").isNull()
    return materialise(_join(wos, since).select("wo", "queued", "acked", sent.alias("sent"), stays.alias("stays"), F.when(~stays, F.col("put")).alias("put")))


def _put_rows(decided: DataFrame, due: DataFrame, base: DataFrame) -> DataFrame:
    """(wo, put columns) of the queue rows put there by a flag or a due date: the values of the first row that fires, as it is then."""
    by = decided.where(F.col("put.kind").isin("due", "flag")).select("wo", "put")
    then = _join(base, by, how="inner").where((F.col("o") < F.col("put.o")) & ((F.col("put.kind") == "due") | (F.col("task") == F.col("put.task"))))
    then = then.groupBy("wo", "task").agg(F.max_by(F.struct("title", "date", "start", "class", "s", "o", "next"), "o").alias("b"))
    past = _join(due, by, how="inner").where(F.col("o") < F.col("put.o"))
    turned = F.col("s") != F.col("prev.s")
    event = F.struct("o", "d", "s")
    past = past.groupBy("wo").agg(F.max_by(event, "o").alias("last"), F.max_by(F.when(turned, event), F.when(turned, F.col("o"))).alias("turn"))
    j = _join(then, by, past)
    now = F.when(F.col("last.o") > F.col("b.o"), F.col("last.s")).otherwise(F.col("b.s"))
    date = F.when(F.col("put.kind") == "due", F.col("put.v.date")).otherwise(_date_then(F.when(F.col("b.next.o") < F.col("put.o"), F.col("b.next")), F.col("turn")))
    j = j.where((F.col("put.kind") == "flag") | (now != F.col("put.v.s")))
    return j.groupBy("wo").agg(F.min_by(F.struct("b.title", date.alias("date"), "b.start", "b.class", F.lit("UPDATED").alias("status")), "task").alias("first"))


def _date_then(following: Column, turn: Column) -> Column:
    """The date of the row ``b``: of the last due date that differs, the next one after the row, or its own."""
    return (F.when(following.isNull(), F.col("b.date")).when(turn["o"] > following["o"], turn["d"])
            .when(following["s"] != F.col("b.s"), following["d"]).otherwise(F.col("b.date")))


def _queue_after(queue: DataFrame, events: DataFrame, acks_too: Column, decided: DataFrame, due: DataFrame, base: DataFrame) -> DataFrame:
    """The queue rows of the work orders after all events."""
    says = events.where((F.col("kind") == "queue") & ~acks_too).select("wo", _moment(F.col("seq"), F.col("kind"), F.col("task")).alias("o"), F.col("status").alias("new"))
    says = _join(says, decided, how="inner").where(F.col("stays") | (F.col("o") > F.col("put.o")))
    says = says.groupBy("wo").agg(F.max_by(F.struct("new"), "o").alias("said"))
    old = queue.select(F.col("task_uuid").alias("wo"), F.struct(F.col("wotasktitle").alias("title"), F.col("plndcompdate_dttm").alias("date"), F.col("plndstrtdate_dttm").alias("start"),
                                                                F.col("workclassifi_oi").alias("class"), F.col("feed_status").alias("status")).alias("r"))
    old = _join(old, decided.where("stays").select("wo"), how="inner")
    written = F.struct(*[F.col(f"put.v.{c}").alias(c) for c in _ROW])
    new = _join(decided.where("put is not null"), _put_rows(decided, due, base)).select("wo", F.coalesce("first", written).alias("r"))
    rows = _join(old.unionByName(new), says)
    status = F.when(F.col("said").isNotNull(), F.col("said.new")).otherwise(F.col("r.status"))
    return rows.select(F.col("wo").alias("task_uuid"), F.col("r.title").alias("wotasktitle"), F.col("r.date").alias("plndcompdate_dttm"),
                       F.col("r.start").alias("plndstrtdate_dttm"), F.col("r.class").alias("workclassifi_oi"), status.alias("feed_status"))


def _tasks_after(decided: DataFrame, due: DataFrame, base: DataFrame, flags: DataFrame) -> DataFrame:
    """The staging rows of the work orders after all events."""
    def latest(base: DataFrame, flags: DataFrame) -> DataFrame:
        last = base.groupBy("wo", "task").agg(F.max_by(F.struct(*_ROW, "s", "o", "next"), "o").alias("b"), F.max(F.when(F.col("stored"), F.col("stamp"))).alias("stamp"))
        flag = flags.groupBy(F.col("wo").alias("__w"), F.col("task").alias("__t")).agg(F.max("o").alias("flagged"))
        return last.join(flag, (last["wo"] == flag["__w"]) & (last["task"] == flag["__t"]), "left").drop("__w", "__t")

    turned = due.where(F.col("s") != F.col("prev.s")).groupBy("wo").agg(F.max_by(F.struct("o", "d", "s"), "o").alias("turn"))
    sent = decided.where(F.col("sent").isNotNull()).select("wo", "sent")
    j = _looked_up(materialise(turned.join(sent, "wo", "full_outer").withColumnRenamed("wo", "__w")), latest, base, flags)
    following, turn = F.col("b.next"), F.col("turn")
    dated = F.when(turn["o"] > following["o"], turn["o"]).when(following["s"] != F.col("b.s"), following["o"])
    said = lambda at, status: F.when(at.isNotNull(), F.struct(at.alias("o"), status.cast("string").alias("status")))
    status = F.greatest(said(F.col("b.o"), F.col("b.status")), said(dated, F.lit("UPDATED")), said(F.col("flagged"), F.lit("UPDATED")), said(F.col("sent"), F.lit("SENT")))
    return j.select(F.col("task").alias("task_uuid"), F.col("wo").alias("workorder_uuid"), F.col("b.title").alias("wotasktitle"), _date_then(following, turn).alias("plndcompdate_dttm"),
                    F.col("b.start").alias("plndstrtdate_dttm"), F.col("b.class").alias("workclassifi_oi"), status["status"].alias("feed_status"), F.col("stamp").alias("feed_status_dttm"))


def apply_events(stg: DataFrame, queue: DataFrame, events: DataFrame, is_ack: Column) -> tuple[DataFrame, DataFrame]:
    """(staging rows, queue rows) of the work orders in ``events`` (see ``rules.work_order_events``) after all of them, given their rows before.
    ``is_ack``: which queue events acknowledge (in terms of old_status and status)."""
    events = events.withColumnRenamed("new_status", "status")
    due, base, dated = _dated(stg, events)
    flags = materialise(_flags(events, base))
    value = F.struct(*_ROW, "s")
    null = F.lit(None).cast("string")
    dates = _firing_dates(due, base, dated).select("wo", "o", F.lit(False).alias("weak"), F.lit("due").alias("kind"), null.alias("task"), F.struct(
        null.alias("title"), F.col("d").alias("date"), F.lit(None).cast("timestamp_ntz").alias("start"), F.lit(None).cast("long").alias("class"), null.alias("status"), "s").alias("v"))
    written = base.where(~F.col("stored") & F.col("status").isin("NEW", "UPDATED")).select("wo", "o", F.lit(False).alias("weak"), F.lit("staging").alias("kind"), "task", value.alias("v"))
    flagged = flags.select("wo", "o", "weak", F.lit("flag").alias("kind"), "task")
    fired = written.unionByName(dates).unionByName(flagged, allowMissingColumns=True)
    acks = events.where((F.col("kind") == "queue") & is_ack).select("wo", _moment(F.col("seq"), F.col("kind"), F.col("task")).alias("o"))
    decided = _decided(events, queue, fired, acks)
    return _tasks_after(decided, due, base, flags), _queue_after(queue, events, is_ack, decided, due, base)
