"""The unified inspections view: manholes (MACP), pipes (PACP) and service
connections (LACP) in one typed 45-column table.

Plan: history ⋈ facility_dim (on facility oi) ⋈ task_dim (on task oi). The three
branches are produced by exploding each facility into the branches it belongs to,
so the inputs are scanned and joined once (no triple scan for a UNION ALL).
Hot keys (one facility or task holding a large share of history rows) are split by
AQE's skew-join handling, since the small side of each join is one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_rows
from ..session import materialise
from ..sources.lookups import Lookup
from ..sources.schemas import LAYOUT_COLUMNS
from .spine import facility_dim, facility_rest, history_rows, join_tasks, published, stored_tasks, task_rows, unpack_ids


#: Columns that get their published width and type here; the others have it from their dimension, before the joins.
_LATE = {"work_orders_number", "facility_id", "manhole_number", "pipe_segment_reference", "lateral_segment_reference",
         "work_order_task_uuid", "work_order_uuid", "dr_uuid", "facilityoi", "epdrfacility_oi", "epdrfacilityworkhistoryoi",
         "createdate_dttm", "lastupdate_dttm"}


def to_layout(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Typed projection to the 45 columns: width truncation, casts, order."""
    return df.select(*[published(F.col(c), c).alias(c) if c in _LATE else F.col(c) for c in LAYOUT_COLUMNS], *(carry or []))


def _restrict(src: dict[str, DataFrame], h: DataFrame) -> dict[str, DataFrame]:
    """Sources cut down to what a history slice can reach: tasks and facilities by semi join with the slice's keys,
    attribute tables by semi join with those facilities. The sizes measured at run time decide how they are joined.
    Tasks, by far the widest rows, are cut down by a filter of the keys before they are shuffled."""
    def semi(name: str, k: DataFrame, col: str) -> DataFrame:
        return src[name].join(k.where(F.col(col).isNotNull()).dropDuplicates(), col, "left_semi")

    out = dict(src)
    tasks = h.select(F.col("wotask_oi").alias("workordertaskoi")).dropDuplicates()
    out["workordertask"] = split_rows(src["workordertask"], "workordertaskoi", tasks, "workordertaskoi")[0]
    fac = semi("epdrdrainfacility", h.select(F.col("epdrfacility_oi").alias("epdrdrainagefacilityoi")), "epdrdrainagefacilityoi")
    out["epdrdrainfacility"] = fac
    for name, col in (("epdrmanhole", "manholeid"), ("epdrcatchbasin", "catchbasinid"),
                      ("epdrserviceconnect", "wass_appid")):
        out[name] = semi(name, fac.select(F.col("facilityid").alias(col)), col)
    out["epdrpipe"] = semi("epdrpipe", fac.select(F.col("epdrpipe_oi").alias("epdrpipeoi")), "epdrpipeoi")
    out["epdrunknfac"] = semi("epdrunknfac", fac.select(F.col("epdrunknownf_oi").alias("epdrunknownfacilityoi")), "epdrunknownfacilityoi")
    return out


def unified_inspections(src: dict[str, DataFrame], lookups: dict[str, Lookup],
                        history: DataFrame | None = None, carry: list[str] | None = None, stored: bool = False) -> DataFrame:
    """The unified view.

    ``history`` restricts the work-history rows (e.g. to the keys a change feed inserted); the restriction is applied
    before any join and cuts the task and facility sides down to what the slice reaches. ``carry`` names extra columns
    of ``history`` passed through to the output (after the 45 layout columns). ``stored`` is for the whole view, all columns: the tasks
    and the histories with their facilities are stored before the join of the two, so that the shuffles they took are gone by then.
    Without it nothing is run here, and a query on the view reads only the columns it needs.
    """
    carry = carry or []
    if history is not None:
        h = history_rows({"epdrfacworkhistory": history}, carry)
        src = _restrict(src, h)
    else:
        h = history_rows(src, carry)
    fac = facility_dim(src, lookups)
    if stored and history is None:
        tasks = stored_tasks(src)
        j = materialise(h.join(fac, h["epdrfacility_oi"] == fac["__fac_key"], "inner").drop("__fac_key"))
        j = facility_rest(j.join(tasks, j["wotask_oi"] == tasks["__task_key"], "inner"))
        return to_layout(unpack_ids(j, ["dr_uuid"]), carry)
    j = h.join(fac, h["epdrfacility_oi"] == fac["__fac_key"], "inner")
    if history is not None:     # the few tasks of a slice: read once
        tasks = task_rows(src)
        j = unpack_ids(facility_rest(j.join(tasks, j["wotask_oi"] == tasks["__task_key"], "inner")), ["work_order_task_uuid"])
    else:
        j = join_tasks(j, src, "wotask_oi", between=lambda d: unpack_ids(facility_rest(d), ["work_order_task_uuid"]))
    return to_layout(unpack_ids(j, ["work_order_uuid", "dr_uuid"]), carry)
