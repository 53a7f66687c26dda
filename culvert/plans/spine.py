"""The two dimensions the unified view is assembled from.

facility_dim  (part-scale): facility ⟕ unknown-facility, exploded to one row per
              inspection branch, branch-specific attributes attached (manhole,
              catch basin, pipe, service connection), codes looked up, and every
              facility-derived column of the 45-column layout computed, in its published
              type; what follows from other columns of the row is left to ``facility_rest``,
              after the joins, so that it is not shuffled with every history row.
task_dim      (task-scale): task ⟕ asset ⟕ work order, with the long description
              cleaned once per task.

The view is then  history ⋈ facility_dim ⋈ task_dim  (two shuffles of the big
history table). Reordering is exact: every outer join is keyed on a column of its
own side, and the facility outer join is an inner join in effect, because a row
without a facility fails every branch filter (so it is written as one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import ids as I
from ..functions.text import clean_longdesc, fit
from ..operators import classify as K
from ..operators.joins import code_join, left_join_spread_nulls, match_salt, null_salt
from ..session import materialise, settle
from ..sources.lookups import Lookup
from ..sources.schemas import LAYOUT

FACILITY_TYPES = (1, 2, 4, 8, 10)   # implied by the branch filters; pushed to the scan
_PUBLISHED = {c: (t, n) for c, t, n in LAYOUT}


def published(c: Column, name: str) -> Column:
    """``c`` in the width and type of layout column ``name``."""
    t, n = _PUBLISHED[name]
    return fit(c, n).cast(t)


def _attach(df: DataFrame, right: DataFrame, lkey: str, rkey: str, prefix: str, branch: str) -> DataFrame:
    """Left join a branch's attribute table on (lkey = rkey AND inspection_type = branch).

    Columns of ``right`` are prefixed. The join key is paired with the null salt of
    the row (``__salt``) so that null keys spread; the rows of other branches keep
    their key and fail the branch condition, which keeps them balanced.
    """
    r = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns],
                     match_salt(F.col(rkey)).alias(f"__rsalt_{prefix}"))
    cond = ((df[lkey] == r[f"{prefix}{rkey}"]) & (df["__salt"] == r[f"__rsalt_{prefix}"])
            & (df["inspection_type"] == F.lit(branch)))
    return df.join(r, cond, "left")


def facility_dim(src: dict[str, DataFrame], lookups: dict[str, Lookup]) -> DataFrame:
    fac = (src["epdrdrainfacility"]
           .where(F.col("facilitytype").isin(*FACILITY_TYPES))
           .select("epdrdrainagefacilityoi", "facilityid", "facilitytype", "epdrpipe_oi", "epdrunknownf_oi"))
    unk = src["epdrunknfac"].select("epdrunknownfacilityoi", "unknfactype")
    f = left_join_spread_nulls(fac, unk, "epdrunknownf_oi", "epdrunknownfacilityoi",
                               salt_from=["epdrdrainagefacilityoi"])
    f = K.explode_branches(f)

    # Attributes. Manhole, catch basin and service connection all key on facilityid,
    # so one shuffle of the left side serves the three joins.
    buckets = int(f.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    f = f.withColumn("__salt", null_salt(F.col("facilityid"), buckets, F.col("epdrdrainagefacilityoi")))
    f = _attach(f, src["epdrmanhole"], "facilityid", "manholeid", "mh_", "MACP")
    f = _attach(f, src["epdrcatchbasin"], "facilityid", "catchbasinid", "cb_", "MACP")
    f = _attach(f, src["epdrserviceconnect"], "facilityid", "wass_appid", "sc_", "LACP")
    f = f.withColumn("__salt", null_salt(F.col("epdrpipe_oi"), buckets, F.col("epdrdrainagefacilityoi")))
    f = _attach(f, src["epdrpipe"], "epdrpipe_oi", "epdrpipeoi", "p_", "PACP").drop("__salt")

    ft, ut, br = F.col("facilitytype"), F.col("unknfactype"), F.col("inspection_type")
    macp, pacp, lacp = br == "MACP", br == "PACP", br == "LACP"

    # Code lookups (broadcast, bounded size). Keys of other branches are null -> no match.
    f = code_join(f, F.when(macp, F.col("mh_shape")).when(pacp, F.col("p_shape")), lookups["shape"], "shape_code")
    f = code_join(f, F.when(macp, F.col("cb_shape")), lookups["shape"], "cb_shape_code")
    f = code_join(f, F.when(macp, K.pick_by_kind(ft, ut, F.col("cb_wwtype"), F.col("mh_wwtype"))),
                  lookups["mh_use"], "mh_use_code")
    for part in ("cone", "bench", "channel"):
        f = code_join(f, F.when(macp, K.type1_only(ft, ut, F.col(f"mh_{part}"))), lookups["wall"], f"{part}_code")
    f = code_join(f, F.when(pacp, F.col("p_material")).when(lacp, F.col("sc_pipetype")),
                  lookups["material"], "material_code")

    def pick(cb, mh):
        return K.pick_by_kind(ft, ut, F.col(cb), F.col(mh))

    dec = "decimal(38,10)"
    s = F.lit(None).cast("string")
    d = F.lit(None).cast(dec)
    cols = {
        "facility_id": F.col("facilityid"),
        "facility_type": ft,
        "inspection_type": br,
        "pipe_use": F.when(pacp, C.pipe_use_code(F.col("p_wwtype"), True))
                     .when(lacp, C.pipe_use_code(F.col("sc_recordtype"), False)).otherwise(s),
        "material": F.when(pacp, C.code_or_raw(F.col("material_code"), F.col("p_material")))
                     .when(lacp, C.code_or_raw(F.col("material_code"), F.col("sc_pipetype"))).otherwise(s),
        "shape": F.when(pacp, F.col("shape_code")).otherwise(s),
        "mh_use": F.when(macp, F.col("mh_use_code")).otherwise(s),
        "cover_shape": F.when(macp, K.pick_by_kind(ft, ut, F.col("cb_shape_code"), F.col("shape_code"))).otherwise(s),
        "wall_material": F.when(macp, K.type1_only(ft, ut, F.col("cone_code"))).otherwise(s),
        "bench_material": F.when(macp, K.type1_only(ft, ut, F.col("bench_code"))).otherwise(s),
        "channel_material": F.when(macp, K.type1_only(ft, ut, F.col("channel_code"))).otherwise(s),
        "wall_bysize": F.when(macp, pick("cb_diameter_fl", "mh_diameter_fl")).otherwise(d),
        "wall_depth": F.when(macp, pick("cb_depth_fl", "mh_depth_fl")).otherwise(d),
        "elevation": F.when(macp, F.when(K.is_catch_basin(ft, ut), d).otherwise(F.col("mh_groundelevat_fl")))
                      .otherwise(d),
        "frame_material": F.when(macp, F.when(K.is_catch_basin(ft, ut), F.col("cb_framecover"))).otherwise(s),
        "__segment": (F.when(pacp & ~_own_ref(ft, ut, 4, 5), I.pipe_base_ref(F.col("p_pipeid")))
                       .when(lacp & ~_own_ref(ft, ut, 6, 7), I.drop_last_segment(F.col("sc_wass_appid"))).otherwise(s)),
        "upstream_mh": F.when(pacp, F.col("p_usfacilityid")).otherwise(s),
        "downstream_mh": F.when(pacp, F.col("p_dsfacilityid")).otherwise(s),
        "unknown_type": ut,
        "height": F.when(pacp, F.col("p_diameter_fl")).otherwise(d),
        "up_elevation": F.when(pacp, F.col("p_usgroundelev_fl")).otherwise(d),
        "up_grade_to_invert": F.when(pacp, C.grade_to_invert(F.col("p_usgroundelev_fl"), F.col("p_usinvertelev_fl"))),
        "down_elevation": F.when(pacp, F.col("p_dsgroundelev_fl")).otherwise(d),
        "down_grade_to_invert": F.when(pacp, C.grade_to_invert(F.col("p_dsgroundelev_fl"), F.col("p_dsinvertelev_fl"))),
        "street": F.when(macp, pick("cb_location", "mh_location")).when(pacp, F.col("p_location"))
                   .otherwise(F.col("sc_location")),
        "total_length": F.when(pacp, F.col("p_length_fl")).when(lacp, F.col("sc_pipelength")).otherwise(d),
        "year_constructed": F.when(pacp, F.col("p_yearconst")),
        "size": F.when(lacp, F.col("sc_pipesize")).otherwise(s),
        "drainage_area": F.when(macp, pick("cb_neighbourhd", "mh_neighbourhd")).when(pacp, F.col("p_usneighbour"))
                          .otherwise(F.col("sc_neighbourhd")),
    }
    # not cut yet: what facility_rest takes from
    return f.select(F.col("epdrdrainagefacilityoi").alias("__fac_key"),
                    *[(c if n in ("facility_id", "__segment") else published(c, n)).alias(n) for n, c in cols.items()])


def _own_ref(ft: Column, ut: Column, *kinds: int) -> Column:
    """True for unknown facilities of these kinds, whose own id is their segment reference."""
    return F.coalesce((ft == 10) & ut.isin(*kinds), F.lit(False))


def facility_rest(df: DataFrame) -> DataFrame:
    """The layout columns that follow from other columns of a history row and its ``facility_dim`` row, added after the joins."""
    ft, ut, br, fid = F.col("facility_type"), F.col("unknown_type"), F.col("inspection_type"), F.col("facility_id")
    macp, pacp, lacp = br == "MACP", br == "PACP", br == "LACP"
    return df.withColumns({
        "facilityoi": F.col("epdrfacility_oi"),     # the key they were joined by
        "pip_type": F.when(pacp, "Pipe").when(lacp, "Service Connection"),
        "access_type": F.when(macp, K.access_type(ft, ut)),
        "manhole_number": F.when(macp, F.when((ft == 1) | ((ft == 10) & (ut == 3)), I.strip_prefix(fid, "MH"))
                                 .when((ft == 2) | ((ft == 10) & (ut == 2)), I.strip_prefix(fid, "CB"))),
        "pipe_segment_reference": (F.when(macp, F.when(K.not_type1(ft, ut), fid))
                                   .when(pacp, F.when(_own_ref(ft, ut, 4, 5), fid).otherwise(F.col("__segment")))),
        "lateral_segment_reference": F.when(lacp, F.when(_own_ref(ft, ut, 6, 7), fid).otherwise(F.col("__segment"))),
    }).drop("__segment")


def _task_texts(src: dict[str, DataFrame]) -> DataFrame:
    """Tasks as they are shuffled: texts cleaned and cut to their published width where they are read, ids packed."""
    return src["workordertask"].select(
        F.col("workordertaskoi").alias("__task_key"), "workorder_oi", "asset_oi", "tasknumber",
        published(F.col("wotasktitle"), "work_order_task_title").alias("work_order_task_title"),
        published(clean_longdesc(F.col("longdescript")), "additional_information").alias("additional_information"),
        I.pack_id(F.col("uuid")).alias("work_order_task_uuid"))


def _with_links(t: DataFrame, src: dict[str, DataFrame]) -> DataFrame:
    """``t`` ⟕ asset ⟕ work order, which brings the most bytes and so comes last."""
    wo = src["workorders"].select("workordersoi", F.col("wonumber"), I.pack_id(F.col("uuid")).alias("work_order_uuid"))
    asset = src["asset"].select("assetoi", published(F.col("assetnumber"), "asset_number").alias("asset_number"))
    t = left_join_spread_nulls(t, asset, "asset_oi", "assetoi", salt_from=["__task_key"])
    return left_join_spread_nulls(t, wo, "workorder_oi", "workordersoi", salt_from=["__task_key"])


def _task_columns(t: DataFrame, *kept: str) -> DataFrame:
    return t.select(*kept, I.task_number(F.col("wonumber"), F.col("tasknumber")).alias("work_orders_number"),
                    "work_order_task_title", "asset_number", "additional_information", "work_order_task_uuid", "work_order_uuid")


def task_rows(src: dict[str, DataFrame]) -> DataFrame:
    """``task_dim`` with its ids packed (``unpack_ids`` restores them)."""
    return _task_columns(_with_links(_task_texts(src), src), "__task_key")


def join_tasks(df: DataFrame, src: dict[str, DataFrame], key: str, between: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` JOIN ``task_rows`` ON key = __task_key, for all tasks: only the keys of a task go by way of its asset and work
    order, and its texts are shuffled once, to ``df``. ``between`` maps the rows after the first of the two joins, the one with
    the texts, so that the generated code of a step stays small enough to be compiled by the JVM.

    The keys pass as distinct triples and meet the texts on the whole triple, so tasks, assets and work orders that repeat
    give the rows of the plain joins. All three sides are dealt by the task key alone: the rest of the triple is written so
    that it is no join key, which would deal the wide rows once more."""
    texts, links = _texts_and_links(src)
    j = between(df.join(texts, F.col(key) == F.col("__task_key")))
    kept = [c for c in j.columns if c not in texts.columns]
    return _task_columns(j.join(links, _same_task(links)), *kept)


def _texts_and_links(src: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Tasks as they are shuffled, and their distinct keys with what asset and work order bring."""
    texts = _task_texts(src).where(F.col("__task_key").isNotNull())
    links = _with_links(texts.select("__task_key", "workorder_oi", "asset_oi").distinct(), src)
    return texts, links.withColumnsRenamed({"__task_key": "__l_key", "workorder_oi": "__l_wo", "asset_oi": "__l_asset"})


def _same_task(links: DataFrame) -> Column:
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.col(a).isNull() & F.col(b).isNull())
    return (F.col("__task_key") == links["__l_key"]) & same("workorder_oi", "__l_wo") & same("asset_oi", "__l_asset")


def stored_tasks(src: dict[str, DataFrame]) -> DataFrame:
    """``task_dim`` as a stored table in buckets of the task key, for all tasks with one (see ``join_tasks`` for the way of their keys)."""
    texts, links = _texts_and_links(src)

    def rows() -> DataFrame:
        link = materialise(links)
        return unpack_ids(_task_columns(texts.join(link, _same_task(link)), "__task_key"), ["work_order_task_uuid", "work_order_uuid"])

    return settle(rows, "__task_key")


def task_dim(src: dict[str, DataFrame]) -> DataFrame:
    return unpack_ids(task_rows(src), ["work_order_task_uuid", "work_order_uuid"])


def unpack_ids(df: DataFrame, names: list[str]) -> DataFrame:
    """Ids packed for the joins as text again."""
    return df.withColumns({n: I.unpack_id(F.col(n)) for n in names})


def history_rows(src: dict[str, DataFrame], carry: list[str] | None = None) -> DataFrame:
    """Work-history rows that can reach the view (both inner-join keys present), ids packed."""
    return (src["epdrfacworkhistory"]
            .where(F.col("wotask_oi").isNotNull() & F.col("epdrfacility_oi").isNotNull())
            .select("epdrfacilityworkhistoryoi", "wotask_oi", "epdrfacility_oi", "createdate_dttm",
                    "lastupdate_dttm", I.pack_id(F.col("uuid")).alias("dr_uuid"), *(carry or [])))
