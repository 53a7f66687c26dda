"""Schemas of the source relations, the state tables and the unified 45-column layout."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, TS, TSNTZ = T.StringType(), T.LongType(), T.TimestampType(), T.TimestampNTZType()
MEASURE_IN = T.DecimalType(38, 10)      # source measures (exact NUMBER)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "workordertask": _st(("workordertaskoi", L), ("workorder_oi", L), ("asset_oi", L),
                         ("tasknumber", L), ("wotasktitle", S), ("uuid", S), ("longdescript", S)),
    "workorders": _st(("workordersoi", L), ("wonumber", S), ("uuid", S), ("site_oi", L),
                      ("reqcompdate_dttm", TSNTZ)),
    "asset": _st(("assetoi", L), ("assetnumber", S)),
    "epdrfacworkhistory": _st(("epdrfacilityworkhistoryoi", L), ("wotask_oi", L), ("epdrfacility_oi", L),
                              ("createdate_dttm", TSNTZ), ("lastupdate_dttm", TSNTZ), ("uuid", S)),
    "epdrdrainfacility": _st(("epdrdrainagefacilityoi", L), ("facilityid", S), ("facilitytype", L),
                             ("epdrpipe_oi", L), ("epdrunknownf_oi", L)),
    "epdrunknfac": _st(("epdrunknownfacilityoi", L), ("unknfactype", L)),
    "epdrmanhole": _st(("manholeid", S), ("wwtype", S), ("neighbourhd", S), ("location", S), ("cone", S),
                       ("bench", S), ("channel", S), ("shape", S), ("diameter_fl", MEASURE_IN),
                       ("depth_fl", MEASURE_IN), ("groundelevat_fl", MEASURE_IN)),
    "epdrcatchbasin": _st(("catchbasinid", S), ("wwtype", S), ("neighbourhd", S), ("location", S),
                          ("shape", S), ("framecover", S), ("diameter_fl", MEASURE_IN), ("depth_fl", MEASURE_IN)),
    "epdrpipe": _st(("epdrpipeoi", L), ("pipeid", S), ("material", S), ("shape", S), ("wwtype", S),
                    ("usfacilityid", S), ("dsfacilityid", S), ("location", S), ("usneighbour", S),
                    ("diameter_fl", MEASURE_IN), ("usgroundelev_fl", MEASURE_IN), ("usinvertelev_fl", MEASURE_IN),
                    ("dsgroundelev_fl", MEASURE_IN), ("dsinvertelev_fl", MEASURE_IN), ("length_fl", MEASURE_IN),
                    ("yearconst", L)),
    "epdrserviceconnect": _st(("wass_appid", S), ("pipesize", S), ("recordtype", S), ("location", S),
                              ("neighbourhd", S), ("pipetype", S), ("pipelength", MEASURE_IN)),
}

SOURCE_NAMES = list(SOURCE_SCHEMAS)

# State tables. Ids that are RAW(16) upstream are kept as 32 lower-case hex digits.
WOT_STG_SCHEMA = _st(("task_uuid", S), ("workorder_uuid", S), ("wotasktitle", S),
                     ("plndcompdate_dttm", TSNTZ), ("plndstrtdate_dttm", TSNTZ), ("workclassifi_oi", L),
                     ("feed_status", S), ("feed_status_dttm", TS))
WOT_STG1_SCHEMA = _st(("task_uuid", S), ("wotasktitle", S), ("plndcompdate_dttm", TSNTZ),
                      ("plndstrtdate_dttm", TSNTZ), ("workclassifi_oi", L), ("feed_status", S))

# ---------------------------------------------------------------------------
# Unified layout: (column, type, width). Width -> silent truncation with left(c, n).
# Measures are computed exactly in DECIMAL and published as DOUBLE; the grade
# columns are rounded to 4 places before that.
# ---------------------------------------------------------------------------
STR, BIG, DBL, TSN = "string", "bigint", "double", "timestamp_ntz"
LAYOUT = [
    ("work_orders_number", STR, 100),
    ("work_order_task_title", STR, 400),
    ("asset_number", STR, 200),
    ("additional_information", STR, None),
    ("facilityoi", BIG, None),
    ("facility_id", STR, 200),
    ("facility_type", BIG, None),
    ("epdrfacility_oi", BIG, None),
    ("epdrfacilityworkhistoryoi", BIG, None),
    ("createdate_dttm", TSN, None),
    ("lastupdate_dttm", TSN, None),
    ("inspection_type", STR, 20),
    ("pip_type", STR, 200),
    ("pipe_use", STR, 50),
    ("material", STR, 200),
    ("shape", STR, 20),
    ("access_type", STR, 50),
    ("manhole_number", STR, 200),
    ("mh_use", STR, 50),
    ("cover_shape", STR, 20),
    ("wall_material", STR, 20),
    ("bench_material", STR, 20),
    ("channel_material", STR, 20),
    ("wall_bysize", DBL, None),
    ("wall_depth", DBL, None),
    ("elevation", DBL, None),
    ("frame_material", STR, 100),
    ("pipe_segment_reference", STR, 200),
    ("lateral_segment_reference", STR, 200),
    ("upstream_mh", STR, 200),
    ("downstream_mh", STR, 200),
    ("work_order_task_uuid", STR, 100),
    ("work_order_uuid", STR, 100),
    ("dr_uuid", STR, 100),
    ("unknown_type", BIG, None),
    ("height", DBL, None),
    ("up_elevation", DBL, None),
    ("up_grade_to_invert", DBL, None),
    ("down_elevation", DBL, None),
    ("down_grade_to_invert", DBL, None),
    ("street", STR, 400),
    ("total_length", DBL, None),
    ("year_constructed", BIG, None),
    ("size", STR, 100),
    ("drainage_area", STR, 200),
]
LAYOUT_COLUMNS = [c for c, _, _ in LAYOUT]

# Columns of the inspection table (the 44 written by the collector, then the vendor id).
CR_INSPECT_COLUMNS = [
    "project_sid", "inspection_type", "inspectionid", "work_order_uuid", "workorder", "project",
    "po_number", "additional_information", "pipe_segment_reference", "lateral_segment_reference",
    "manhole_number", "material", "pipe_use", "cover_shape", "upstream_mh", "downstream_mh",
    "facility_type", "facility_id", "facilityoi", "pip_type", "shape", "access_type", "mh_use",
    "wall_material", "bench_material", "channel_material", "wall_bysize", "wall_depth", "elevation",
    "frame_material", "height", "up_elevation", "up_grade_to_invert", "down_elevation",
    "down_grade_to_invert", "street", "total_length", "year_constructed", "size", "drainage_area",
    "unknown_type", "createdate_dttm", "lastupdate_dttm", "feed_status", "inspection_sid",
]

# Types of the inspection table: those of the layout, the renamed and added columns are strings.
_LAYOUT_TYPES = {c: t for c, t, _ in LAYOUT}
CR_INSPECT_SCHEMA = ", ".join(f"`{c}` {_LAYOUT_TYPES.get(c, 'string')}" for c in CR_INSPECT_COLUMNS)

# Unified change feed consumed by the sync rules (batch and streaming).
FEED_SCHEMA = _st(("seq", L), ("source", S),
                  ("history_oi", L),                                   # source = history
                  ("wo_uuid", S), ("site_oi", L), ("reqcompdate_dttm", TSNTZ),  # source = workorder
                  ("queue_uuid", S), ("old_status", S), ("new_status", S),      # source = queue
                  ("workorder", S), ("inspection_sid", S),              # source = vendor
                  # source = staging: the whole new row; source = inspection: an inspection row's new status
                  ("task_uuid", S), ("workorder_uuid", S), ("wotasktitle", S), ("plndcompdate_dttm", TSNTZ),
                  ("plndstrtdate_dttm", TSNTZ), ("workclassifi_oi", L), ("feed_status", S),
                  ("inspectionid", S), ("project_sid", S), ("work_order_uuid", S))
