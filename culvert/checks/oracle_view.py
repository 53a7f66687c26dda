"""The unified view for DuckDB, written from the layout table and the classification table of the survey.

A facility enters the branches that ``BRANCHES`` lists for its type. The four attribute tables are brought to one relation
with common column names, so one join attaches the attributes of whatever kind a branch needs; one helper joins the code
books; and the 45 columns are generated from ``LAYOUT``, each with its value and the kinds that have it.
"""

from __future__ import annotations

from ..sources.schemas import LAYOUT
from .oracle_base import clean_longdesc_sql, drop_last_segment_sql, grade_sql, pipe_base_ref_sql, pipe_use_sql, q

#: facility type, unknown type (None: any), branch, kind of attributes, whether the attributes name the segment
BRANCHES = [
    (1, None, "MACP", "manhole", True), (2, None, "MACP", "basin", False), (10, 2, "MACP", "basin", False), (10, 3, "MACP", "manhole", False),
    (8, None, "PACP", "pipe", True), (10, 4, "PACP", "pipe", False), (10, 5, "PACP", "pipe", False),
    (10, 6, "PACP", "pipe", True), (10, 7, "PACP", "pipe", True), (10, 8, "PACP", "pipe", True),
    (4, None, "LACP", "service", True), (10, 6, "LACP", "service", False), (10, 7, "LACP", "service", False),
]

#: kind -> source table and its columns under the common names (own: the id that names the segment)
ATTRIBUTES = {
    "manhole": ("epdrmanhole", dict(link="manholeid", used="wwtype", area="neighbourhd", street="location", outline="shape", cone="cone", bench="bench",
                                    channel="channel", across="diameter_fl", deep="depth_fl", ground="groundelevat_fl")),
    "basin": ("epdrcatchbasin", dict(link="catchbasinid", used="wwtype", area="neighbourhd", street="location", outline="shape", across="diameter_fl", deep="depth_fl", frame="framecover")),
    "pipe": ("epdrpipe", dict(link="CAST(epdrpipeoi AS VARCHAR)", own="pipeid", used="wwtype", area="usneighbour", street="location", outline="shape", stuff="material", across="diameter_fl",
                              up_id="usfacilityid", up="usgroundelev_fl", up_bed="usinvertelev_fl", down_id="dsfacilityid", down="dsgroundelev_fl", down_bed="dsinvertelev_fl",
                              long="length_fl", built="yearconst")),
    "service": ("epdrserviceconnect", dict(link="wass_appid", own="wass_appid", used="recordtype", area="neighbourhd", street="location", stuff="pipetype", long="pipelength", sized="pipesize")),
}

#: output of a code join -> code book, attribute, condition
CODES = {
    "use_code": ("lk_mh_use", "used", "kind IN ('manhole', 'basin')"), "outline_code": ("lk_shape", "outline", "true"), "stuff_code": ("lk_material", "stuff", "true"),
    "cone_code": ("lk_wall", "cone", "named"), "bench_code": ("lk_wall", "bench", "named"), "channel_code": ("lk_wall", "channel", "named"),
}

MANHOLES, PIPES = ("manhole", "basin"), ("pipe",)
#: layout column -> (expression, kinds that have it)
VALUES = {
    "work_orders_number": ("concat(wonumber, '.', tasknumber)", None), "work_order_task_title": ("wotasktitle", None), "asset_number": ("assetnumber", None),
    "additional_information": ("cleaned", None), "facilityoi": ("epdrdrainagefacilityoi", None), "facility_id": ("facilityid", None), "facility_type": ("facilitytype", None),
    "epdrfacility_oi": ("epdrfacility_oi", None), "epdrfacilityworkhistoryoi": ("epdrfacilityworkhistoryoi", None), "createdate_dttm": ("createdate_dttm", None),
    "lastupdate_dttm": ("lastupdate_dttm", None), "inspection_type": ("branch", None), "pip_type": ("CASE kind WHEN 'pipe' THEN 'Pipe' WHEN 'service' THEN 'Service Connection' END", None),
    "pipe_use": (f"CASE kind WHEN 'pipe' THEN {pipe_use_sql('used', True)} WHEN 'service' THEN {pipe_use_sql('used', False)} END", None),
    "material": ("coalesce(stuff_code, stuff)", None), "shape": ("outline_code", PIPES), "access_type": ("CASE kind WHEN 'manhole' THEN 'AMH' ELSE 'ACB' END", MANHOLES),
    "manhole_number": ("nullif(regexp_replace(facilityid, CASE kind WHEN 'manhole' THEN '^MH' ELSE '^CB' END, ''), '')", MANHOLES), "mh_use": ("use_code", None),
    "cover_shape": ("outline_code", MANHOLES), "wall_material": ("cone_code", None), "bench_material": ("bench_code", None), "channel_material": ("channel_code", None),
    "wall_bysize": ("across", MANHOLES), "wall_depth": ("deep", None), "elevation": ("ground", None), "frame_material": ("frame", None),
    "pipe_segment_reference": (f"CASE WHEN NOT named THEN facilityid WHEN kind = 'pipe' THEN {pipe_base_ref_sql('own')} END", (*MANHOLES, *PIPES)),
    "lateral_segment_reference": (f"CASE WHEN named THEN {drop_last_segment_sql('own')} ELSE facilityid END", ("service",)),
    "upstream_mh": ("up_id", None), "downstream_mh": ("down_id", None), "work_order_task_uuid": ("task_uuid", None), "work_order_uuid": ("wo_uuid", None), "dr_uuid": ("dr_uuid", None),
    "unknown_type": ("unknfactype", None), "height": ("across", PIPES), "up_elevation": ("up", None), "up_grade_to_invert": (grade_sql("up", "up_bed"), None),
    "down_elevation": ("down", None), "down_grade_to_invert": (grade_sql("down", "down_bed"), None), "street": ("street", None), "total_length": ("long", None),
    "year_constructed": ("built", None), "size": ("sized", None), "drainage_area": ("area", None),
}
SQL_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def _norm(e: str) -> str:
    return f"upper(trim({e}))"


def _column(name: str, kind: str, width: int | None) -> str:
    value, kinds = VALUES[name]
    if kinds:
        value = f"CASE WHEN kind IN ({', '.join(map(q, kinds))}) THEN {value} END"
    value = f"CAST({value} AS {SQL_TYPE[kind]})" if not kind.startswith("decimal") else f"CAST({value} AS {kind})"
    return f"{f'left({value}, {width})' if width else value} AS {name}"


def view_ctes() -> str:
    members = ", ".join(f"({ft}, {'NULL' if ut is None else ut}, {q(branch)}, {q(kind)}, {str(named).lower()})" for ft, ut, branch, kind, named in BRANCHES)
    attributes = " UNION ALL BY NAME ".join(f"SELECT {q(kind)} AS kind, {', '.join(f'{c} AS {name}' for name, c in columns.items())} FROM {table}" for kind, (table, columns) in ATTRIBUTES.items())
    books = " ".join(f"LEFT JOIN (SELECT {_norm('src_text')} AS k, code AS {out} FROM {book}) {out}_t ON {out}_t.k = CASE WHEN {only} THEN {_norm(raw)} END" for out, (book, raw, only) in CODES.items())
    columns = ",\n    ".join(_column(*c) for c in LAYOUT)
    return f"""
member(ft, ut, branch, member_kind, named) AS (VALUES {members}),
attribute AS ({attributes}),
placed AS (
  SELECT f.*, u.unknfactype, m.branch, m.member_kind, m.named,
         CASE m.member_kind WHEN 'pipe' THEN CAST(f.epdrpipe_oi AS VARCHAR) ELSE f.facilityid END AS member_link
  FROM epdrdrainfacility f LEFT JOIN epdrunknfac u ON u.epdrunknownfacilityoi = f.epdrunknownf_oi
  JOIN member m ON m.ft = f.facilitytype AND (m.ut IS NULL OR m.ut = u.unknfactype)
),
task AS (
  SELECT t.workordertaskoi, t.wotasktitle, t.tasknumber, t.uuid AS task_uuid, w.wonumber, w.uuid AS wo_uuid, s.assetnumber, {clean_longdesc_sql('t.longdescript')} AS cleaned
  FROM workordertask t LEFT JOIN workorders w ON w.workordersoi = t.workorder_oi LEFT JOIN asset s ON s.assetoi = t.asset_oi
),
described AS (
  SELECT h.epdrfacility_oi, h.epdrfacilityworkhistoryoi, h.createdate_dttm, h.lastupdate_dttm, h.uuid AS dr_uuid, t.*,
         p.epdrdrainagefacilityoi, p.facilityid, p.facilitytype, p.unknfactype, p.branch, p.named, p.member_kind, a.* REPLACE (p.member_kind AS kind)
  FROM epdrfacworkhistory h JOIN task t ON t.workordertaskoi = h.wotask_oi JOIN placed p ON p.epdrdrainagefacilityoi = h.epdrfacility_oi
  LEFT JOIN attribute a ON a.kind = p.member_kind AND a.link = p.member_link
),
unified AS (
  SELECT {columns}
  FROM described {books}
)"""
