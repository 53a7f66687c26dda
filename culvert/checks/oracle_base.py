"""DuckDB SQL building blocks for the independent oracle.

The oracle derives the same domain tables from the driver's parquet views
(lineitem, orders, part, events) with plain SQL, and states the unified view and
the sync rules as set-based SQL. Nothing here runs on Spark.
"""

from __future__ import annotations

from ..sources.fixtures import (ACK_NEW_CYCLE, ACK_OLD_CYCLE, MAT_CYCLE, MHUSE_CYCLE, SHAPE_CYCLE,
                                STG_STATUS_CYCLE, USE_CYCLE, WALL_CYCLE)
from ..sources.lookups import MATERIAL_ROWS, MH_USE_ROWS, SHAPE_ROWS, WALL_ROWS, PIPE_USE_RULES
from ..functions.text import LONGDESC_LITERAL_REPLACES, LONGDESC_REGEX_DELETES


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def pick(values, idx: str) -> str:
    return f"({lst(values)})[({idx}) + 1]"


def sty(e: str) -> str:
    return f"(CASE sty WHEN 0 THEN {e} WHEN 1 THEN lower({e}) ELSE concat('  ', {e}, ' ') END)"


def dec(e: str, scale: str) -> str:
    frac = len(scale.split(".")[1])
    return f"CAST(CAST({e} AS DECIMAL(20,0)) * CAST('{scale}' AS DECIMAL({frac + 1},{frac})) AS DECIMAL(38,10))"


def dashed(h: str) -> str:
    return (f"concat_ws('-', substr({h},1,8), substr({h},9,4), substr({h},13,4), "
            f"substr({h},17,4), substr({h},21,12))")


def values_cte(name: str, rows) -> str:
    body = ", ".join(f"({q(a)}, {q(b)})" for a, b in rows)
    return f"{name}(src_text, code) AS (VALUES {body})"


def _ground(u: str) -> str:
    return f"CASE WHEN {u} = 0 THEN {dec('0', '0.01')} WHEN {u} = 1 THEN NULL ELSE {dec('cents', '0.01')} END"


def _invert(u: str) -> str:
    return (f"CASE WHEN {u} = 1 THEN NULL WHEN {u} = 5 THEN {dec('0', '0.01')} "
            f"ELSE {dec('cents * 1000 - size * 12345', '0.00001')} END")


def _facid(kind: str = "kind") -> str:
    return (f"CASE {kind} WHEN 'MH' THEN concat('MH', p) WHEN 'CB' THEN concat('CB', p) "
            f"WHEN 'SC' THEN concat('SC-', p, '-', p % 5) WHEN 'PIP' THEN concat('PIP', p) "
            f"ELSE concat('X', p) END")


def _title(n: str, o: str, t: str) -> str:
    base = f"concat('Task ', {n}, ' order ', {o})"
    return f"CASE WHEN {t} % 50 = 0 THEN rpad({base}, 450, '~') ELSE {base} END"


FIXTURE_CTES = f"""
g AS (
  SELECT l_orderkey * 10 + l_linenumber AS t, l_orderkey AS o, CAST(l_linenumber AS BIGINT) AS n,
         min(l_partkey) AS tp, CAST(min(l_shipdate) AS TIMESTAMP) AS td
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
pk0 AS (
  SELECT p_partkey AS p, CAST(p_size AS BIGINT) AS size, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
         CAST(CASE p_partkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 WHEN 7 THEN 9 ELSE 10 END AS BIGINT) AS ftype,
         CASE WHEN p_partkey % 8 IN (4, 5, 6) THEN CAST(2 + (p_partkey // 8) % 7 AS BIGINT) END AS ut,
         (p_partkey // 7) % 3 AS sty
  FROM part
),
pk AS (
  SELECT *, CASE WHEN ftype = 1 OR ut = 3 THEN 'MH' WHEN ftype = 2 OR ut = 2 THEN 'CB'
                 WHEN ftype = 4 OR ut IN (6, 7) THEN 'SC' WHEN ftype = 8 OR ut IN (4, 5, 8) THEN 'PIP'
                 ELSE 'X' END AS kind
  FROM pk0
),
workordertask AS (
  SELECT t AS workordertaskoi, o AS workorder_oi, tp AS asset_oi, n AS tasknumber,
         {_title('n', 'o', 't')} AS wotasktitle,
         md5(concat('task-', t)) AS uuid,
         CASE t % 8 WHEN 0 THEN NULL
           WHEN 1 THEN concat('  note ', t, chr(10) || chr(10) || '   ends  ' || chr(9))
           WHEN 2 THEN concat('<p>raw ', t, '</p>')
           WHEN 3 THEN '&lt;b&gt;x&lt;/b&gt;'
           WHEN 4 THEN '&amp;lt;b&amp;gt;x'
           WHEN 5 THEN '&amp;amp;lt;b&amp;amp;gt;x'
           WHEN 6 THEN '&amp;amp;lt;style&amp;amp;gt;q&amp;amp;lt;/style&amp;amp;gt;A &amp; B'
           ELSE concat('it&amp;#39;s&amp;nbsp;', t) END AS longdescript
  FROM g
),
workorders AS (
  SELECT o_orderkey AS workordersoi,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('WO', o_orderkey) END AS wonumber,
         md5(concat('wo-', o_orderkey)) AS uuid,
         CAST(CASE WHEN o_orderkey % 2 = 0 THEN 58 ELSE 57 END AS BIGINT) AS site_oi,
         CAST(o_orderdate AS TIMESTAMP) AS reqcompdate_dttm
  FROM orders WHERE o_orderkey % 11 <> 0
),
asset AS (SELECT p AS assetoi, concat('A-', p) AS assetnumber FROM pk WHERE p % 10 <> 0),
epdrfacworkhistory AS (
  SELECT t + 1000000000 AS epdrfacilityworkhistoryoi, t AS wotask_oi, tp AS epdrfacility_oi,
         td AS createdate_dttm, td AS lastupdate_dttm,
         CASE t % 3 WHEN 0 THEN {dashed("md5(concat('dr-', t))")}
                    WHEN 1 THEN upper({dashed("md5(concat('dr-', t))")})
                    ELSE md5(concat('dr-', t)) END AS uuid
  FROM g WHERE t % 13 <> 0
),
epdrdrainfacility AS (
  SELECT p AS epdrdrainagefacilityoi, {_facid()} AS facilityid, ftype AS facilitytype,
         CASE WHEN kind = 'PIP' THEN p END AS epdrpipe_oi, CASE WHEN ftype = 10 THEN p END AS epdrunknownf_oi
  FROM pk WHERE p % 19 <> 0
),
epdrunknfac AS (SELECT p AS epdrunknownfacilityoi, ut AS unknfactype FROM pk WHERE ftype = 10),
epdrmanhole AS (
  SELECT concat('MH', p) AS manholeid, {sty(pick(MHUSE_CYCLE, 'p % 6'))} AS wwtype,
         concat('NB', p % 40) AS neighbourhd, concat(p, ' Main St') AS location,
         {sty(pick(WALL_CYCLE, 'p % 15'))} AS cone, {sty(pick(WALL_CYCLE, '(p + 5) % 15'))} AS bench,
         {sty(pick(WALL_CYCLE, '(p + 10) % 15'))} AS channel, {sty(pick(SHAPE_CYCLE, 'p % 19'))} AS shape,
         {dec('size', '0.1')} AS diameter_fl, {dec('size', '0.5')} AS depth_fl, {dec('cents', '0.01')} AS groundelevat_fl
  FROM pk WHERE kind = 'MH' AND p % 23 <> 0
),
epdrcatchbasin AS (
  SELECT concat('CB', p) AS catchbasinid, {sty(pick(MHUSE_CYCLE, '(p + 1) % 6'))} AS wwtype,
         concat('NB', p % 40) AS neighbourhd, concat(p, ' Basin Ave') AS location,
         {sty(pick(SHAPE_CYCLE, '(p + 3) % 19'))} AS shape, concat('FC', p % 4) AS framecover,
         {dec('size', '0.1')} AS diameter_fl, {dec('size', '0.5')} AS depth_fl
  FROM pk WHERE kind = 'CB'
),
epdrpipe AS (
  SELECT p AS epdrpipeoi,
         CASE p % 5 WHEN 0 THEN concat('PIP', p) WHEN 1 THEN concat('cbl', p) WHEN 2 THEN 'PIP'
                    WHEN 3 THEN concat('X', p) ELSE NULL END AS pipeid,
         {sty(pick(MAT_CYCLE, 'p % 68'))} AS material, {sty(pick(SHAPE_CYCLE, '(p // 2) % 19'))} AS shape,
         {sty(pick(USE_CYCLE, 'p % 9'))} AS wwtype,
         concat('MH', p + 1) AS usfacilityid, concat('MH', p + 2) AS dsfacilityid,
         concat(p, ' Pipe Rd') AS location, concat('NB', p % 40) AS usneighbour,
         {dec('size', '0.1')} AS diameter_fl,
         {_ground('p % 6')} AS usgroundelev_fl, {_invert('p % 6')} AS usinvertelev_fl,
         {_ground('(p + 3) % 6')} AS dsgroundelev_fl, {_invert('(p + 3) % 6')} AS dsinvertelev_fl,
         {dec('size * 25', '0.1')} AS length_fl, CAST(1950 + p % 70 AS BIGINT) AS yearconst
  FROM pk WHERE kind = 'PIP'
),
epdrserviceconnect AS (
  SELECT {_facid()} AS wass_appid, concat(size, 'mm') AS pipesize, {sty(pick(USE_CYCLE, '(p + 2) % 9'))} AS recordtype,
         concat(p, ' Lane') AS location, concat('NB', p % 40) AS neighbourhd,
         {sty(pick(MAT_CYCLE, '(p * 7) % 68'))} AS pipetype, {dec('size * 15', '0.1')} AS pipelength
  FROM pk WHERE kind = 'SC'
),
{values_cte('lk_mh_use', MH_USE_ROWS)},
{values_cte('lk_shape', SHAPE_ROWS)},
{values_cte('lk_material', MATERIAL_ROWS)},
{values_cte('lk_wall', WALL_ROWS)},
wot_stg AS (
  SELECT md5(concat('task-', t)) AS task_uuid, md5(concat('wo-', o)) AS workorder_uuid,
         left({_title('n', 'o', 't')}, 503) AS wotasktitle,
         CASE WHEN t % 7 = 0 THEN NULL ELSE td END AS plndcompdate_dttm, td AS plndstrtdate_dttm,
         CAST(t % 4 AS BIGINT) AS workclassifi_oi, {pick(STG_STATUS_CYCLE, 't % 5')} AS feed_status,
         CAST(NULL AS TIMESTAMPTZ) AS feed_status_dttm
  FROM g
),
wot_stg1 AS (
  SELECT md5(concat('wo-', o_orderkey)) AS task_uuid, concat('WO ', o_orderkey) AS wotasktitle,
         CAST(o_orderdate AS TIMESTAMP) AS plndcompdate_dttm, CAST(o_orderdate AS TIMESTAMP) AS plndstrtdate_dttm,
         CAST(NULL AS BIGINT) AS workclassifi_oi, 'NEW' AS feed_status
  FROM orders WHERE o_orderkey % 4 = 0
),
feed_history AS (
  SELECT e.event_id AS seq, h.epdrfacilityworkhistoryoi AS history_oi
  FROM events e JOIN epdrfacworkhistory h ON h.wotask_oi // 10 = e.event_id
  WHERE e.event_type = 'signup'
),
feed_workorder AS (
  SELECT e.event_id AS seq, w.uuid AS wo_uuid, w.site_oi,
         CASE WHEN e.event_id % 10 = 0 THEN NULL WHEN e.event_id % 10 = 1 THEN w.reqcompdate_dttm
              ELSE date_trunc('second', CAST(e.ts AS TIMESTAMP)) END AS reqcompdate_dttm
  FROM events e JOIN workorders w ON w.workordersoi = e.user_id
  WHERE e.event_type = 'purchase'
),
feed_queue AS (
  SELECT event_id AS seq, md5(concat('wo-', user_id)) AS queue_uuid,
         {pick(ACK_OLD_CYCLE, '(event_id // 4) % 4')} AS old_status, {pick(ACK_NEW_CYCLE, 'event_id % 4')} AS new_status
  FROM events WHERE event_type = 'click'
),
feed_staging AS (
  SELECT event_id AS seq, CASE WHEN event_id % 6 = 0 THEN md5(concat('new-', event_id)) ELSE md5(concat('task-', user_id * 10 + 1)) END AS task_uuid,
         CASE WHEN event_id % 30 <> 0 THEN md5(concat('wo-', user_id)) END AS workorder_uuid, concat('ST ', event_id) AS wotasktitle,
         CASE WHEN event_id % 10 <> 4 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) END AS plndcompdate_dttm,
         date_trunc('second', CAST(ts AS TIMESTAMP)) AS plndstrtdate_dttm, event_id % 4 AS workclassifi_oi,
         {pick(STG_STATUS_CYCLE, '(event_id // 2) % 5')} AS feed_status
  FROM events WHERE event_type = 'error' AND event_id % 2 = 0
),
feed_inspection AS (
  SELECT event_id AS seq, CASE WHEN event_id % 25 = 1 THEN 'not-hex' WHEN event_id % 25 = 2 THEN NULL
         ELSE upper(md5(concat('task-', user_id * 10 + event_id % 3 + 1))) END AS project_sid,
         md5(concat('wo-', user_id)) AS work_order_uuid, CASE WHEN event_id % 3 = 0 THEN 'SENT' ELSE 'NEW' END AS feed_status
  FROM events WHERE event_type = 'error' AND event_id % 2 = 1
),
feed_vendor AS (
  SELECT event_id AS seq, concat('WO', user_id, '.', event_id % 7 + 1) AS workorder,
         concat('SID-', event_id) AS inspection_sid
  FROM events WHERE event_type = 'view'
)"""


def clean_longdesc_sql(c: str) -> str:
    out = c
    for old, new in LONGDESC_LITERAL_REPLACES:
        out = f"replace({out}, {q(old)}, {q(new)})"
    for pat in LONGDESC_REGEX_DELETES:
        out = f"regexp_replace({out}, {q(pat)}, '', 'g')"
    out = f"regexp_replace({out}, '\\s+', ' ', 'g')"
    out = f"regexp_replace({out}, '^\\s+|\\s+$', '', 'g')"
    out = f"replace({out}, '&amp;', '&')"
    return f"nullif({out}, '')"


def strip_html_sql(c: str) -> str:
    """DuckDB (RE2) has no back-references: the script/style pair is spelled as an alternation."""
    out = f"regexp_replace({c}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?is)<head[^>]*>.*?</head>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?is)<!DOCTYPE[^>]*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?is)<[^>]+>', ' ', 'g')"
    out = f"regexp_replace(trim({out}), '\\s+', ' ', 'g')"
    return f"CASE WHEN {c} IS NOT NULL AND strpos({c}, '<') > 0 THEN nullif({out}, '') ELSE {c} END"


def pipe_use_sql(c: str, with_combined: bool) -> str:
    parts = [f"WHEN upper(trim({c})) = {q(t)} THEN {q(code)}" for t, code in PIPE_USE_RULES
             if with_combined or t != "COMBINED"]
    return "CASE " + " ".join(parts) + " ELSE NULL END"


def canonical_uuid_sql(c: str) -> str:
    bare = f"regexp_replace({c}, '[^0-9A-Fa-f]', '', 'g')"
    dashed_ = (f"regexp_replace({bare}, '^([0-9A-Fa-f]{{8}})([0-9A-Fa-f]{{4}})([0-9A-Fa-f]{{4}})"
               f"([0-9A-Fa-f]{{4}})([0-9A-Fa-f]{{12}})$', '\\1-\\2-\\3-\\4-\\5')")
    return f"nullif(lower({dashed_}), '')"


def grade_sql(g: str, i: str) -> str:
    return (f"CASE WHEN {g} IS NULL OR {i} IS NULL OR {g} = 0 OR {i} = 0 THEN NULL "
            f"ELSE CAST(round({g} - {i}, 4) AS DECIMAL(38,4)) END")


def drop_last_segment_sql(c: str) -> str:
    pos = f"(length({c}) - strpos(reverse({c}), '-') + 1)"
    return f"CASE WHEN strpos(reverse({c}), '-') > 0 AND {pos} > 1 THEN substr({c}, 1, {pos} - 1) ELSE {c} END"


def pipe_base_ref_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN upper({c}) LIKE 'PIP%' OR upper({c}) LIKE 'CBL%' "
            f"THEN nullif(substr({c}, 4), '') ELSE {c} END")


def with_ctes(select: str, extra_ctes: str = "", recursive: bool = False) -> str:
    """A full oracle statement: fixture CTEs, view CTEs, optional extra CTEs, then the select."""
    from .oracle_view import view_ctes
    extra = f",\n{extra_ctes}" if extra_ctes.strip() else ""
    return f"WITH {'RECURSIVE ' if recursive else ''}{FIXTURE_CTES},\n{view_ctes()}{extra}\n{select}"
