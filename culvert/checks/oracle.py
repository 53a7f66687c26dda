"""DuckDB oracle statements, one per registered query key (same column names)."""

from __future__ import annotations

from ..sources.schemas import CR_INSPECT_COLUMNS, SOURCE_NAMES
from .oracle_base import (canonical_uuid_sql, clean_longdesc_sql, drop_last_segment_sql, grade_sql,
                          pipe_base_ref_sql, pipe_use_sql, strip_html_sql, with_ctes)

H = "epdrfacilityworkhistoryoi"


def _valid_hex(c: str) -> str:
    return f"regexp_full_match(upper(replace({c}, '-', '')), '[0-9A-F]*')"


def _raw_key(c: str) -> str:
    return f"lower(upper(replace({c}, '-', '')))"


STG_COLS = ("task_uuid, workorder_uuid, wotasktitle, plndcompdate_dttm, plndstrtdate_dttm, workclassifi_oi, "
            "feed_status, feed_status_dttm")
Q_COLS = "task_uuid, wotasktitle, plndcompdate_dttm, plndstrtdate_dttm, workclassifi_oi, feed_status"

# ---- shared CTE fragments of the sync rules -------------------------------------------------

ACK_CTES = """
ack_keys AS (
  SELECT DISTINCT f.queue_uuid AS key FROM feed_queue f
  WHERE f.queue_uuid IS NOT NULL
    AND nullif(trim(upper(f.new_status)), '') IN ('SEND', 'SENT')
    AND (f.old_status IS NULL OR nullif(trim(upper(f.old_status)), '') NOT IN ('SEND', 'SENT'))
    AND EXISTS (SELECT 1 FROM wot_stg1 q WHERE q.task_uuid = f.queue_uuid)
),
stg_ack AS (
  SELECT task_uuid, workorder_uuid, wotasktitle, plndcompdate_dttm, plndstrtdate_dttm, workclassifi_oi,
         CASE WHEN EXISTS (SELECT 1 FROM ack_keys k WHERE k.key = s.workorder_uuid) THEN 'SENT' ELSE feed_status END
           AS feed_status, feed_status_dttm
  FROM wot_stg s
),
q_last AS (SELECT queue_uuid, arg_max(new_status, seq) AS ns FROM feed_queue WHERE queue_uuid IS NOT NULL GROUP BY queue_uuid),
queue_ack AS (
  SELECT q.task_uuid, q.wotasktitle, q.plndcompdate_dttm, q.plndstrtdate_dttm, q.workclassifi_oi,
         CASE WHEN l.queue_uuid IS NOT NULL THEN l.ns ELSE q.feed_status END AS feed_status
  FROM wot_stg1 q LEFT JOIN q_last l ON l.queue_uuid = q.task_uuid
  WHERE NOT EXISTS (SELECT 1 FROM ack_keys k WHERE k.key = q.task_uuid)
)"""

CR_SELECT = ", ".join(CR_INSPECT_COLUMNS)
COLLECT_CTES = f"""
hkeys AS (SELECT history_oi, min(seq) AS seq FROM feed_history WHERE history_oi IS NOT NULL GROUP BY history_oi),
crn0 AS (
  SELECT {canonical_uuid_sql('work_order_task_uuid')} AS project_sid, inspection_type,
         {canonical_uuid_sql('dr_uuid')} AS inspectionid, {canonical_uuid_sql('work_order_uuid')} AS work_order_uuid,
         work_orders_number AS workorder, work_order_task_title AS project, asset_number AS po_number,
         additional_information, pipe_segment_reference, lateral_segment_reference, manhole_number, material,
         pipe_use, cover_shape, upstream_mh, downstream_mh, facility_type, facility_id, facilityoi, pip_type,
         shape, access_type, mh_use, wall_material, bench_material, channel_material, wall_bysize, wall_depth,
         elevation, frame_material, height, up_elevation, up_grade_to_invert, down_elevation,
         down_grade_to_invert, street, total_length, year_constructed, size, drainage_area, unknown_type,
         createdate_dttm, lastupdate_dttm, 'NEW' AS feed_status, CAST(NULL AS VARCHAR) AS inspection_sid,
         dr_uuid AS raw_dr, CAST({H} AS VARCHAR) AS key_txt, k.seq AS hseq
  FROM unified u JOIN hkeys k ON k.history_oi = u.{H}
),
crn AS (
  SELECT * REPLACE ({strip_html_sql('additional_information')} AS additional_information)
  FROM crn0 c1
  WHERE NOT EXISTS (SELECT 1 FROM crn0 c2 WHERE c2.inspectionid = c1.raw_dr AND (c2.hseq, c2.key_txt) < (c1.hseq, c1.key_txt))
)"""

REFLAG_CTES = f"""
rkeys AS (
  SELECT {_raw_key('project_sid')} AS t, {_raw_key('work_order_uuid')} AS w, min(hseq) AS s
  FROM crn WHERE feed_status = 'NEW' AND {_valid_hex('project_sid')} AND {_valid_hex('work_order_uuid')}
  GROUP BY 1, 2
)"""


def reflag_sql(stg: str) -> str:
    return f"""
  SELECT s.task_uuid, s.workorder_uuid, s.wotasktitle, s.plndcompdate_dttm, s.plndstrtdate_dttm, s.workclassifi_oi,
         CASE WHEN r.t IS NOT NULL AND coalesce(s.feed_status, '~') <> 'UPDATED' THEN 'UPDATED' ELSE s.feed_status END
           AS feed_status, s.feed_status_dttm,
         CASE WHEN r.t IS NOT NULL AND coalesce(s.feed_status, '~') <> 'UPDATED' THEN r.s END AS chg
  FROM {stg} s LEFT JOIN rkeys r ON r.t = s.task_uuid AND r.w = s.workorder_uuid"""


DUE_CTES = """
wf AS (
  SELECT seq, wo_uuid, reqcompdate_dttm AS d, coalesce(reqcompdate_dttm, TIMESTAMP '1900-01-01 00:00:00') AS s
  FROM feed_workorder WHERE site_oi = 58 AND wo_uuid IS NOT NULL
),
wl AS (
  SELECT *, lag(s) OVER (PARTITION BY wo_uuid ORDER BY seq) AS prev_s,
         row_number() OVER (PARTITION BY wo_uuid ORDER BY seq) AS rn
  FROM wf
),
wsum0 AS (
  SELECT wo_uuid, max(CASE WHEN rn = 1 THEN s END) AS first_s, max(CASE WHEN rn = 1 THEN seq END) AS first_seq,
         coalesce(bool_or(rn > 1 AND prev_s <> s), false) AS any_later,
         max(CASE WHEN rn > 1 AND prev_s <> s THEN seq END) AS run_seq
  FROM wl GROUP BY wo_uuid
),
wsum AS (
  SELECT w.*, f.d AS first_d, r.d AS run_d
  FROM wsum0 w JOIN wf f ON f.wo_uuid = w.wo_uuid AND f.seq = w.first_seq
  LEFT JOIN wf r ON r.wo_uuid = w.wo_uuid AND r.seq = w.run_seq
)"""


def due_sql(stg: str, chg_in: bool) -> str:
    c1 = ("(w.wo_uuid IS NOT NULL AND coalesce(s.plndcompdate_dttm, TIMESTAMP '1900-01-01 00:00:00') <> w.first_s)")
    later = "coalesce(w.any_later, false)"
    seq = f"CASE WHEN {c1} THEN w.first_seq WHEN {later} THEN w.run_seq END"
    chg = f"CASE WHEN s.chg IS NULL THEN {seq} WHEN ({seq}) IS NULL THEN s.chg ELSE least(s.chg, {seq}) END" \
        if chg_in else seq
    return f"""
  SELECT s.task_uuid, s.workorder_uuid, s.wotasktitle,
         CASE WHEN {later} THEN w.run_d WHEN {c1} THEN w.first_d ELSE s.plndcompdate_dttm END AS plndcompdate_dttm,
         s.plndstrtdate_dttm, s.workclassifi_oi,
         CASE WHEN {c1} OR {later} THEN 'UPDATED' ELSE s.feed_status END AS feed_status, s.feed_status_dttm,
         {chg} AS chg
  FROM {stg} s LEFT JOIN wsum w ON w.wo_uuid = s.workorder_uuid"""


def enqueue_sql(queue: str, stg: str, changed_only: bool) -> str:
    where = "chg IS NOT NULL AND " if changed_only else ""
    order = "chg, task_uuid" if changed_only else "task_uuid"
    return f"""
eq_cand AS (SELECT * FROM {stg} WHERE {where}feed_status IN ('NEW', 'UPDATED') AND workorder_uuid IS NOT NULL),
eq_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY workorder_uuid ORDER BY {order}) AS rn FROM eq_cand)
  WHERE rn = 1
),
eq_new AS (
  SELECT workorder_uuid AS task_uuid, wotasktitle, plndcompdate_dttm, plndstrtdate_dttm, workclassifi_oi, feed_status
  FROM eq_first f WHERE NOT EXISTS (SELECT 1 FROM {queue} q WHERE q.task_uuid = f.workorder_uuid)
),
eq_out AS (SELECT {Q_COLS} FROM {queue} UNION ALL SELECT {Q_COLS} FROM eq_new)"""


def _u(select: str, extra: str = "") -> str:
    return with_ctes(select, extra)


def _sent(c: str) -> str:
    return f"nullif(trim(upper({c})), '') IN ('SEND', 'SENT')"


NO_DATE = "TIMESTAMP '1900-01-01 00:00:00'"
FIRED = ", ".join(f"first_value({c}2) OVER (PARTITION BY wo ORDER BY fire DESC, task) AS f_{c}" for c in ("title", "pc", "ps", "cls", "st"))
KEPT = ", ".join(f"CASE WHEN q_keep THEN {'q_st2' if c == 'st' else 'q_' + c} WHEN w_fire THEN f_{c} END AS q_{c}" for c in ("title", "pc", "ps", "cls", "st"))

# The cascade one event at a time: every work order steps through its events in the order of seq.
CASCADE_CTES = f"""{COLLECT_CTES},
flags AS (
  SELECT project_sid, work_order_uuid, hseq AS seq FROM crn WHERE feed_status = 'NEW'
  UNION ALL SELECT project_sid, work_order_uuid, seq FROM feed_inspection WHERE feed_status = 'NEW'
),
step0 AS (
  SELECT queue_uuid AS wo, seq, 'queue' AS kind, CAST(NULL AS VARCHAR) AS task, CAST(NULL AS TIMESTAMP) AS d, old_status, new_status,
         CAST(NULL AS VARCHAR) AS title, CAST(NULL AS TIMESTAMP) AS start, CAST(NULL AS BIGINT) AS cls FROM feed_queue
  UNION ALL SELECT wo_uuid, seq, 'due', NULL, reqcompdate_dttm, NULL, NULL, NULL, NULL, NULL FROM feed_workorder WHERE site_oi = 58
  UNION ALL SELECT DISTINCT {_raw_key('work_order_uuid')}, seq, 'flag', {_raw_key('project_sid')}, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT) FROM flags WHERE {_valid_hex('project_sid')} AND {_valid_hex('work_order_uuid')}
  UNION ALL SELECT workorder_uuid, seq, 'staging', task_uuid, plndcompdate_dttm, NULL, feed_status, wotasktitle, plndstrtdate_dttm, workclassifi_oi FROM feed_staging
),
step AS (SELECT *, row_number() OVER (PARTITION BY wo ORDER BY seq, kind, coalesce(task, '')) AS n FROM step0 WHERE wo IS NOT NULL),
start AS (
  SELECT workorder_uuid AS wo, task_uuid AS task, true AS present, wotasktitle AS title, plndcompdate_dttm AS pc, plndstrtdate_dttm AS ps, workclassifi_oi AS cls, feed_status AS st
  FROM wot_stg WHERE workorder_uuid IN (SELECT wo FROM step)
  UNION ALL SELECT DISTINCT wo, task, false, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
  FROM step WHERE kind = 'staging' AND task NOT IN (SELECT task_uuid FROM wot_stg WHERE task_uuid IS NOT NULL)
  UNION ALL SELECT DISTINCT wo, CAST(NULL AS VARCHAR), false, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM step
),
walk AS (
  SELECT CAST(0 AS BIGINT) AS n, s.*, q.task_uuid IS NOT NULL AS q_in, q.wotasktitle AS q_title, q.plndcompdate_dttm AS q_pc, q.plndstrtdate_dttm AS q_ps, q.workclassifi_oi AS q_cls, q.feed_status AS q_st
  FROM start s LEFT JOIN wot_stg1 q ON q.task_uuid = s.wo
  UNION ALL
  SELECT n, wo, task, present2, title2, pc2, ps2, cls2, st2, q_keep OR w_fire, {KEPT}
  FROM (
    SELECT *, bool_or(fire) OVER (PARTITION BY wo) AS w_fire, {FIRED}
    FROM (
      SELECT e.n, w.wo, w.task, w.present OR own AS present2, CASE WHEN own THEN e.title ELSE w.title END AS title2,
             CASE WHEN own OR due THEN e.d ELSE pc END AS pc2, CASE WHEN own THEN e.start ELSE ps END AS ps2, CASE WHEN own THEN e.cls ELSE w.cls END AS cls2,
             CASE WHEN own THEN e.new_status WHEN due OR flag THEN 'UPDATED' WHEN gone AND w.present THEN 'SENT' ELSE st END AS st2,
             due OR flag OR (own AND coalesce(e.new_status IN ('NEW', 'UPDATED'), false)) AS fire,
             q_in AND NOT gone AS q_keep, CASE WHEN e.kind = 'queue' THEN e.new_status ELSE q_st END AS q_st2, q_title, q_pc, q_ps, q_cls, q_st
      FROM (
        SELECT w.*, e.n AS en, coalesce(e.kind = 'staging' AND e.task = w.task, false) AS own,
               e.kind = 'due' AND w.present AND coalesce(w.pc, {NO_DATE}) <> coalesce(e.d, {NO_DATE}) AS due,
               coalesce(e.kind = 'flag' AND w.present AND e.task = w.task AND coalesce(w.st, '~') <> 'UPDATED', false) AS flag,
               coalesce(e.kind = 'queue' AND w.q_in AND {_sent('e.new_status')} AND (e.old_status IS NULL OR NOT {_sent('e.old_status')}), false) AS gone
        FROM walk w JOIN step e ON e.wo = w.wo AND e.n = w.n + 1
      ) w JOIN step e ON e.wo = w.wo AND e.n = w.en
    )
  )
),
done AS (SELECT w.* FROM walk w JOIN (SELECT wo, max(n) AS n FROM step GROUP BY wo) x ON x.wo = w.wo AND x.n = w.n),
stg_out AS (
  SELECT task AS task_uuid, wo AS workorder_uuid, title AS wotasktitle, pc AS plndcompdate_dttm, ps AS plndstrtdate_dttm, cls AS workclassifi_oi, st AS feed_status, CAST(NULL AS TIMESTAMPTZ) AS feed_status_dttm
  FROM done WHERE present
  UNION ALL SELECT {STG_COLS} FROM wot_stg WHERE workorder_uuid IS NULL OR workorder_uuid NOT IN (SELECT wo FROM step)
  UNION ALL SELECT task_uuid, workorder_uuid, wotasktitle, plndcompdate_dttm, plndstrtdate_dttm, workclassifi_oi, feed_status, CAST(NULL AS TIMESTAMPTZ) FROM feed_staging WHERE workorder_uuid IS NULL
),
queue_out AS (
  SELECT wo AS task_uuid, q_title AS wotasktitle, q_pc AS plndcompdate_dttm, q_ps AS plndstrtdate_dttm, q_cls AS workclassifi_oi, q_st AS feed_status FROM done WHERE task IS NULL AND q_in
  UNION ALL SELECT {Q_COLS} FROM wot_stg1 WHERE task_uuid NOT IN (SELECT wo FROM step)
)"""


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    o["src_scan_counts"] = _u(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in SOURCE_NAMES))
    o["lookup_mh_use"] = _u("""
SELECT r.src_id, r.wwtype, m.code AS mh_use
FROM (SELECT manholeid AS src_id, wwtype FROM epdrmanhole UNION ALL SELECT catchbasinid, wwtype FROM epdrcatchbasin) r
LEFT JOIN lk_mh_use m ON upper(trim(m.src_text)) = upper(trim(r.wwtype))""")
    o["lookup_shape"] = _u("""
SELECT p.epdrpipeoi, p.shape, s.code AS shape_code
FROM epdrpipe p LEFT JOIN lk_shape s ON upper(trim(s.src_text)) = upper(trim(p.shape))""")
    o["lookup_material"] = _u("""
SELECT c.wass_appid, c.pipetype, m.code AS material_code
FROM epdrserviceconnect c LEFT JOIN lk_material m ON upper(trim(m.src_text)) = upper(trim(c.pipetype))""")
    o["lookup_wall"] = _u("""
SELECT h.manholeid, h.cone, h.bench, h.channel, a.code AS cone_code, b.code AS bench_code, c.code AS channel_code
FROM epdrmanhole h
LEFT JOIN lk_wall a ON upper(trim(a.src_text)) = upper(trim(h.cone))
LEFT JOIN lk_wall b ON upper(trim(b.src_text)) = upper(trim(h.bench))
LEFT JOIN lk_wall c ON upper(trim(c.src_text)) = upper(trim(h.channel))""")
    o["lookup_listing"] = _u("""
SELECT m.code, upper(trim(r.raw)) AS src_text, count(*) AS n
FROM (SELECT material AS raw FROM epdrpipe UNION ALL SELECT pipetype FROM epdrserviceconnect) r
LEFT JOIN lk_material m ON upper(trim(m.src_text)) = upper(trim(r.raw))
GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST""")
    o["view_registered"] = _u("SELECT inspection_type, count(*) AS n FROM unified GROUP BY inspection_type")
    outbound = """
SELECT inspection_type, pip_type, work_order_uuid AS project_sid, inspectionid, workorder, project, po_number,
  additional_information AS additional_info, pipe_segment_reference, lateral_segment_reference, manhole_number,
  material, pipe_use, cover_shape, upstream_mh, downstream_mh, facility_type, facility_id, facilityoi, shape,
  access_type, mh_use, wall_material, bench_material, channel_material, wall_bysize, wall_depth, elevation,
  frame_material, height, up_elevation, up_grade_to_invert, down_elevation, down_grade_to_invert, street,
  'Edmonton' AS city, total_length, year_constructed, size, drainage_area, feed_status
FROM crn WHERE feed_status = 'NEW'"""
    o["outbound_extract"] = _u(outbound, COLLECT_CTES)
    o["outbound_since"] = _u(f"{outbound} AND hseq > (SELECT max(seq) // 2 FROM feed_history)", COLLECT_CTES)
    o["layout_cast"] = _u("""
SELECT inspection_type, count(*) AS n, max(length(work_order_task_title)) AS max_title_len,
  count(pip_type) AS n_pip_type, count(access_type) AS n_access_type, count(shape) AS n_shape,
  count(height) AS n_height, count(size) AS n_size, count(wall_bysize) AS n_wall_bysize
FROM unified GROUP BY inspection_type""")
    fac_unk = """(SELECT f.epdrdrainagefacilityoi, f.facilitytype, u.unknfactype
       FROM epdrdrainfacility f LEFT JOIN epdrunknfac u ON f.epdrunknownf_oi = u.epdrunknownfacilityoi)"""
    o["classify_kinds"] = _u(f"""
SELECT epdrdrainagefacilityoi, facilitytype, unknfactype,
  coalesce(facilitytype IN (1, 2) OR (facilitytype = 10 AND unknfactype IN (2, 3)), false) AS is_macp,
  coalesce(facilitytype = 8 OR (facilitytype = 10 AND unknfactype IN (4, 5, 6, 7, 8)), false) AS is_pacp,
  coalesce(facilitytype = 4 OR (facilitytype = 10 AND unknfactype IN (6, 7)), false) AS is_lacp
FROM {fac_unk}""")
    o["access_type"] = _u(f"""
SELECT epdrdrainagefacilityoi,
  CASE WHEN facilitytype = 10 AND unknfactype = 3 THEN 'AMH' WHEN facilitytype = 10 AND unknfactype = 2 THEN 'ACB'
       WHEN facilitytype = 1 THEN 'AMH' WHEN facilitytype = 2 THEN 'ACB' END AS access_type
FROM {fac_unk}""")
    o["pick_by_kind"] = _u(f"""
SELECT {H}, facility_type, unknown_type, street, drainage_area, wall_bysize, wall_depth, elevation, frame_material,
  cover_shape FROM unified WHERE inspection_type = 'MACP'""")
    o["wall_bench_channel"] = _u(f"""
SELECT {H}, facility_type, unknown_type, wall_material, bench_material, channel_material
FROM unified WHERE inspection_type = 'MACP'""")
    o["segment_refs"] = _u(f"SELECT {H}, inspection_type, pipe_segment_reference, lateral_segment_reference FROM unified")
    o["null_safe_changed"] = _u("""
SELECT s.task_uuid, coalesce(s.plndcompdate_dttm, TIMESTAMP '1900-01-01') <> coalesce(w.reqcompdate_dttm, TIMESTAMP '1900-01-01')
  AS changed
FROM wot_stg s JOIN workorders w ON s.workorder_uuid = w.uuid""")
    o["status_transition"] = _u("""
SELECT seq, queue_uuid, old_status, new_status,
  coalesce(nullif(trim(upper(new_status)), '') IN ('SEND', 'SENT')
           AND (old_status IS NULL OR nullif(trim(upper(old_status)), '') NOT IN ('SEND', 'SENT')), false) AS is_transition
FROM feed_queue""")
    o["spine_inner"] = _u(f"""
SELECT e.{H}, a.workordertaskoi, a.tasknumber FROM epdrfacworkhistory e JOIN workordertask a ON e.wotask_oi = a.workordertaskoi""")
    o["spine_left"] = _u("""
SELECT a.workordertaskoi, concat(wo.wonumber, '.', a.tasknumber) AS work_orders_number, s.assetnumber AS asset_number,
  wo.uuid AS work_order_uuid
FROM workordertask a LEFT JOIN workorders wo ON a.workorder_oi = wo.workordersoi LEFT JOIN asset s ON a.asset_oi = s.assetoi""")
    o["spine_facility"] = _u(f"""
SELECT e.{H}, e1.epdrdrainagefacilityoi AS facilityoi, e1.facilitytype, ep2.unknfactype
FROM epdrfacworkhistory e
LEFT JOIN epdrdrainfacility e1 ON e.epdrfacility_oi = e1.epdrdrainagefacilityoi
LEFT JOIN epdrunknfac ep2 ON e1.epdrunknownf_oi = ep2.epdrunknownfacilityoi
WHERE e1.facilitytype IN (1, 2) OR (e1.facilitytype = 10 AND ep2.unknfactype IN (2, 3))
   OR e1.facilitytype = 8 OR (e1.facilitytype = 10 AND ep2.unknfactype IN (4, 5, 6, 7, 8))
   OR e1.facilitytype = 4 OR (e1.facilitytype = 10 AND ep2.unknfactype IN (6, 7))""")
    o["branch_attach"] = _u("SELECT DISTINCT facilityoi, inspection_type, street, drainage_area, total_length FROM unified")
    o["code_join_shape"] = _u(f"SELECT {H}, inspection_type, shape, cover_shape FROM unified WHERE inspection_type IN ('MACP', 'PACP')")
    o["code_join_material"] = _u(f"SELECT {H}, inspection_type, material FROM unified WHERE inspection_type IN ('PACP', 'LACP')")
    o["mh_use_code"] = _u(f"SELECT {H}, facility_type, unknown_type, mh_use FROM unified WHERE inspection_type = 'MACP'")
    o["clean_longdesc"] = _u(f"SELECT workordertaskoi, {clean_longdesc_sql('longdescript')} AS additional_information FROM workordertask")
    o["anti_join_new"] = _u("""
SELECT DISTINCT s.workorder_uuid FROM wot_stg s
WHERE s.workorder_uuid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM wot_stg1 q WHERE q.task_uuid = s.workorder_uuid)""")
    o["semi_join_keys"] = _u(f"""
SELECT e.{H}, e.wotask_oi FROM epdrfacworkhistory e
WHERE EXISTS (SELECT 1 FROM feed_history f WHERE f.history_oi = e.{H})""")
    o["update_by_key"] = _u("""
SELECT s.task_uuid, s.workorder_uuid,
  CASE WHEN EXISTS (SELECT 1 FROM wot_stg1 q WHERE q.task_uuid = s.workorder_uuid) THEN 'SENT' ELSE s.feed_status END AS feed_status
FROM wot_stg s""")
    o["update_by_two_keys"] = _u(f"""
SELECT s.task_uuid, s.workorder_uuid,
  CASE WHEN k.t IS NOT NULL AND coalesce(s.feed_status, '~') <> 'UPDATED' THEN 'UPDATED' ELSE s.feed_status END AS feed_status
FROM wot_stg s LEFT JOIN (
  SELECT DISTINCT {_raw_key(canonical_uuid_sql('work_order_task_uuid'))} AS t, {_raw_key(canonical_uuid_sql('work_order_uuid'))} AS w
  FROM unified
  WHERE {_valid_hex(canonical_uuid_sql('work_order_task_uuid'))} AND {_valid_hex(canonical_uuid_sql('work_order_uuid'))}
) k ON k.t = s.task_uuid AND k.w = s.workorder_uuid""")
    o["delete_by_keys"] = _u(f"SELECT {Q_COLS} FROM wot_stg1 q WHERE NOT EXISTS (SELECT 1 FROM ack_keys k WHERE k.key = q.task_uuid)",
                             ACK_CTES)
    o["changed_keys"] = _u("SELECT DISTINCT history_oi FROM feed_history WHERE history_oi IS NOT NULL")
    o["first_per_key"] = _u("""
SELECT workorder_uuid, min(task_uuid) AS task_uuid FROM wot_stg
WHERE feed_status IN ('NEW', 'UPDATED') AND workorder_uuid IS NOT NULL GROUP BY workorder_uuid""")
    o["last_per_key"] = _u("""
SELECT workorder, max(seq) AS seq, arg_max(inspection_sid, seq) AS inspection_sid
FROM feed_vendor WHERE workorder IS NOT NULL GROUP BY workorder""")
    o["previous_value"] = _u("""
SELECT f.seq, f.queue_uuid, f.new_status,
  CASE WHEN row_number() OVER w = 1 THEN q.feed_status ELSE lag(f.new_status) OVER w END AS prev_status
FROM feed_queue f LEFT JOIN wot_stg1 q ON q.task_uuid = f.queue_uuid
WINDOW w AS (PARTITION BY f.queue_uuid ORDER BY f.seq)""")
    o["unified_inspections"] = _u("SELECT * FROM unified")
    o["strip_html"] = _u(f"SELECT page_id, {strip_html_sql('html')} AS html_clean FROM pages")
    o["strip_html_documents"] = _u(f"SELECT doc_id, {strip_html_sql('text')} AS text_clean FROM documents")
    o["canonical_uuid"] = _u(f"SELECT {H}, uuid AS dr_uuid, {canonical_uuid_sql('uuid')} AS canonical FROM epdrfacworkhistory")
    comp = f"upper(replace({canonical_uuid_sql('uuid')}, '-', ''))"
    o["compact_uuid"] = _u(f"""
SELECT {H}, {comp} AS compact, hex(unhex({comp})) AS roundtrip, {_valid_hex('uuid')} AS valid FROM epdrfacworkhistory""")
    o["manhole_number"] = _u(f"SELECT {H}, facility_id, manhole_number FROM unified WHERE inspection_type = 'MACP'")
    o["pipe_base_ref"] = _u(f"SELECT epdrpipeoi, pipeid, {pipe_base_ref_sql('pipeid')} AS base_ref FROM epdrpipe")
    o["lateral_base_ref"] = _u(f"SELECT wass_appid, {drop_last_segment_sql('wass_appid')} AS base_ref FROM epdrserviceconnect")
    o["pipe_use_code"] = _u(f"""
SELECT 'PACP' AS kind, CAST(epdrpipeoi AS VARCHAR) AS src_id, wwtype AS raw, {pipe_use_sql('wwtype', True)} AS code FROM epdrpipe
UNION ALL
SELECT 'LACP', wass_appid, recordtype, {pipe_use_sql('recordtype', False)} FROM epdrserviceconnect""")
    o["grade_to_invert"] = _u(f"""
SELECT epdrpipeoi, CAST({grade_sql('usgroundelev_fl', 'usinvertelev_fl')} AS DOUBLE) AS up_grade,
  CAST({grade_sql('dsgroundelev_fl', 'dsinvertelev_fl')} AS DOUBLE) AS down_grade FROM epdrpipe""")
    o["task_number"] = _u("""
SELECT a.workordertaskoi, concat(wo.wonumber, '.', a.tasknumber) AS work_orders_number
FROM workordertask a LEFT JOIN workorders wo ON a.workorder_oi = wo.workordersoi""")
    o["enqueue_work_orders"] = _u("SELECT * FROM eq_out", enqueue_sql("wot_stg1", "wot_stg", False).strip())
    o["acknowledge_sent_stg"] = _u(f"SELECT {STG_COLS} FROM stg_ack", ACK_CTES)
    o["acknowledge_sent_queue"] = _u(f"SELECT {Q_COLS} FROM queue_ack", ACK_CTES)
    o["propagate_due_date"] = _u(f"SELECT {STG_COLS} FROM stg_due",
                                 DUE_CTES + f",\nstg_due AS ({due_sql('wot_stg', False)})")
    o["collect_inspections"] = _u(f"SELECT {CR_SELECT} FROM crn", COLLECT_CTES)
    o["reflag_tasks"] = _u(f"SELECT {STG_COLS} FROM stg_r",
                           ",\n".join([COLLECT_CTES, REFLAG_CTES, f"stg_r AS ({reflag_sql('wot_stg')})"]))
    cr_cols_b = ", ".join(
        "CASE WHEN v.workorder IS NOT NULL THEN v.sid ELSE c.inspection_sid END AS inspection_sid" if x == "inspection_sid"
        else (f"CASE WHEN v.workorder IS NOT NULL THEN {strip_html_sql('c.additional_information')} "
              f"ELSE c.additional_information END AS additional_information") if x == "additional_information"
        else f"c.{x}" for x in CR_INSPECT_COLUMNS)
    o["backfill_sid"] = _u(f"""
SELECT {cr_cols_b} FROM crn c LEFT JOIN (
  SELECT workorder, arg_max(inspection_sid, seq) AS sid FROM feed_vendor WHERE workorder IS NOT NULL GROUP BY workorder
) v ON v.workorder = c.workorder""", COLLECT_CTES)
    o["cascade_stg"] = o["feed_stream_replay"] = with_ctes(f"SELECT {STG_COLS} FROM stg_out", CASCADE_CTES, recursive=True)
    o["cascade_queue"] = with_ctes(f"SELECT {Q_COLS} FROM queue_out", CASCADE_CTES, recursive=True)
    o["cascade_quarantine"] = with_ctes(f"""
SELECT 'inspection.bad_hex' AS rule, seq FROM flags WHERE NOT coalesce({_valid_hex('project_sid')}, true) OR NOT coalesce({_valid_hex('work_order_uuid')}, true)
UNION ALL SELECT 'staging.null_work_order', seq FROM feed_staging WHERE workorder_uuid IS NULL AND feed_status IN ('NEW', 'UPDATED')""", CASCADE_CTES, recursive=True)
    o["default_task_uuid"] = _u("SELECT 32 AS len, workorder_uuid FROM wot_stg")
    o["view_outbound"] = _u("SELECT inspection_type, count(*) AS n FROM crn WHERE feed_status = 'NEW' GROUP BY 1", COLLECT_CTES)
    raw = {"shape": [("epdrpipe", "shape"), ("epdrmanhole", "shape"), ("epdrcatchbasin", "shape")], "material": [("epdrpipe", "material"), ("epdrserviceconnect", "pipetype")],
           "mh_use": [("epdrmanhole", "wwtype"), ("epdrcatchbasin", "wwtype")], "wall": [("epdrmanhole", c) for c in ("cone", "bench", "channel")]}
    o["dq_coverage"] = _u(" UNION ALL ".join(f"""
SELECT '{k}' AS lookup, upper(trim(r.raw)) AS raw, count(*) AS n FROM ({" UNION ALL ".join(f"SELECT {c} AS raw FROM {t}" for t, c in cols)}) r
WHERE r.raw IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lk_{k} l WHERE upper(trim(l.src_text)) = upper(trim(r.raw))) GROUP BY 1, 2""" for k, cols in raw.items()))
    o["dq_lookups"] = _u(" UNION ALL ".join(f"""
SELECT '{k}' AS lookup, (SELECT count(*) FROM lk_{k}) AS row_count, (SELECT count(*) FROM lk_{k} WHERE src_text IS NULL) AS null_keys,
  (SELECT count(*) FROM (SELECT 1 FROM lk_{k} WHERE src_text IS NOT NULL GROUP BY upper(trim(src_text)) HAVING count(*) > 1)) AS repeated_keys""" for k in ("mh_use", "shape", "material", "wall")))
    o["dq_duplicate_keys"] = _u("""
SELECT 'queue.task_uuid' AS check_name, task_uuid AS key, count(*) AS n FROM wot_stg1 WHERE task_uuid IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'stg.task_uuid', task_uuid, count(*) FROM wot_stg WHERE task_uuid IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'facility.oi', CAST(epdrdrainagefacilityoi AS VARCHAR), count(*) FROM epdrdrainfacility
  WHERE epdrdrainagefacilityoi IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'manhole.id', manholeid, count(*) FROM epdrmanhole WHERE manholeid IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'service.id', wass_appid, count(*) FROM epdrserviceconnect WHERE wass_appid IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'view.work_orders_number', work_orders_number, count(*) FROM unified WHERE work_orders_number IS NOT NULL
  GROUP BY 2 HAVING count(*) > 1""")
    o["dq_nulls"] = _u("""
SELECT 'wot_stg' AS table_name, 'task_uuid' AS column_name, count(*) - count(task_uuid) AS null_count FROM wot_stg
UNION ALL SELECT 'wot_stg', 'workorder_uuid', count(*) - count(workorder_uuid) FROM wot_stg
UNION ALL SELECT 'wot_stg', 'plndcompdate_dttm', count(*) - count(plndcompdate_dttm) FROM wot_stg
UNION ALL SELECT 'wot_stg1', 'task_uuid', count(*) - count(task_uuid) FROM wot_stg1
UNION ALL SELECT 'workorders', 'wonumber', count(*) - count(wonumber) FROM workorders
UNION ALL SELECT 'epdrpipe', 'pipeid', count(*) - count(pipeid) FROM epdrpipe
UNION ALL SELECT 'epdrpipe', 'usgroundelev_fl', count(*) - count(usgroundelev_fl) FROM epdrpipe""")
    o["dq_quarantine"] = _u(f"""
SELECT 'stg.null_workorder' AS rule, count(*) AS n FROM wot_stg WHERE workorder_uuid IS NULL
UNION ALL SELECT 'history.bad_hex', count(*) FROM epdrfacworkhistory WHERE NOT coalesce({_valid_hex('uuid')}, true)
UNION ALL SELECT 'pipe.null_id', count(*) FROM epdrpipe WHERE pipeid IS NULL""")
    from ..sources.lookups import MATERIAL_ROWS
    codes = ", ".join(f"'{c}'" for c in sorted({c for _, c in MATERIAL_ROWS}))
    o["dq_unmapped"] = _u(f"""
SELECT inspection_type, material, count(*) AS n FROM unified
WHERE inspection_type IN ('PACP', 'LACP') AND material IS NOT NULL AND material NOT IN ({codes})
GROUP BY 1, 2""")
    o["dq_double_branch"] = _u(f"""
SELECT {H}, count(DISTINCT inspection_type) AS n_branches FROM unified GROUP BY 1 HAVING count(DISTINCT inspection_type) > 1""")
    return o


ORACLE = build()
