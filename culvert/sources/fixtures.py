"""Derive the integration's source, state and change-feed tables from the driver's
TPC-H-like parquet (lineitem, orders, part, events).

Everything here is a Spark projection / filter / one grouping of lineitem, so the
derived tables grow with the input. Rules (see FIXTURES.md §3):
  t  = l_orderkey*10 + l_linenumber   (one task per (order, line))
  tp = min(l_partkey), td = min(l_shipdate) over the duplicates of (order, line)
  p  = p_partkey,  o = o_orderkey
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookups import MATERIAL_ROWS, MH_USE_ROWS, SHAPE_ROWS, WALL_ROWS

# Value cycles: every lookup key plus one value no lookup knows.
MHUSE_CYCLE = [k for k, _ in MH_USE_ROWS] + ["Mystery Use"]
WALL_CYCLE = [k for k, _ in WALL_ROWS] + ["Mystery Wall"]
SHAPE_CYCLE = [k for k, _ in SHAPE_ROWS] + ["Mystery Shape"]
MAT_CYCLE = [k for k, _ in MATERIAL_ROWS] + ["Mystery Mat"]
USE_CYCLE = ["FOUNDATION DRAIN", "SANITARY", "STORM", "WATER", "COMBINED",
             "NOT APPLICABLE", "N/A", "NA", "Other Use"]
STG_STATUS_CYCLE = [None, "NEW", "UPDATED", "SENT", "OTHER"]
ACK_NEW_CYCLE = ["SENT", " send ", "Sent", "OTHER"]
ACK_OLD_CYCLE = [None, "NEW", "   ", "SENT"]
HISTORY_KEY_OFFSET = 1_000_000_000


def _sql_str(v) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(values: list, idx: Column) -> Column:
    """values[idx] for a 0-based integer column (a literal array, 1-based element_at).
    The array is one SQL literal expression (one JVM call instead of one per value)."""
    arr = F.expr("array(" + ", ".join(_sql_str(v) for v in values) + ")")
    return F.element_at(arr, (idx + 1).cast("int"))


def _styled(c: Column, p: Column) -> Column:
    """A third as is, a third lower-cased, a third padded with spaces (by (p div 7) % 3)."""
    k = (p / 7).cast("long") % 3
    return F.when(k == 0, c).when(k == 1, F.lower(c)).otherwise(F.concat(F.lit("  "), c, F.lit(" ")))


def _dec(int_col: Column, scale_literal: str) -> Column:
    """Exact decimal int_col * scale_literal as DECIMAL(38,10)."""
    frac = len(scale_literal.split(".")[1])
    lit = F.lit(scale_literal).cast(f"decimal({frac + 1},{frac})")
    return (int_col.cast("decimal(20,0)") * lit).cast("decimal(38,10)")


def _dashed(h: Column) -> Column:
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


_DEFINED: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, build):
    """Define a derived table set once per (session, folder). DataFrames are lazy plans:
    reusing the definition skips re-analysing it, while every action still reads the
    parquet files and recomputes everything."""
    key = (kind, id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _DEFINED:
        _DEFINED[key] = build()
    return _DEFINED[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    g = (li.groupBy("l_orderkey", "l_linenumber")
         .agg(F.min("l_partkey").alias("tp"), F.min("l_shipdate").cast("timestamp_ntz").alias("td")))
    return g.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("t"),
                    F.col("l_orderkey").alias("o"), F.col("l_linenumber").cast("long").alias("n"), "tp", "td")


def _title(n: Column, o: Column, t: Column) -> Column:
    base = F.concat(F.lit("Task "), n.cast("string"), F.lit(" order "), o.cast("string"))
    return F.when(t % 50 == 0, F.rpad(base, 450, "~")).otherwise(base)


def _longdescript(t: Column) -> Column:
    k = t % 8
    ts = t.cast("string")
    return (F.when(k == 0, F.lit(None).cast("string"))
            .when(k == 1, F.concat(F.lit("  note "), ts, F.lit("\n\n   ends  \t")))
            .when(k == 2, F.concat(F.lit("<p>raw "), ts, F.lit("</p>")))
            .when(k == 3, F.lit("&lt;b&gt;x&lt;/b&gt;"))
            .when(k == 4, F.lit("&amp;lt;b&amp;gt;x"))
            .when(k == 5, F.lit("&amp;amp;lt;b&amp;amp;gt;x"))
            .when(k == 6, F.lit("&amp;amp;lt;style&amp;amp;gt;q&amp;amp;lt;/style&amp;amp;gt;A &amp; B"))
            .otherwise(F.concat(F.lit("it&amp;#39;s&amp;nbsp;"), ts)))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part + facility classification columns used by every facility table."""
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    p = F.col("p_partkey")
    m8 = p % 8
    ftype = (F.when(m8 == 0, 1).when(m8 == 1, 2).when(m8 == 2, 4).when(m8 == 3, 8)
             .when(m8 == 7, 9).otherwise(10)).cast("long")
    ut = F.when(m8.isin(4, 5, 6), F.lit(2) + (p / 8).cast("long") % 7).cast("long")
    kind = (F.when((ftype == 1) | (ut == 3), "MH").when((ftype == 2) | (ut == 2), "CB")
            .when((ftype == 4) | ut.isin(6, 7), "SC").when((ftype == 8) | ut.isin(4, 5, 8), "PIP")
            .otherwise("X"))
    return pt.select(p.alias("p"), F.col("p_size").cast("long").alias("size"),
                     F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"),
                     ftype.alias("ftype"), ut.alias("ut"), kind.alias("kind"))


def _facility_id(p: Column, kind: Column) -> Column:
    ps = p.cast("string")
    return (F.when(kind == "MH", F.concat(F.lit("MH"), ps)).when(kind == "CB", F.concat(F.lit("CB"), ps))
            .when(kind == "SC", F.concat(F.lit("SC-"), ps, F.lit("-"), (p % 5).cast("string")))
            .when(kind == "PIP", F.concat(F.lit("PIP"), ps)).otherwise(F.concat(F.lit("X"), ps)))


def _ground_invert(u: Column, cents: Column, size: Column):
    ground = (F.when(u == 0, _dec(F.lit(0), "0.01")).when(u == 1, F.lit(None).cast("decimal(38,10)"))
              .otherwise(_dec(cents, "0.01")))
    invert = (F.when(u == 1, F.lit(None).cast("decimal(38,10)")).when(u == 5, _dec(F.lit(0), "0.01"))
              .otherwise(_dec(cents * 1000 - size * 12345, "0.00001")))
    return ground, invert


def derive_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten source relations of the unified view."""
    return dict(_once("sources", spark, sf_dir, lambda: _derive_sources(spark, sf_dir)))


def _derive_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tasks = _tasks(spark, sf_dir)
    t, o, n = F.col("t"), F.col("o"), F.col("n")
    parts = _parts(spark, sf_dir)
    p, kind, size, cents = F.col("p"), F.col("kind"), F.col("size"), F.col("cents")
    pstr = p.cast("string")
    nb = F.concat(F.lit("NB"), (p % 40).cast("string"))

    workordertask = tasks.select(
        t.alias("workordertaskoi"), o.alias("workorder_oi"), F.col("tp").alias("asset_oi"), n.alias("tasknumber"),
        _title(n, o, t).alias("wotasktitle"), F.md5(F.concat(F.lit("task-"), t.cast("string"))).alias("uuid"),
        _longdescript(t).alias("longdescript"))

    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ok = F.col("o_orderkey")
    workorders = orders.where(ok % 11 != 0).select(
        ok.alias("workordersoi"),
        F.when(ok % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("WO"), ok.cast("string"))).alias("wonumber"),
        F.md5(F.concat(F.lit("wo-"), ok.cast("string"))).alias("uuid"),
        F.when(ok % 2 == 0, 58).otherwise(57).cast("long").alias("site_oi"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("reqcompdate_dttm"))

    asset = parts.where(p % 10 != 0).select(p.alias("assetoi"), F.concat(F.lit("A-"), pstr).alias("assetnumber"))

    h = F.md5(F.concat(F.lit("dr-"), t.cast("string")))
    history = tasks.where(t % 13 != 0).select(
        (t + HISTORY_KEY_OFFSET).alias("epdrfacilityworkhistoryoi"), t.alias("wotask_oi"),
        F.col("tp").alias("epdrfacility_oi"), F.col("td").alias("createdate_dttm"),
        F.col("td").alias("lastupdate_dttm"),
        F.when(t % 3 == 0, _dashed(h)).when(t % 3 == 1, F.upper(_dashed(h))).otherwise(h).alias("uuid"))

    facility = parts.where(p % 19 != 0).select(
        p.alias("epdrdrainagefacilityoi"), _facility_id(p, kind).alias("facilityid"),
        F.col("ftype").alias("facilitytype"),
        F.when(kind == "PIP", p).cast("long").alias("epdrpipe_oi"),
        F.when(F.col("ftype") == 10, p).cast("long").alias("epdrunknownf_oi"))

    unknfac = parts.where(F.col("ftype") == 10).select(p.alias("epdrunknownfacilityoi"), F.col("ut").alias("unknfactype"))

    manhole = parts.where((kind == "MH") & (p % 23 != 0)).select(
        F.concat(F.lit("MH"), pstr).alias("manholeid"),
        _styled(_pick(MHUSE_CYCLE, p % 6), p).alias("wwtype"), nb.alias("neighbourhd"),
        F.concat(pstr, F.lit(" Main St")).alias("location"),
        _styled(_pick(WALL_CYCLE, p % 15), p).alias("cone"),
        _styled(_pick(WALL_CYCLE, (p + 5) % 15), p).alias("bench"),
        _styled(_pick(WALL_CYCLE, (p + 10) % 15), p).alias("channel"),
        _styled(_pick(SHAPE_CYCLE, p % 19), p).alias("shape"),
        _dec(size, "0.1").alias("diameter_fl"), _dec(size, "0.5").alias("depth_fl"),
        _dec(cents, "0.01").alias("groundelevat_fl"))

    catchbasin = parts.where(kind == "CB").select(
        F.concat(F.lit("CB"), pstr).alias("catchbasinid"),
        _styled(_pick(MHUSE_CYCLE, (p + 1) % 6), p).alias("wwtype"), nb.alias("neighbourhd"),
        F.concat(pstr, F.lit(" Basin Ave")).alias("location"),
        _styled(_pick(SHAPE_CYCLE, (p + 3) % 19), p).alias("shape"),
        F.concat(F.lit("FC"), (p % 4).cast("string")).alias("framecover"),
        _dec(size, "0.1").alias("diameter_fl"), _dec(size, "0.5").alias("depth_fl"))

    m5 = p % 5
    pipeid = (F.when(m5 == 0, F.concat(F.lit("PIP"), pstr)).when(m5 == 1, F.concat(F.lit("cbl"), pstr))
              .when(m5 == 2, F.lit("PIP")).when(m5 == 3, F.concat(F.lit("X"), pstr))
              .otherwise(F.lit(None).cast("string")))
    usg, usi = _ground_invert(p % 6, cents, size)
    dsg, dsi = _ground_invert((p + 3) % 6, cents, size)
    pipe = parts.where(kind == "PIP").select(
        p.alias("epdrpipeoi"), pipeid.alias("pipeid"),
        _styled(_pick(MAT_CYCLE, p % 68), p).alias("material"),
        _styled(_pick(SHAPE_CYCLE, (p / 2).cast("long") % 19), p).alias("shape"),
        _styled(_pick(USE_CYCLE, p % 9), p).alias("wwtype"),
        F.concat(F.lit("MH"), (p + 1).cast("string")).alias("usfacilityid"),
        F.concat(F.lit("MH"), (p + 2).cast("string")).alias("dsfacilityid"),
        F.concat(pstr, F.lit(" Pipe Rd")).alias("location"), nb.alias("usneighbour"),
        _dec(size, "0.1").alias("diameter_fl"), usg.alias("usgroundelev_fl"), usi.alias("usinvertelev_fl"),
        dsg.alias("dsgroundelev_fl"), dsi.alias("dsinvertelev_fl"), _dec(size * 25, "0.1").alias("length_fl"),
        (F.lit(1950) + p % 70).cast("long").alias("yearconst"))

    service = parts.where(kind == "SC").select(
        _facility_id(p, kind).alias("wass_appid"), F.concat(size.cast("string"), F.lit("mm")).alias("pipesize"),
        _styled(_pick(USE_CYCLE, (p + 2) % 9), p).alias("recordtype"),
        F.concat(pstr, F.lit(" Lane")).alias("location"), nb.alias("neighbourhd"),
        _styled(_pick(MAT_CYCLE, (p * 7) % 68), p).alias("pipetype"),
        _dec(size * 15, "0.1").alias("pipelength"))

    return {
        "workordertask": workordertask, "workorders": workorders, "asset": asset,
        "epdrfacworkhistory": history, "epdrdrainfacility": facility, "epdrunknfac": unknfac,
        "epdrmanhole": manhole, "epdrcatchbasin": catchbasin, "epdrpipe": pipe, "epdrserviceconnect": service,
    }


def derive_state(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Initial staging table (one row per task) and queue (every 4th work order)."""
    return dict(_once("state", spark, sf_dir, lambda: _derive_state(spark, sf_dir)))


def _derive_state(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tasks = _tasks(spark, sf_dir)
    t, o, n = F.col("t"), F.col("o"), F.col("n")
    stg = tasks.select(
        F.md5(F.concat(F.lit("task-"), t.cast("string"))).alias("task_uuid"),
        F.md5(F.concat(F.lit("wo-"), o.cast("string"))).alias("workorder_uuid"),
        F.left(_title(n, o, t), F.lit(503)).alias("wotasktitle"),
        F.when(t % 7 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("td")).alias("plndcompdate_dttm"),
        F.col("td").alias("plndstrtdate_dttm"),
        (t % 4).cast("long").alias("workclassifi_oi"),
        _pick(STG_STATUS_CYCLE, t % 5).alias("feed_status"),
        F.lit(None).cast("timestamp").alias("feed_status_dttm"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ok = F.col("o_orderkey")
    queue = orders.where(ok % 4 == 0).select(
        F.md5(F.concat(F.lit("wo-"), ok.cast("string"))).alias("task_uuid"),
        F.concat(F.lit("WO "), ok.cast("string")).alias("wotasktitle"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("plndcompdate_dttm"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("plndstrtdate_dttm"),
        F.lit(None).cast("long").alias("workclassifi_oi"),
        F.lit("NEW").alias("feed_status"))
    return {"wot_stg": stg, "wot_stg1": queue}


def derive_feed(spark: SparkSession, sf_dir: str, sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """The unified change feed (see ``_derive_feed``)."""
    if sources is not None:
        return _derive_feed(spark, sf_dir, sources)
    return _once("feed", spark, sf_dir, lambda: _derive_feed(spark, sf_dir, derive_sources(spark, sf_dir)))


def _derive_feed(spark: SparkSession, sf_dir: str, sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """The unified change feed (schema ``FEED_SCHEMA``), seq = event_id.

    signup   -> insert of all history rows of work order o = event_id (one row per key)
    purchase -> required-date change of work order o = user_id
    click    -> queue status update of work order o = user_id
    view     -> vendor row for work-order number 'WO<user_id>.<event_id % 7 + 1>'
    error    -> even ids: staging row of task 1 of work order o = user_id written (every third one a new task,
                some without a work order); odd ids: an inspection row of that work order changes its status
    """
    src = sources or derive_sources(spark, sf_dir)
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    e, u, typ = F.col("event_id"), F.col("user_id"), F.col("event_type")
    nul = {"history_oi": "long", "wo_uuid": "string", "site_oi": "long", "reqcompdate_dttm": "timestamp_ntz",
           "queue_uuid": "string", "old_status": "string", "new_status": "string", "workorder": "string",
           "inspection_sid": "string", "task_uuid": "string", "workorder_uuid": "string", "wotasktitle": "string",
           "plndcompdate_dttm": "timestamp_ntz", "plndstrtdate_dttm": "timestamp_ntz", "workclassifi_oi": "long",
           "feed_status": "string", "inspectionid": "string", "project_sid": "string", "work_order_uuid": "string"}

    def shape(df: DataFrame, source: str, **cols: Column) -> DataFrame:
        out = [F.col("seq").cast("long").alias("seq"), F.lit(source).alias("source")]
        for name, typ_ in nul.items():
            out.append((cols[name] if name in cols else F.lit(None)).cast(typ_).alias(name))
        return df.select(*out)

    hist = src["epdrfacworkhistory"].select("epdrfacilityworkhistoryoi",
                                            (F.col("wotask_oi") / 10).cast("long").alias("o"))
    signups = ev.where(typ == "signup").select(e.alias("seq"), e.alias("o"))
    f_hist = shape(signups.join(hist, "o"), "history", history_oi=F.col("epdrfacilityworkhistoryoi"))

    wo = src["workorders"].select("workordersoi", "uuid", "site_oi", "reqcompdate_dttm")
    purch = ev.where(typ == "purchase").join(wo, u == F.col("workordersoi"))
    newdate = (F.when(e % 10 == 0, F.lit(None).cast("timestamp_ntz"))
               .when(e % 10 == 1, F.col("reqcompdate_dttm"))
               .otherwise(F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")))
    f_wo = shape(purch.withColumn("seq", e), "workorder", wo_uuid=F.col("uuid"), site_oi=F.col("site_oi"),
                 reqcompdate_dttm=newdate)

    clicks = ev.where(typ == "click").withColumn("seq", e)
    f_q = shape(clicks, "queue", queue_uuid=F.md5(F.concat(F.lit("wo-"), u.cast("string"))),
                old_status=_pick(ACK_OLD_CYCLE, (e / 4).cast("long") % 4), new_status=_pick(ACK_NEW_CYCLE, e % 4))

    views = ev.where(typ == "view").withColumn("seq", e)
    f_v = shape(views, "vendor",
                workorder=F.concat(F.lit("WO"), u.cast("string"), F.lit("."), (e % 7 + 1).cast("string")),
                inspection_sid=F.concat(F.lit("SID-"), e.cast("string")))

    md5 = lambda *c: F.md5(F.concat(*c))
    when = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    staged = ev.where((typ == "error") & (e % 2 == 0)).withColumn("seq", e)
    f_s = shape(staged, "staging",
                task_uuid=F.when(e % 6 == 0, md5(F.lit("new-"), e.cast("string")))
                .otherwise(md5(F.lit("task-"), (u * 10 + 1).cast("string"))),
                workorder_uuid=F.when(e % 30 != 0, md5(F.lit("wo-"), u.cast("string"))),
                wotasktitle=F.concat(F.lit("ST "), e.cast("string")),
                plndcompdate_dttm=F.when(e % 10 != 4, when), plndstrtdate_dttm=when, workclassifi_oi=e % 4,
                feed_status=_pick(STG_STATUS_CYCLE, (e / 2).cast("long") % 5))
    reset = ev.where((typ == "error") & (e % 2 == 1)).withColumn("seq", e)
    f_i = shape(reset, "inspection",
                project_sid=F.when(e % 25 == 1, F.lit("not-hex")).when(e % 25 == 2, F.lit(None).cast("string"))
                .otherwise(F.upper(md5(F.lit("task-"), (u * 10 + e % 3 + 1).cast("string")))),
                work_order_uuid=md5(F.lit("wo-"), u.cast("string")),
                feed_status=F.when(e % 3 == 0, F.lit("SENT")).otherwise(F.lit("NEW")))
    return reduce(DataFrame.unionByName, (f_hist, f_wo, f_q, f_v, f_s, f_i))
