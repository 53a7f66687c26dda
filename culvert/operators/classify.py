"""Facility classification: which inspection branch(es) a facility enters, and the
per-kind attribute switches of the manhole branch.

facilitytype 1 manhole, 2 catch basin -> MACP; 8 pipe -> PACP; 4 service -> LACP;
10 unknown: unknfactype 2,3 -> MACP; 4,5,8 -> PACP; 6,7 -> PACP *and* LACP.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRANCHES = ("MACP", "PACP", "LACP")


def is_macp(ft: Column, ut: Column) -> Column:
    return ft.isin(1, 2) | ((ft == 10) & ut.isin(2, 3))


def is_pacp(ft: Column, ut: Column) -> Column:
    return (ft == 8) | ((ft == 10) & ut.isin(4, 5, 6, 7, 8))


def is_lacp(ft: Column, ut: Column) -> Column:
    return (ft == 4) | ((ft == 10) & ut.isin(6, 7))


def branch_tags(ft: Column, ut: Column) -> Column:
    """array of the branches a facility row enters (empty -> dropped)."""
    return F.array_compact(F.array(
        F.when(is_macp(ft, ut), F.lit("MACP")),
        F.when(is_pacp(ft, ut), F.lit("PACP")),
        F.when(is_lacp(ft, ut), F.lit("LACP"))))


def classify(df: DataFrame, ft: str = "facilitytype", ut: str = "unknfactype") -> DataFrame:
    """Add the three branch flags and the tag array; rows in no branch are kept (flags false/null)."""
    f, u = F.col(ft), F.col(ut)
    return df.select("*", F.coalesce(is_macp(f, u), F.lit(False)).alias("is_macp"),
                     F.coalesce(is_pacp(f, u), F.lit(False)).alias("is_pacp"),
                     F.coalesce(is_lacp(f, u), F.lit(False)).alias("is_lacp"),
                     branch_tags(f, u).alias("branches"))


def explode_branches(df: DataFrame, ft: str = "facilitytype", ut: str = "unknfactype") -> DataFrame:
    """One output row per branch a row enters (the UNION ALL of the three branch filters)."""
    return df.select("*", F.explode(branch_tags(F.col(ft), F.col(ut))).alias("inspection_type"))


def access_type(ft: Column, ut: Column) -> Column:
    """10/3 -> AMH, 10/2 -> ACB, 1 -> AMH, 2 -> ACB."""
    return (F.when((ft == 10) & (ut == 3), "AMH").when((ft == 10) & (ut == 2), "ACB")
            .when(ft == 1, "AMH").when(ft == 2, "ACB"))


def is_catch_basin(ft: Column, ut: Column) -> Column:
    """Attribute switch of the manhole branch: catch-basin values for 2 and 10/2."""
    return (ft == 2) | ((ft == 10) & (ut == 2))


def pick_by_kind(ft: Column, ut: Column, cb_col: Column, mh_col: Column) -> Column:
    """Catch-basin value for kind 2 / 10-2, else the manhole value (10/3 takes manhole values)."""
    return F.when(is_catch_basin(ft, ut), cb_col).otherwise(mh_col)


def not_type1(ft: Column, ut: Column) -> Column:
    """Wall / bench / channel are suppressed for 2 and 10/{2,3} (a different test than pick_by_kind)."""
    return (ft == 2) | ((ft == 10) & ut.isin(2, 3))


def type1_only(ft: Column, ut: Column, c: Column) -> Column:
    return F.when(not_type1(ft, ut), F.lit(None).cast("string")).otherwise(c)
