"""Outbound extract of the inspection table and registration of the two views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lookups import OUTBOUND_CITY, all_lookups
from .inspections import unified_inspections

# Column order of the outbound extract (41 columns).
OUTBOUND_COLUMNS = [
    "inspection_type", "pip_type", "project_sid", "inspectionid", "workorder", "project", "po_number",
    "additional_info", "pipe_segment_reference", "lateral_segment_reference", "manhole_number", "material",
    "pipe_use", "cover_shape", "upstream_mh", "downstream_mh", "facility_type", "facility_id", "facilityoi",
    "shape", "access_type", "mh_use", "wall_material", "bench_material", "channel_material", "wall_bysize",
    "wall_depth", "elevation", "frame_material", "height", "up_elevation", "up_grade_to_invert",
    "down_elevation", "down_grade_to_invert", "street", "city", "total_length", "year_constructed", "size",
    "drainage_area", "feed_status",
]


def extract_to_send(cr: DataFrame) -> DataFrame:
    """Rows with status exactly 'NEW'; the project id carries the work-order id, the
    description is renamed, and a constant city is added."""
    ren = {"project_sid": F.col("work_order_uuid"), "additional_info": F.col("additional_information"),
           "city": F.lit(OUTBOUND_CITY)}
    return (cr.where(F.col("feed_status") == "NEW")
            .select(*[(ren[c] if c in ren else F.col(c)).alias(c) for c in OUTBOUND_COLUMNS]))


def register_views(spark: SparkSession, src: dict[str, DataFrame], cr: DataFrame | None = None,
                   inspections_name: str = "inspections_v", outbound_name: str = "cr_inspect_to_send_v") -> list[str]:
    """Publish the unified view (and the outbound extract when an inspection table is given)
    as temp views, replacing earlier ones."""
    unified_inspections(src, all_lookups(spark)).createOrReplaceTempView(inspections_name)
    names = [inspections_name]
    if cr is not None:
        extract_to_send(cr).createOrReplaceTempView(outbound_name)
        names.append(outbound_name)
    return names
