"""Seeded code lookups (source text -> standard inspection code).

Each lookup is a small constant relation. Its size is known when it is built, so the
joins that use it may broadcast it (see ``operators.codes.code_join``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: these must equal the integration's seeded lookups exactly.
# (source text, code), in the order they are seeded.
# ---------------------------------------------------------------------------

# Manhole use (5 rows)
MH_USE_ROWS = [
    ("COMBINED", "CB"),
    ("FOUNDATION DRAIN", "SW"),
    ("NOT APPLICABLE", "XX"),
    ("SANITARY", "SS"),
    ("STORM", "SW"),
]

# Shape (18 rows)
SHAPE_ROWS = [
    ('ARCH TYPE "A"', "A"),
    ('ARCH TYPE "B"', "A"),
    ('ARCH TYPE "C"', "A"),
    ("BASKET HANDLE", "Z"),
    ("BOX SECTION", "S"),
    ("CIRCULAR", "C"),
    ("DOUBLE BARREL PIPE", "Z"),
    ("EGG", "E"),
    ("ELIPTICAL", "O"),
    ("EYE", "E"),
    ("HIGH HEAD", "Z"),
    ("INNER CIRCULAR", "C"),
    ("MONOLITHIC", "A"),
    ("OVAL", "O"),
    ("RECTANGULAR", "R"),
    ("UNKNOWN", "Z"),
    ("BOX", "S"),
    ("NOT CODED", "Z"),
]

# Pipe material (67 rows; WEEPING TILE carries the newer code PVC)
MATERIAL_ROWS = [
    ("ASBESTOS CEMENT PIPE", "AC"),
    ("BRICK", "BR"),
    ("CAST IRON PIPE", "CAS"),
    ("CLAY TILE PIPE", "CT"),
    ("CMP", "CMP"),
    ("CON", "CP"),
    ("CONCRETE BLOCK PIPE", "CP"),
    ("CONCRETE SEGMENTED TUNNEL", "CSU"),
    ("CORRUGATED METAL PIPE", "CP"),
    ("CORRUGATED STEEL PIPE", "SP"),
    ("CURED IN PLACE PIPE", "CP"),
    ("EYE PIPE", "ZZZ"),
    ("FIBERGLASS REINFORCED PIPE", "FRP"),
    ("GLASS FIBRE REINFORCED PLASTIC", "FRP"),
    ("HIGH DENSITY POLYETHYLENE", "PE"),
    ("KOR FLO PVC PIPE", "PVC"),
    ("MICRO TUNNELLING CONCRETE", "CP"),
    ("NON-CORRODE PIPE", "OB"),
    ("NON-REINFORCED CONCRETE", "CP"),
    ("NPD", "ZZZ"),
    ("OPEN PROFILE PVC - ULTRA RIB", "PVC"),
    ("PERFORATED HDPE", "PE"),
    ("PERFORATED METAL PIPE", "SP"),
    ("PERFORATED SUB DRAIN", "PE"),
    ("PERFORATED UNDERDRAIN", "PE"),
    ("PLASTIC LINED PIPE", "PSC"),
    ("POLYETHYLENE PIPE", "PE"),
    ("POLYVINYL CHLORIDE", "PVC"),
    ("POURED IN PLACE CONCRETE", "CP"),
    ("PUD", "ZZZ"),
    ("PVC", "PVC"),
    ("PVC SEWER SLEEVE", "PVC"),
    ("REINFORCED CONCRETE", "RCP"),
    ("REINFORCED CONCRETE PIPE", "RCP"),
    ("RUB", "ZZZ"),
    ("SANITITE POLYPROPYLENE PIPE", "PP"),
    ("STEEL PIPE", "SP"),
    ("SULPHATE RESISTANT CONCRETE", "CP"),
    ("TIL", "ZZZ"),
    ("UNK", "XXX"),
    ("UNKNOWN", "XXX"),
    ("URB", "ZZZ"),
    ("VCT - VITRIFIED CLAY TILE PIPE", "VCP"),
    ("WOOD STAVE", "WZ"),
    ("VITRIFIED CLAY PIPE", "VCP"),
    ("AC", "AC"),
    ("CAMALLOY", "ZZZ"),
    ("CAST IRON", "CAS"),
    ("CONCRETE", "CP"),
    ("COPPER", "ZZZ"),
    ("GALVINIZED", "ZZZ"),
    ("GALVANIZED", "ZZZ"),
    ("GI", "XXX"),
    ("HPLCP", "ZZZ"),
    ("HPLC P", "ZZZ"),
    ("KITEC", "PE"),
    ("LEAD", "ZZZ"),
    ("MAN HOLE #", "XXX"),
    ("NO CORRODE", "OB"),
    ("PEX", "PE"),
    ("POLYETHYLENE", "PE"),
    ("STEEL", "SP"),
    ("STL", "ZZZ"),
    ("TILE", "VCP"),
    ("TR", "ZZZ"),
    ("TRANSITE", "ZZZ"),
    ("WEEPING TILE", "PVC"),
]

# Wall / bench / channel material (14 rows, five of them without a code)
WALL_ROWS = [
    ("BLOCK", "CR"),
    ("BRICK", "BR"),
    ("NO CONE", None),
    ("POURED IN PLACE CONCRETE", "CN"),
    ("PRECAST CONCRETE", "CR"),
    ("SLAB TOP", "CR"),
    ("UNKNOWN", "XXX"),
    ("MANHOLE PIPE SADDLE", None),
    ("NO BENCH", "CR"),
    ("NOT CODED", None),
    ("PERCHED MANHOLE", None),
    ("TEE RISER MANHOLE", None),
    ("PIPE", "PVC"),
    ("SUMP", "CR"),
]

# Pipe-use text -> code. COMBINED is only recognised for pipes (not service connections).
PIPE_USE_RULES = [
    ("FOUNDATION DRAIN", "SW"),
    ("SANITARY", "SS"),
    ("STORM", "SW"),
    ("WATER", "XX"),
    ("COMBINED", "CB"),
    ("NOT APPLICABLE", "XX"),
    ("N/A", "XX"),
    ("NA", "XX"),
]

# Constant CITY column of the outbound extract.
OUTBOUND_CITY = "Edmonton"
# ---------------------------------------------------------------------------

LOOKUP_SCHEMA = T.StructType([
    T.StructField("src_text", T.StringType(), False),
    T.StructField("code", T.StringType(), True),
])


@dataclass(frozen=True)
class Lookup:
    """A code lookup plus the proven upper bound of its row count."""

    name: str
    df: DataFrame
    max_rows: int

    # A lookup above this many rows is not broadcast by ``code_join``; AQE decides.
    BROADCAST_ROW_LIMIT = 100_000

    @property
    def broadcastable(self) -> bool:
        return self.max_rows <= self.BROADCAST_ROW_LIMIT


def _build(spark: SparkSession, name: str, rows) -> Lookup:
    return Lookup(name, spark.createDataFrame(list(rows), LOOKUP_SCHEMA), len(rows))


def mh_use_lookup(spark: SparkSession) -> Lookup:
    return _build(spark, "mh_use", MH_USE_ROWS)


def shape_lookup(spark: SparkSession) -> Lookup:
    return _build(spark, "shape", SHAPE_ROWS)


def material_lookup(spark: SparkSession) -> Lookup:
    return _build(spark, "material", MATERIAL_ROWS)


def wall_lookup(spark: SparkSession) -> Lookup:
    return _build(spark, "wall", WALL_ROWS)


def from_dataframe(name: str, df: DataFrame, max_rows: int | None = None) -> Lookup:
    """Wrap a user-maintained lookup table (columns src_text, code).

    Without a stated bound the row count is measured once; a lookup is a small
    reference table, and this keeps the broadcast decision size-checked.
    """
    n = max_rows if max_rows is not None else df.count()
    return Lookup(name, df.select("src_text", "code"), n)


def all_lookups(spark: SparkSession) -> dict[str, Lookup]:
    return {
        "mh_use": mh_use_lookup(spark),
        "shape": shape_lookup(spark),
        "material": material_lookup(spark),
        "wall": wall_lookup(spark),
    }
