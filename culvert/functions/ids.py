"""Identifier rules: uuid canonical / compact forms, id prefixes and segment references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import cat, nn

_HEX32 = "^([0-9A-Fa-f]{8})([0-9A-Fa-f]{4})([0-9A-Fa-f]{4})([0-9A-Fa-f]{4})([0-9A-Fa-f]{12})$"

_DASHED = r"^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}\z"


def canonical_uuid(c: Column) -> Column:
    """Keep hex digits only; when exactly 32 remain, dash them 8-4-4-4-12; lower-case.

    Any other count of hex digits stays bare (lower-cased); nothing left -> null.
    Ids that are 32 digits, or dashed already, are only matched, not rewritten digit by digit.
    """
    bare = F.regexp_replace(c, "[^0-9A-Fa-f]", "")
    dashed = F.concat_ws("-", *[F.substring(c, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return (F.when(c.rlike(r"^[0-9A-Fa-f]{32}\z"), F.lower(dashed)).when(c.rlike(_DASHED), F.lower(c))
            .otherwise(nn(F.lower(F.regexp_replace(bare, _HEX32, "$1-$2-$3-$4-$5")))))


def compact_uuid(c: Column) -> Column:
    """Dashes removed, upper-cased: the text form of a RAW(16) id."""
    return F.upper(F.replace(c, F.lit("-"), F.lit("")))


def raw_key(c: Column) -> Column:
    """Join form of a RAW(16) id built from text: 32 lower-case hex digits."""
    return F.lower(compact_uuid(c))


def is_valid_hex(c: Column) -> Column:
    """True when converting the compact text to binary would succeed (hex digits only)."""
    return compact_uuid(c).rlike("^[0-9A-F]*$")


def raw_hex(c: Column) -> Column:
    """binary -> upper-case hex text."""
    return F.hex(c)


def hex_raw(c: Column) -> Column:
    """hex text -> binary (null for bad hex)."""
    return F.try_to_binary(c, F.lit("hex"))


#: Spellings of an id of 16 bytes: (mark, bytes of text, pattern, upper case, dashed).
_SPELLINGS = [(1, 32, r"^[0-9a-f]{32}\z", False, False), (2, 36, r"^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}\z", False, True),
              (3, 32, r"^[0-9A-F]{32}\z", True, False), (4, 36, r"^[0-9A-F]{8}-([0-9A-F]{4}-){3}[0-9A-F]{12}\z", True, True)]


def pack_id(c: Column) -> Column:
    """Text of an id as binary, for shuffles: a mark and 16 bytes where the text is 32 hex digits of one case, bare or dashed
    8-4-4-4-12; any other text as a zero byte and its bytes. ``unpack_id`` gives back the same text, whatever it was."""
    out = F.when(c.isNull(), F.lit(None).cast("binary"))
    for mark, size, pattern, _, dashed in _SPELLINGS:
        digits = F.replace(c, F.lit("-"), F.lit("")) if dashed else c
        out = out.when((F.octet_length(c) == size) & c.rlike(pattern), F.concat(F.lit(bytes([mark])), F.unhex(digits)))
    return out.otherwise(F.concat(F.lit(bytes(1)), c.cast("binary")))


def unpack_id(c: Column) -> Column:
    """The text that ``pack_id`` was given."""
    mark, rest = F.substring(c, 1, 1), F.substring(c, 2, 1 << 30)
    dashed = F.regexp_replace(F.hex(rest), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    text = F.when(mark.isin(*[bytes([m]) for m, *_, d in _SPELLINGS if d]), dashed).otherwise(F.hex(rest))
    return (F.when(mark == F.lit(bytes(1)), rest.cast("string"))
            .when(mark.isin(*[bytes([m]) for m, _, _, upper, _ in _SPELLINGS if upper]), text).otherwise(F.lower(text)))


def strip_prefix(c: Column, prefix: str) -> Column:
    """Remove a leading prefix, case-sensitive ('MH12' -> '12')."""
    return nn(F.regexp_replace(c, "^" + prefix, ""))


def pipe_base_ref(c: Column) -> Column:
    """Drop the first three characters when they are PIP or CBL (any case)."""
    u = F.upper(c)
    return (F.when(c.isNull(), F.lit(None))
            .when(u.startswith("PIP") | u.startswith("CBL"), nn(F.substring(c, 4, 1 << 30)))
            .otherwise(c))


def drop_last_segment(c: Column) -> Column:
    """Cut from the last '-' when it is not the first character ('A-1-2' -> 'A-1')."""
    pos_from_end = F.instr(F.reverse(c), "-")
    pos = F.length(c) - pos_from_end + 1
    return F.when((pos_from_end > 0) & (pos > 1), F.substring(c, F.lit(1), pos - 1)).otherwise(c)


def task_number(wonumber: Column, tasknumber: Column) -> Column:
    """'<work order number>.<task number>', a null part counting as empty."""
    return cat(wonumber, ".", tasknumber.cast("string"))
