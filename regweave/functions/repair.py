"""Byte-level repair of a record, before it is split into fields.

A record arrives as raw bytes. Reading it as ISO-8859-1 gives one character per
byte, so control bytes are removed and counted exactly; the remaining bytes are
then read as UTF-8, each malformed sequence becoming one replacement character.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every control byte but tab, line feed and carriage return.
CONTROL_BYTES = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
REPLACEMENT = "�"
_REPLACEMENT_BYTES = "ï¿½"  # its UTF-8 bytes read as ISO-8859-1


def strip_control(c: Column) -> Column:
    """Delete control characters; the row and the rest of the field stay."""
    return F.when(c.rlike(CONTROL_BYTES), F.regexp_replace(c, CONTROL_BYTES, "")).otherwise(c)


def byte_text(raw: Column) -> Column:
    """Binary as text, one character per byte."""
    return F.decode(raw, "ISO-8859-1")


def utf8_text(c: Column) -> Column:
    """One-character-per-byte text read as UTF-8, malformed bytes replaced."""
    return F.make_valid_utf8(F.encode(c, "ISO-8859-1").cast("string"))


def count_text(c: Column, what: str) -> Column:
    """How often a text occurs in a value; seldom does it occur at all."""
    gone = F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))
    times = (gone / len(what)).cast("bigint")
    return F.when(c.contains(what), times).when(c.isNotNull(), F.lit(0).cast("bigint"))


def control_count(raw_text: Column, stripped: Column) -> Column:
    return (F.length(raw_text) - F.length(stripped)).cast("bigint")


def source_replacements(stripped: Column) -> Column:
    """Replacement characters the publisher already shipped."""
    return count_text(stripped, _REPLACEMENT_BYTES)


def bad_byte_count(stripped: Column, repaired: Column) -> Column:
    """Bytes this repair replaced.

    Valid bytes pass through unchanged, so the length difference plus three bytes
    for every replacement character of our own gives the number replaced. Without
    a replacement character there was none.
    """
    ours = count_text(repaired, REPLACEMENT) - source_replacements(stripped)
    replaced = (F.length(stripped) - F.octet_length(repaired) + 3 * ours).cast("bigint")
    marked = repaired.contains(REPLACEMENT)
    return F.when(marked, replaced).when(~marked, F.lit(0).cast("bigint"))
