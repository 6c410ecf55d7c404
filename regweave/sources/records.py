"""From raw CSV records to repaired text columns.

A record is one CSV row as bytes, quoted line breaks included. It is repaired as
a whole before it is split, so a control byte beside a quote cannot disturb the
split, and one pass serves all its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from regweave.functions import repair
from regweave.functions.text import NULL_TOKENS, null_tokens_to_null

MALFORMED = "_malformed"
_CSV_OPTIONS = {
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
}


#: bytes that leave nothing of a record: the control bytes and line ends
_BLANK = bytes(b for b in range(32) if b != 9)


def repair_records(records: DataFrame, *, keep_blank: bool = False) -> DataFrame:
    """Replace the binary ``record`` by its repaired ``text`` and repair counts.

    Blank records are no rows. They are told by their raw bytes: a filter on the
    repaired text would be pushed below the exchange and repair everything twice.
    """
    if not keep_blank:
        records = records.filter(F.octet_length(F.btrim("record", F.lit(_BLANK))) > 0)
    staged = (
        records.withColumn("_raw", repair.byte_text(F.col("record")))
        .withColumn("_stripped", repair.strip_control(F.col("_raw")))
        .withColumn("text", repair.utf8_text(F.col("_stripped")))
    )
    text, stripped = F.col("text"), F.col("_stripped")
    return staged.select(
        *[c for c in records.columns if c != "record"],
        "text",
        repair.control_count(F.col("_raw"), stripped).alias("control_bytes"),
        repair.bad_byte_count(stripped, text).alias("bad_bytes"),
        repair.source_replacements(stripped).alias("source_replacements"),
    )


def header_names(line: Column) -> Column:
    """The column names that a repaired header record holds."""
    # A field is quoted, its quotes doubled, or runs to the next comma.
    field = r'((?:"[^"]*+(?:""[^"]*+)*+")?[^,]*+),'
    cells = F.regexp_extract_all(F.concat(F.rtrim(line, F.lit("\r\n")), F.lit(",")), F.lit(field), F.lit(1))
    bare = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), bare(c)).otherwise(c))


def parse_records(
    repaired: DataFrame,
    header: list[str],
    *,
    null_tokens: tuple[str, ...] = NULL_TOKENS,
    audit: Observation | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Split repaired records into text columns named by the header.

    A record with the wrong number of fields is kept
    and counted as malformed in the audit; the caller decides what that means.
    """
    line = F.rtrim("text", F.lit("\r\n"))
    fields = [f"c{i} STRING" for i in range(len(header))] + [f"{MALFORMED} STRING"]
    split = repaired.withColumn(
        "row", F.from_csv(line, ", ".join(fields), _CSV_OPTIONS)
    )
    if audit is not None:
        split = split.observe(
            audit,
            F.count("*").alias("rows"),
            F.count_if(F.col(f"row.{MALFORMED}").isNotNull()).alias("malformed_rows"),
            F.sum("control_bytes").alias("control_bytes"),
            F.sum("bad_bytes").alias("bad_bytes"),
            F.sum("source_replacements").alias("source_replacements"),
        )
    wanted = header if keep is None else keep
    return split.select(
        *[null_tokens_to_null(F.col(f"row.c{i}"), null_tokens).alias(name)
          for i, name in enumerate(header) if name in wanted]
    )
