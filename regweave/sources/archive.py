"""CSV members of zip archives as raw records.

Spark has no zip reader, and a deflate stream can only be read front to back, so
one task per member inflates it and cuts it where records end. It holds a single
block at a time; its output is spread over the cluster, where all further work -
repair, splitting into fields, writing - happens.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from regweave.registry import registry_frame
from regweave.sources.records import header_names, repair_records

MEMBER_SCHEMA = "archive string, member string, size bigint, crc bigint, record binary"
RECORD_SCHEMA = "block bigint, record binary"
READ_SIZE = 1 << 20
#: inflated bytes for each partition that repairs and parses a member
PARTITION_BYTES = 32 << 20
_QUOTE, _COMMA, _LF, _CR = b'",\n\r'
_BOM = b"\xef\xbb\xbf"
#: a quoted field up to its closing quote, which may not have been read yet
_QUOTED = re.compile(rb'(?:\A|(?<=[,\r\n]))"(?:[^"]+|"")*+"?')


def open_binary(uri: str):
    """A seekable file: a plain path, or any URI Arrow can open."""
    if "://" not in uri:
        return open(uri, "rb")
    files, path = pa_fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def csv_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [m for m in archive.infolist() if m.filename.upper().endswith(".CSV")]


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()),
                        ("crc", pa.int64()), ("record", pa.binary())])
    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            rows = []
            with open_binary(uri) as file, zipfile.ZipFile(file) as archive:
                for member in csv_members(archive):
                    with archive.open(member) as stream:
                        first = next(cut_records(stream), None)
                    rows.append((uri, member.filename, member.file_size, member.CRC,
                                 None if first is None else first[0].as_py()))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)


def manifest(spark: SparkSession, archives: list[str]) -> DataFrame:
    """The CSV members of archives: uncompressed size, checksum and header.

    The header is the first record, repaired like any other.
    """
    paths = spark.createDataFrame([(a,) for a in archives], "archive string")
    first = paths.repartition(len(archives)).mapInArrow(_list_members, MEMBER_SCHEMA)
    listing = repair_records(first, keep_blank=True)
    return listing.select("archive", "member", "size", "crc", header_names(F.col("text")).alias("header"))


def unregistered_members(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Members the registry does not know: the publisher changed the extract."""
    known = registry_frame(spark).select("member")
    return listing.select("member").distinct().join(known, "member", "left_anti").orderBy("member")


def _record_ends(data: bytes, final: bool) -> np.ndarray:
    """Where records end for certain: after a line end outside quotes.

    A quote opens only at the start of a field. While every quote that would open
    by counting stands there, or continues a doubled quote, counting them decides;
    otherwise the quoted fields are searched one by one.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    breaks = (codes == _LF) | (codes == _CR)
    # CR LF is one line end, and a CR read last may be half of one.
    breaks[:-1] &= ~((codes[:-1] == _CR) & (codes[1:] == _LF))
    breaks[-1] &= final or codes[-1] != _CR
    at = np.flatnonzero(breaks)
    quotes = np.flatnonzero(codes == _QUOTE)
    if not len(quotes):
        return at + 1
    opening = quotes[::2]
    before = codes[opening - 1]
    edge = (opening == 0) | np.isin(before, (_COMMA, _LF, _CR)) | (before == _QUOTE)
    if edge.all():
        return at[np.searchsorted(quotes, at) % 2 == 0] + 1
    spans = np.array([m.span() for m in _QUOTED.finditer(data)], dtype=np.int64).reshape(-1, 2)
    inside = np.searchsorted(spans[:, 0], at) > np.searchsorted(spans[:, 1], at, side="right")
    return at[~inside] + 1


def cut_records(stream, read_size: int = READ_SIZE) -> Iterator[pa.BinaryArray]:
    """Blocks of whole CSV records as byte arrays.

    LF, CR LF and CR end a record outside quotes; where the reads fall makes no
    difference. A record may be as long as an Arrow value (2 GB).
    """
    carry = stream.read(len(_BOM)).removeprefix(_BOM)
    while True:
        # Reading as much as is carried keeps the work on one long record linear.
        chunk = stream.read(max(read_size, len(carry)))
        data = carry + chunk
        if not data:
            return
        ends = _record_ends(data, final=not chunk)
        if not chunk and (len(ends) == 0 or ends[-1] < len(data)):
            ends = np.append(ends, len(data))
        if len(ends):
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.BinaryArray.from_buffers(
                pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
            )
        if not chunk:
            return
        carry = data[ends[-1]:] if len(ends) else data


def _inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with open_binary(row["archive"]) as file, zipfile.ZipFile(file) as archive:
                with archive.open(row["member"]) as stream:
                    for number, records in enumerate(cut_records(stream)):
                        if number == 0:
                            records = records.slice(1)  # the header
                        blocks = pa.repeat(pa.scalar(number, pa.int64()), len(records))
                        yield pa.RecordBatch.from_arrays([blocks, records], names=["block", "record"])


def member_records(spark: SparkSession, archive: str, member: str, size: int) -> DataFrame:
    """The records of one member, spread in partitions of even size.

    Blocks choose their partition by number, so a task that runs again after a
    lost executor sends every record to the same place.
    """
    entry = spark.createDataFrame([(archive, member)], "archive string, member string").coalesce(1)
    partitions = -(-size // PARTITION_BYTES) or 1
    return entry.mapInArrow(_inflate, RECORD_SCHEMA).repartition(partitions, F.col("block")).select("record")
