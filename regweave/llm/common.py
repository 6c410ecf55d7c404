"""What the operators share: tables, words, tables in the shared folder, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.session import shared_folder

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python task works on at a time.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that every executor can reach."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Paths that scratch() gives inside are deleted at the end: what reads them must have run."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def written(df: DataFrame, name: str, *, partition_by: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: worked out once, kept when executors go."""
    path = scratch(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of rows that Spark hands a Python task at a time.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on, the session's Python tasks get batches of BATCH_BYTES, unless it has a size of
    its own. By Spark's usual 10,000 rows or 64 MB, a batch and the copies made of it on its way
    take a good part of a small executor. Results don't depend on it."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, str(BATCH_BYTES))


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about SLICE_BYTES of text; no row is split."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which null keys match; only the left side's keys stay."""
    for key in keys:
        right = right.withColumnRenamed(key, f"_{key}")
    on = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return left.join(right, on, how).drop(*(f"_{key}" for key in keys))


#: Bits that mark hashes, whatever their number.
MARKS = 1 << 24


def marks_of(hashes: DataFrame) -> bytes:
    """MARKS bits, those of the given hashes (a column of longs) set; 2 MB come to the driver."""
    slot = F.col(hashes.columns[0]).bitwiseAND(MARKS - 1)
    size = 32_768  # Fixed value: bits of what bitmap_construct_agg makes.
    rows = hashes.select(F.floor(slot / size).alias("k"), (slot % size).alias("at")).groupBy("k").agg(
        F.bitmap_construct_agg("at").alias("bits")
    ).collect()
    found = {r["k"]: bytes(r["bits"]) for r in rows}
    return b"".join(found.get(k, b"").ljust(size // 8, b"\0") for k in range(MARKS // size))


def packed(docs: DataFrame, *others: str, marks: bytes | None = None) -> DataFrame:
    """doc_id, text and other columns of every row as (doc_id, data, others): compressed UTF-8, null as empty.
    For joins that move texts; the others are longs. With `marks`, only rows whose first other
    column, a hash, is marked: all that a join asks for, and what shares their bits."""
    names = ["doc_id", "data", *others]
    sent = docs.sparkSession.sparkContext.broadcast(marks)  # MARKS bits

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        bits = None if sent.value is None else np.frombuffer(sent.value, dtype=np.uint8)
        for batch in batches:
            if bits is not None:
                slot = batch.column(2).to_numpy(zero_copy_only=False) & (MARKS - 1)
                batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(batch):
                data = [tool.compress(x.encode()) for x in texts_of(part)]
                columns = [part.column(0), pa.array(data, pa.binary()), *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *others)
    return rows.mapInArrow(press, "".join(["doc_id long, data binary", *(f", {x} long" for x in others)]))


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch of packed texts in parts of few rows."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each run of `width` values."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:-k], x[k:])
        k *= 2
    return pick(x[:k - width], x[width - k:]) if k < width else x
