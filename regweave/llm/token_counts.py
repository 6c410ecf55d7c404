"""Token counts of documents in flat token files.

A flat file is ids of a fixed width, one after another; an end-of-document id closes each
document and there is no index. Each block of a file is searched for that id in one
vector operation. A block knows its documents but the first, which may have begun any
number of blocks before; a prefix scan over the blocks - how many documents ended before,
and where the last one did - puts the numbers right. A document may span many blocks, a
block may hold no end at all.

Files are read by Spark, so they may lie in any store; a file must fit a Java array (2 GB).
`write_flat` keeps its files below FILE_BYTES by the longest text there is, but for a text
that is longer than that by itself.

Defined results: a null text is empty and counts 0 tokens; an empty file has no documents;
ids after the last end are a last document with terminated false; two ends in a row are an
empty document; repeated and null ids are documents of their own; very long texts span blocks
and shorten the files' lists; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, slices, table, texts_of
from .tokens import default_vocabulary, encoder

#: Fixed value: the vocabulary's end-of-text id. Bytes of an id.
END_ID, WIDTH = 50_256, 2
#: Ids of a block; documents of a file, and its bytes.
BLOCK, FILE_DOCS, FILE_BYTES = 1 << 20, 4_000, 256 << 20


def docs_per_file(docs: DataFrame) -> int:
    """So many of even the longest text keep a file below FILE_BYTES: an id is a byte of text at least."""
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0
    return max(1, min(FILE_DOCS, FILE_BYTES // (WIDTH * (longest + 1))))


def write_flat(docs: DataFrame, path: str, *, vocabulary: str | None = None, per_file: int | None = None) -> DataFrame:
    """Write the texts' ids as flat files of little-endian 16-bit ids, in the order of the rows.

    Gives the rows (doc_id, part, place): a document is number place % per_file of the part's
    file place // per_file. The rows must come straight from files, so that their order is
    the same each time they are read.
    """
    per_file = per_file or docs_per_file(docs)
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary)  # without added tokens: only a separator may have the end id
        for batch in batches:
            for part in slices(batch):
                ids, bounds = ids_of.batch(texts_of(part))
                flat = ids.astype("<u2").tobytes()
                edges = (bounds * WIDTH).tolist()
                rows = [flat[a:b] for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    # Spark's text writer puts the bytes as they are and ends each row with the end id's.
    end = END_ID.to_bytes(WIDTH, "little").decode("latin-1")
    ids = docs.select("text").mapInArrow(encode, "ids binary")
    (
        ids.select(F.col("ids").cast("string")).write.option("lineSep", end).option("encoding", "ISO-8859-1")
        .option("compression", "none").option("maxRecordsPerFile", per_file).text(path)
    )
    at = F.monotonically_increasing_id()  # task in the upper bits, row in the lower 33
    return docs.select("doc_id", at.alias("_at")).select(
        "doc_id", F.shiftright("_at", 33).alias("part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("place")
    )


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """Flat files as rows (path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def document_spans(files: DataFrame, *, width: int = WIDTH, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Documents of flat files: path, ordinal, start, n_tokens (without the end id), terminated."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("end", pa.int64()), ("begin", pa.int64()), ("terminated", pa.bool_())])
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), dtype=f"<u{width}")
                for number in range(-(-len(ids) // block)):
                    first = number * block
                    part = ids[first:first + block]
                    ends = np.flatnonzero(part == end_id) + first
                    closed = np.ones(len(ends), dtype=bool)
                    if first + block >= len(ids) and part[-1] != end_id:
                        ends, closed = np.append(ends, len(ids)), np.append(closed, False)
                    begins = np.concatenate([[-1], ends[:-1] + 1])[:len(ends)]
                    docs = pa.StructArray.from_arrays([pa.array(ends), pa.array(begins), pa.array(closed)], fields=list(kind))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path.as_py()]), pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays([0, len(ends)], docs),
                    ], ["path", "block", "docs"])

    blocks = files.select("path", "content").mapInArrow(
        scan, "path string, block long, docs array<struct<end: long, begin: long, terminated: boolean>>"
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("docs") > 0, F.element_at("docs", -1)["end"] + 1)
    stitched = blocks.withColumns({
        "docs_before": F.coalesce(F.sum(F.size("docs")).over(before), F.lit(0)),
        "begun": F.coalesce(F.max(last).over(before), F.lit(0)),
    })
    begin = F.when(F.col("d.begin") < 0, F.col("begun")).otherwise(F.col("d.begin"))
    return stitched.select("path", "docs_before", "begun", F.posexplode("docs").alias("k", "d")).select(
        "path", (F.col("docs_before") + F.col("k")).alias("ordinal"), begin.alias("start"),
        (F.col("d.end") - begin).alias("n_tokens"), F.col("d.terminated").alias("terminated"),
    )


def op1_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, by way of flat token files."""
    path = scratch(spark, "flat")
    docs = table(spark, sf_dir, "documents")
    per_file = docs_per_file(docs)
    rows = write_flat(docs, path, per_file=per_file)
    name = r"part-(\d+)-.*-c(\d+)[^/]*$"
    spans = document_spans(read_flat(spark, path)).select(
        F.regexp_extract("path", name, 1).cast("long").alias("part"),
        (F.regexp_extract("path", name, 2).cast("long") * per_file + F.col("ordinal")).alias("place"),
        "start", "n_tokens", "terminated",
    )
    missing = F.raise_error(F.lit("the rows were not read in the order they were written")).cast("long")
    return rows.join(spans, ["part", "place"], "left").select(
        "doc_id", F.when(F.col("n_tokens").isNull(), missing).otherwise(F.col("n_tokens")).alias("n_tokens"),
        "start", "terminated",
    )
