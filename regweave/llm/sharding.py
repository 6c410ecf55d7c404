"""Longest-processing-time scheduling of groups onto shards.

Rows of equal texts form a group that stays together. Groups go, largest first, to the
least loaded shard, which a heap gives. Done over all groups at once this would be one
long sequential loop, so it is done in levels:

- A group of at least a `FINE`-th of a shard's fair load is large. There are at most
  shards * FINE of them, whatever the input; they enter the last level as they are.
- The rest is dealt by hash into buckets of about `BUCKET` groups. Each bucket is
  scheduled by itself onto `shards` bins, and its bins are the groups of the next level,
  until at most `BUCKET` remain. Those and the large groups are scheduled exactly.

Bins of a bucket differ by less than one small group, so the shards do in the end. A
group larger than a shard's fair load has a shard to itself; splitting it would part
what must stay together.

Slots are numbered within chunks of a shard; the counts of the chunks before give each
chunk its first slot, so no shard is sorted as a whole.

Defined results: a null text counts as empty (16 bytes, checksum 0, one group with the
empty texts); null and repeated ids are rows like others; ties go by the group's hash
and the lower shard; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Groups scheduled at once.
BUCKET = 20_000
#: Parts of a fair load from which a group is large.
FINE = 100
#: Rows of a shard numbered together.
CHUNK = 2_000


def schedule(sizes: list[int], bins: int) -> list[int]:
    """The bin of each item, items being in descending order of size."""
    heap = [(0, k) for k in range(bins)]
    out = []
    for size in sizes:
        load, k = heap[0]
        heapq.heapreplace(heap, (load + size, k))
        out.append(k)
    return out


def assign(groups: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Shards of groups (key binary, size long): of the large ones, of which there are few, and of the rest."""
    spark = groups.sparkSession
    most = max(BUCKET, 4 * shards)  # else a level would not shrink
    n, total = groups.agg(F.count("*"), F.sum("size")).first()
    least = max(1, -(-(total or 0) // (shards * FINE)))
    large = groups.where(F.col("size") >= least)
    level, steps = groups.where(F.col("size") < least), []
    while n > most:
        buckets = -(-n // most)

        def deal(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["size", "key"], ascending=[False, True])
            part["bin"] = schedule(part["size"].tolist(), shards)
            return part[["key", "size", "bucket", "bin"]]

        placed = level.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(
            deal, "key binary, size long, bucket long, bin int"
        )
        to = F.unhex(F.md5(F.concat_ws(":", F.lit(len(steps)), "bucket", "bin")))
        placed = written(placed.select("key", "size", to.alias("to")), "lpt")
        steps.append(placed.select("key", "to"))
        level = placed.groupBy(F.col("to").alias("key")).agg(F.sum("size").alias("size"))
        n = buckets * shards
    # At most BUCKET bins or groups and shards * FINE large ones, whatever the input.
    rows = sorted(
        ((r["size"], bytes(r["key"]), False) for r in level.collect()), key=lambda r: (-r[0], r[1])
    ) + [(r["size"], bytes(r["key"]), True) for r in large.collect()]
    rows.sort(key=lambda r: (-r[0], r[1]))
    shard = schedule([r[0] for r in rows], shards)
    schema = "key binary, shard int"
    top = [spark.createDataFrame([(r[1], s) for r, s in zip(rows, shard) if r[2] is kind], schema) for kind in (True, False)]
    rest = top[1]
    if steps:
        rest = F.broadcast(rest)
        for step in reversed(steps):
            rest = step.join(rest.withColumnRenamed("key", "to"), "to").select("key", "shard")
    return top[0], rest


def shard_rows(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (key binary, size long and others) with shard and slot; rows of a key stay together."""
    large, rest = assign(rows.groupBy("key").agg(F.sum("size").alias("size")), shards)
    # A hot key is large, so the shuffled join has only keys of few bytes.
    parts = [rows.join(F.broadcast(large), "key"), rows.join(F.broadcast(large), "key", "left_anti").join(rest, "key")]
    placed = written(reduce(DataFrame.unionByName, parts), "shards")
    chunks = max(1, placed.count() // (shards * CHUNK))
    names = [c for c in placed.columns if c not in ("key", "shard")]
    chunk = F.pmod(F.xxhash64("key", *names), F.lit(chunks))
    placed = placed.withColumn("chunk", chunk)
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "chunk").count().select(
        "shard", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    own = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy(*names, "key")) - 1
    return placed.withColumn("own", own).join(firsts, ["shard", "chunk"]).withColumn(
        "slot", F.col("first") + F.col("own")
    ).drop("own", "first", "chunk")


def op4_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 40 shards of near equal bytes, equal texts together."""
    text = F.coalesce("text", F.lit(""))
    rows = written(table(spark, sf_dir, "documents").select(
        F.expr("substring(unhex(sha2(coalesce(text, ''), 256)), 1, 16)").alias("key"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ), "rows")
    return shard_rows(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
