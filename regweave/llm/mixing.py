"""Mixing sources to target weights over fixed-length blocks.

The texts of a source, one after another, are one stream of words, cut into blocks of
`BLOCK` words. Every source is given a number of slots so that its words come to its
target; a source's target stops at `MOST` times its size, so no block is used more
often than that. A keyed permutation of all slots deals them to output shards: the
source counts of a shard are those of a multinomial draw given the sources' totals (slots
drawn without putting back), so the targets are met and not only expected. A slot comes out
with its shard, and the mix by shard in the order of its slots, so what the draw puts
together stays together. Slots are generated, pages of them by tasks whose number follows
from the slots; Spark takes them for few, so the joins say that they are not to be sent
whole. The slots of a source run through its blocks in a pseudorandom order of their
indexes, another one for each pass, and slots and blocks meet in a join by (source, block).
Texts take no part in any of this: they meet the places that the mix gives them once, are
cut there, and move once more, to their shards.

Permutations are "swap or not" networks: each round pairs x with K - x (mod n) and a
hash of the pair decides which of the two it becomes. They work for any n, need no
table and no sort, and are plain arithmetic in the plan.

All of it is DataFrame operations. A hot source is spread over chunks for its running
offsets, over pages for its slots, and over blocks for the join.

Defined results: a null or empty text has no words and is never taken; a null source is
a source of its own, last in order; repeated rows and null ids are documents of their
own; ties in the order of a stream fall to the id, then the text's hash; an empty table
gives no rows; where no document has a word all targets are 0; very long texts are cut
once, whole, however many blocks they reach into; rows equal in id, source and text count
each, and the mix has the other columns of one of them; extra columns stay as they are,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, word_count, written

#: Words of a block.
BLOCK = 128
#: Weights of the sources in order, repeating; total of the mix and cap of a source, in sizes.
WEIGHTS, TOTAL, MOST = (3, 1, 2), 1.5, 2.0
#: Documents of a source placed together; slots generated by one row; rows of those in a task.
CHUNK, PAGE, PAGES = 2_000, 4_096, 16
ROUNDS, SEED = 16, 20_240_229


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """x, a number below n, mapped by a permutation that `key` chooses."""

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), *key, r), n) - at, n)
        coin = F.xxhash64(F.lit(~SEED), *key, r, F.greatest(at, other))
        return F.when(coin.bitwiseAND(1) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x, step)


def targets(sizes: DataFrame) -> DataFrame:
    """Sources (source, source_size) with sid and target: shares by weight, capped, the excess reshared.

    With sources in order of cap over weight, the capped ones come first; the level that
    the others share by is the largest of the levels after each prefix.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    return (
        sizes.withColumn("sid", (number - 1).cast("long")).withColumn("weight", weight)
        .withColumn("cap", MOST * F.col("source_size"))
        .withColumn("level", (
            TOTAL * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        ) / F.sum("weight").over(after))
        .withColumn("target", F.least("cap", F.max("level").over(every) * F.col("weight")))
        .select("source", "sid", "source_size", "target")
    )


@dataclass(frozen=True)
class Mix:
    """docs: every row with sid, source_size, target and the word it starts at in its source's
    stream; slots: slot, shard, sid and block of every slot of the mix."""

    docs: DataFrame
    slots: DataFrame


def plan(rows: DataFrame, shards: int = 64) -> Mix:
    """The mix of rows (source, size long, key long and others); `key` breaks ties of doc_id."""
    sources = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    small = sources.withColumnRenamed("source", "_source")
    rows = rows.join(small, rows["source"].eqNullSafe(small["_source"]), "left").drop("_source")
    chunks = max(1, rows.count() // CHUNK)
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "key"), F.lit(chunks)))
    whole = Window.partitionBy("sid").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("sid", "_chunk").agg(F.sum("size").alias("_words")).select(
        "sid", "_chunk", F.coalesce(F.sum("_words").over(whole), F.lit(0)).alias("_first")
    )
    own = Window.partitionBy("sid", "_chunk").orderBy("doc_id", "key")
    docs = (
        rows.withColumn("_own", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("row_no", F.row_number().over(own))
        .join(firsts, ["sid", "_chunk"])
        .withColumn("start", F.col("_first") + F.col("_own"))
        .withColumn("row_no", F.struct(F.col("_chunk").alias("chunk"), F.col("row_no").alias("no")))
        .drop("_first", "_own", "_chunk")
    )
    return Mix(docs, slots_of(sources, shards))


def slots_of(sources: DataFrame, shards: int) -> DataFrame:
    """Every slot of the mix with its shard, source and block."""
    blocks = F.ceil(F.col("source_size") / BLOCK)
    wanted = F.round(F.col("target") / F.col("source_size") * blocks).cast("long")
    every = Window.orderBy("sid")
    counted = (
        sources.where(F.col("source_size") > 0).withColumn("blocks", blocks).withColumn("slots", wanted)
        .withColumn("first", F.sum("slots").over(every) - F.col("slots"))
        .withColumn("all_slots", F.sum("slots").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .where(F.col("slots") > 0)
    )
    total = counted.agg(F.sum(F.ceil(F.col("slots") / PAGE))).first()[0] or 0
    pages = counted.withColumn("page", F.explode(F.sequence(F.lit(0), F.ceil(F.col("slots") / PAGE) - 1)))
    pages = pages.repartition(max(1, -(-total // PAGES)), "sid", "page")  # a number, which stays
    last = F.least((F.col("page") + 1) * PAGE, F.col("slots")) - 1
    ranks = pages.withColumn("rank", F.explode(F.sequence(F.col("page") * PAGE, last))).select(
        "sid", "blocks", "all_slots", (F.col("first") + F.col("rank")).alias("slot"),
        F.floor(F.col("rank") / F.col("blocks")).alias("turn"), (F.col("rank") % F.col("blocks")).alias("block"),
    )
    size = F.greatest(F.ceil(F.col("all_slots") / shards), F.lit(1))
    return ranks.select(
        permuted(F.col("slot"), F.col("all_slots"), F.lit("shards")).alias("slot"), "sid",
        permuted(F.col("block"), F.col("blocks"), F.col("sid"), F.col("turn")).alias("block"), size.alias("size"),
    ).select("slot", F.floor(F.col("slot") / F.col("size")).alias("shard"), "sid", "block")


def pieces(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Each document's part of each block it reaches into: block, words."""
    first, last = F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    spread = F.when(F.col("size") > 0, F.sequence(first, last))
    out = docs.select("sid", "row_no", "start", "size", *columns, F.explode_outer(spread).alias("block"))
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return out.withColumn("words", end - F.greatest(F.col("start"), F.col("block") * BLOCK))


def rows_of(docs: DataFrame, *columns: str) -> DataFrame:
    """What plan() asks for; other columns of the table are not read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("key"), *columns,
    )


def taken(mix: Mix) -> DataFrame:
    """Words the mix takes of each document, repeats counted, and the slots they go to, in order:
    `places` has shard, slot and the document's words there."""
    held = F.col("slot").isNotNull()
    place = F.when(held, F.struct("shard", "slot", "words"))
    return (
        pieces(mix.docs, "doc_id", "source_size", "target").join(mix.slots.hint("merge"), ["sid", "block"], "left")
        .groupBy("sid", "row_no", "doc_id", "size", "source_size", "target")
        .agg(
            F.coalesce(F.sum(F.when(held, F.col("words"))), F.lit(0)).alias("taken"),
            F.sort_array(F.collect_list(place)).alias("places"),
        )
    )


def _dealt(docs: DataFrame, shards: int) -> DataFrame:
    """The mix as rows (held, text, shard, slot) in the order of shards and slots; `held` has the
    document's other columns."""
    keys = [F.xxhash64(F.lit(k), F.col("doc_id").cast("long"), "source", "text").alias(f"key{k}") for k in (1, 2)]
    held = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("held")
    mix = plan(written(rows_of(docs, *keys), "mix"), shards)
    first = F.greatest(F.col("start"), F.col("block") * BLOCK) - F.col("start")
    placed = pieces(mix.docs, "key1", "key2").where("words > 0").select(
        "sid", "block", "key1", "key2", "row_no", first.cast("int").alias("first"), F.col("words").cast("int").alias("words")
    )
    # At most MOST blocks' worth of places for each of the document's own.
    places = placed.join(mix.slots.hint("merge"), ["sid", "block"]).groupBy("key1", "key2", "sid", "row_no").agg(
        F.collect_list(F.struct("shard", "slot", "first", "words")).alias("places")
    )
    texts = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"), held).dropDuplicates(["key1", "key2"])
    found = F.regexp_extract_all("text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    cut = F.transform("p", lambda x: F.struct(
        x["shard"].alias("shard"), x["slot"].alias("slot"), x["first"].alias("first"),
        F.array_join(F.slice(F.col("w"), x["first"] + 1, x["words"]), "").alias("text"),
    ))
    # The words of a text are found once: the array is a column of its own before the places are read.
    whole = texts.join(places.hint("merge"), ["key1", "key2"]).select("held", F.col("places").alias("p"), F.explode(F.array(found)).alias("w"))
    out = whole.select("held", F.explode(cut).alias("x")).select("held", "x.*")
    return out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot", "first").drop("first")


def _columns(docs: DataFrame) -> list[Column]:
    """The columns of the table from a row of the mix."""
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("text"))
        elif name == "n_chars":
            columns.append(F.length("text").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("held").getField(name).alias(name))
    return columns


def mixed(docs: DataFrame, shards: int = 64) -> DataFrame:
    """The mix as rows of the table, by shard in the order of its slots (see dealt)."""
    return _dealt(docs, shards).select(*_columns(docs))


def dealt(docs: DataFrame, shards: int = 64) -> DataFrame:
    """The mix as rows of the table with `_shard` and `_slot`, in their order: a row for each
    document's part of each slot's block.

    `text` is that part with the white space after its words (what stands before a text's
    first word is lost) and `n_chars`, if there, its length; the other columns are the
    document's.
    """
    return _dealt(docs, shards).select(F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), *_columns(docs))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a mix of 150 % of their words."""
    rows = written(rows_of(table(spark, sf_dir, "documents")), "mix")
    return taken(plan(rows)).select("doc_id", "size", "source_size", "target", "taken", "places")
