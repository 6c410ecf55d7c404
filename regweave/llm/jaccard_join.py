"""Similarity join of texts on word shingles (method: adaptive multi-match prefixes).

A text's set is its distinct shingles of words; two texts link when their sets' Jaccard
similarity reaches a threshold. Shingles have one global order, rarer ones first. If x and
y are similar, their prefixes of |x| - a + l shingles (a: the least overlap x allows) share
at least l of them, for every l. Each text chooses its own l: a longer prefix costs more
postings but asks candidates to share more of them. With f the summed frequency of a
prefix, at most f / l candidates pass, so l minimises f + VERIFY * f / l. A pair uses the
smaller l of the two, and the prefixes which that l and the overlap o needed by two sets of
their sizes leave, n - o + l shingles. Whatever l is, similar sets share one shingle in the
first n - o + 1: pairs are drawn up there, and each then has its l matches counted once.

How it stays linear where many texts are alike:

- Equal sets are one class, with a number of its own; the row of its least id stands for it.
- Each shared prefix shingle has a hub, the text with most shared prefix shingles. Texts are
  first verified against their hubs only: in a group of copies this links all that are near
  the hub, with one comparison each.
- The full candidate search then takes only pairs of different components, so a group
  that is linked already makes no pairs. A text whose prefix shares fewer shingles
  than any partner could ask for takes no part.
- Each text has a signature of SIGNATURE bits, for each the parity of its shingles with that
  hash. Two sets differ in at least as many shingles as their signatures in bits, so pairs
  whose signatures differ by more than similar sets can are dropped where they are drawn up:
  texts that share a shingle by chance make no rows.
- Verification sends each text, compressed, to the hub it is compared with; a hub with many
  texts is split over tasks, each of which gets the hub's text. Texts compared with none stay
  where they are, but for those that share a bit of a fixed bit map with one that moves.

Frequencies only steer the order and l, never the result. They come from all texts: every
task keeps a bounded summary of its most frequent shingles and words (those more frequent
than 1 / SUMMARY of them are sure to be in it), and the HEAVY most frequent of all, bounded
tables, go to every task. A shingle in no table counts as often as its words would meet by
chance: where shingles of rare words come first, unrelated texts share few of them.

Defined results: a text without words, or null, has an empty set and links with nothing;
with fewer words than a shingle the whole sequence is its one shingle; a row goes by its id
and a hash of its id and text, so rows with the same id or a null one are linked by their
texts like all others; a component's first row is that with the least id (null ids last),
then the least hash, and names it by its id, null where no row of it has one; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import marks_of, packed, parts, slices, small_batches, table, unpacked, written
from .components import components

#: Shingles in a task's summary, and in the table of frequent ones.
SUMMARY, HEAVY = 100_000, 100_000
#: Times a shingle must be counted to be called frequent.
OFTEN = 8
#: Most shared shingles asked for; cost of verifying a candidate, in postings.
MOST_MATCHES, VERIFY = 8, 20
#: Bits of a signature, in longs.
SIGNATURE = 512
WORDS_OF_SIGNATURE = [f"s{k}" for k in range(SIGNATURE // 64)]
#: Texts compared with one hub in one group.
HUB_TEXTS = 500

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD2
    return (x ^ (x >> np.uint64(29))) * _ODD


def _words_of(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray]:
    """The words of each text and the hashes of all of them, one after another."""
    seen: dict[bytes, int] = {}
    found = [x.encode().lower().split() for x in texts]  # bytes: A-Z, ASCII spaces
    flat = [seen.setdefault(w, len(seen)) for ws in found for w in ws]
    kinds = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in seen), dtype=np.uint64, count=len(seen))
    return found, kinds[np.array(flat, dtype=np.int64)] if flat else kinds


def _shingles(found: list[list[bytes]], hashed: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, slice, int]]:
    """For each text its shingles' hashes in order, where its words are, and words of a shingle."""
    at = 0
    for ws in found:
        n, own = len(ws), hashed[at:at + len(ws)]
        width = min(n, size)
        key = np.full(max(n - width + 1, 0) if n else 0, width, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                key = _mix(key * _ODD + own[k:n - width + 1 + k])
        yield key, slice(at, at + n), width
        at += n


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    return [np.unique(key) for key, _, _ in _shingles(*_words_of(texts), size)]


def signature(own: np.ndarray) -> np.ndarray:
    """The parity of a set's shingles, by their lowest bits, as longs."""
    odd = np.bincount((own % np.uint64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def least_overlap(n: int, percent: int) -> int:
    """Shingles that any similar text must share with one of n shingles."""
    return -(-n * percent // 100)


def links_only_equals(n: int, percent: int) -> bool:
    return n * 100 // percent == n


class _Counts:
    """Counts of frequent hashes."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.counts = tokens[by], counts[by]

    def of(self, own: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(own), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
        return np.where(self.tokens[at] == own, self.counts[at], 0)


#: A doubling of a count, in the steps that order shingles.
STEPS = 16


class _Order:
    """The global order of shingles: by their counts, those not counted by their words' and by hash."""

    def __init__(self, shingles: _Counts, words: _Counts):
        self.shingles, self.words = shingles, words
        self.all_words = max(int(words.counts.sum()), 1)

    def sets(self, texts: list[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The distinct shingles of each text, sorted, their counts, and the steps of chance."""
        found, hashed = _words_of(texts)
        steps = np.rint(STEPS * np.log2(np.maximum(self.words.of(hashed), 1))).astype(np.int64)
        for key, where, width in _shingles(found, hashed, size):
            own, first = np.unique(key, return_index=True)
            each = steps[where]
            chance = sum((each[k:len(key) + k] for k in range(width)), np.zeros(len(key), dtype=np.int64))
            yield own, self.shingles.of(own), chance[first] - round(STEPS * (width - 1) * np.log2(self.all_words))

    def prefix(self, own: np.ndarray, often: np.ndarray, steps: np.ndarray, percent: int) -> tuple[np.ndarray, int, int]:
        """A set's prefix, its length for one match, and the matches it asks for."""
        a = least_overlap(len(own), percent)
        first = len(own) - a + 1
        by = np.lexsort((own, steps, often))[: first + MOST_MATCHES - 1]
        most = min(MOST_MATCHES, a)
        texts = np.maximum(np.maximum(often[by], np.exp2(np.minimum(steps[by], 40 * STEPS) / STEPS)), 1)
        total = np.cumsum(texts)[first - 1:first - 1 + most]
        matches = int(np.argmin(total * (1 + VERIFY / np.arange(1, len(total) + 1)))) + 1
        return own[by[:first + matches - 1]], first, matches


class _Summary:
    """The frequent hashes of a task, in bounded memory (Misra-Gries)."""

    def __init__(self):
        self.tokens, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def add(self, hashes: np.ndarray) -> None:
        new, times = np.unique(hashes, return_counts=True)
        tokens, where = np.unique(np.concatenate([self.tokens, new]), return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate([self.counts, times])).astype(np.int64)
        if len(tokens) > 4 * SUMMARY:
            counts -= np.partition(counts, -SUMMARY)[-SUMMARY]
            tokens, counts = tokens[counts > 0], counts[counts > 0]
        self.tokens, self.counts = tokens, counts

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        keep = self.counts > 1
        tokens, counts = self.tokens[keep], self.counts[keep]
        top = np.argsort(-counts, kind="stable")[:SUMMARY]
        return tokens[top], counts[top]


_BASE = "doc_id long, key long, n long, set_key binary, word boolean, token long, count long"


def _base(docs: DataFrame, size: int) -> DataFrame:
    """A row (doc_id, key, n, set_key) for each text, and rows (word, token, count) of each task's
    summaries, of shingles and of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, words = _Summary(), _Summary()
        names = [x.strip().split(" ")[0] for x in _BASE.split(",")]
        for batch in batches:
            for part in slices(batch):
                found, hashed = _words_of([x or "" for x in part.column(1).to_pylist()])
                sets = [np.unique(key) for key, _, _ in _shingles(found, hashed, size)]
                words.add(hashed)
                shingles.add(np.concatenate(sets))
                keys = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                none = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()), pa.nulls(len(sets), pa.bool_()), none, none,
                    ], names
                )
        for word, summary in ((False, shingles), (True, words)):
            tokens, counts = summary.rows()
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays([
                none, none, none, pa.nulls(len(tokens), pa.binary()), pa.array([word] * len(tokens), pa.bool_()),
                pa.array(tokens.view(np.int64)), pa.array(counts),
            ], names)

    return written(docs.mapInArrow(run, _BASE), "sets")


def _heavy(base: DataFrame, word: bool, least: int) -> _Counts:
    """The most frequent shingles or words of all texts; at most HEAVY rows come here."""
    counted = base.where(F.col("word") == word).groupBy("token").agg(F.sum("count").alias("count"))
    rows = counted.where(F.col("count") >= least).orderBy(F.desc("count"), "token").limit(HEAVY).collect()
    return _Counts(
        np.array([r["token"] for r in rows], dtype=np.int64).view(np.uint64), np.array([r["count"] for r in rows], dtype=np.int64)
    )


def _prefixes(docs: DataFrame, size: int, percent: int, order: _Order) -> DataFrame:
    """key, set_key, n, first, matches, the prefix and the signature of every text that may link with others."""
    frequent = docs.sparkSession.sparkContext.broadcast(order)  # HEAVY shingles and words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = frequent.value
        for batch in batches:
            for part in slices(batch):
                keys = part.column(2).to_pylist()
                rows = []
                texts = [x or "" for x in part.column(1).to_pylist()]
                for row_key, (own, often, steps) in zip(keys, order.sets(texts, size)):
                    if len(own) and not links_only_equals(len(own), percent):
                        prefix, first, matches = order.prefix(own, often, steps, percent)
                        key = blake2b(own.tobytes(), digest_size=16).digest()
                        rows.append((row_key, key, len(own), first, matches, prefix.view(np.int64), *signature(own).tolist()))
                if rows:
                    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                    kinds += [pa.int64()] * len(WORDS_OF_SIGNATURE)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = ["key", "set_key", "n", "first", "matches", "prefix", *WORDS_OF_SIGNATURE]
    schema = "key long, set_key binary, n long, first long, matches long, prefix array<long>"
    return docs.mapInArrow(run, ", ".join([schema, *(f"{x} long" for x in WORDS_OF_SIGNATURE)]))


def _postings(prefixes: DataFrame) -> DataFrame:
    """Postings (token, rid, n, at, matches, shared) of shingles that two or more prefixes hold,
    without texts that share too few for any partner. Only places that count for one match stay."""
    posts = prefixes.select(
        "rid", "n", "first", "matches", F.posexplode("prefix").alias("at", "token")
    ).select("token", "rid", "n", F.col("at").cast("long").alias("at"), "first", "matches")
    common = posts.groupBy("token").agg(F.count("*").alias("texts"), F.min("matches").alias("asked")).where("texts > 1")
    posts = posts.join(common.drop("texts"), "token")
    able = posts.groupBy("rid").agg(
        F.count("*").alias("shared"), F.min("asked").alias("asked"), F.min("matches").alias("m")
    ).where(F.col("shared") >= F.least("asked", "m")).select("rid", "shared")
    return written(posts.where("at < first").drop("asked", "first").join(able, "rid"), "postings")


def _needed(percent: int):
    """The overlap that similar sets of the sizes a_n and b_n have at least."""
    return F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent))


def _in_prefixes(percent: int):
    """Whether a shared shingle lies in the first n - o + 1 of both, o the overlap needed: similar
    sets share one there, whatever number of matches they ask for."""
    return (F.col("a_at") <= F.col("a_n") - _needed(percent)) & (F.col("b_at") <= F.col("b_n") - _needed(percent))


def _signatures_allow(percent: int):
    """Whether the signatures differ by no more bits than similar sets of the sizes do by shingles."""
    bits = reduce(add, (F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in WORDS_OF_SIGNATURE))
    return bits <= F.col("a_n") + F.col("b_n") - 2 * _needed(percent)


def _with_both(pairs: DataFrame, prefixes: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with columns of both texts."""
    for name in ("b", "a"):
        pairs = pairs.join(prefixes.select(F.col("rid").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in columns)), name)
    return pairs


def _enough(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share l shingles in the first n - o + l of both prefixes, l the smaller of
    the numbers of matches they ask for."""
    pairs = _with_both(pairs, prefixes, ["n", "matches", "prefix"])
    asked = F.least("a_matches", "b_matches")
    heads = [F.slice(f"{x}_prefix", F.lit(1), F.greatest(F.col(f"{x}_n") - _needed(percent) + asked, F.lit(0)).cast("int")) for x in "ab"]
    return pairs.where(F.size(F.array_intersect(*heads)) >= asked).select("a", "b").distinct()


def _side(posts: DataFrame, name: str) -> DataFrame:
    return posts.select("token", *(F.col(c).alias(name if c == "rid" else f"{name}_{c}") for c in posts.columns if c != "token"))


def _star_pairs(posts: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Each text with the hubs of its shingles."""
    best = F.max(F.struct("shared", (-F.col("rid")).alias("low"), "n", "at")).alias("h")
    hubs = posts.groupBy("token").agg(best).select(
        "token", (-F.col("h.low")).alias("a"), F.col("h.n").alias("a_n"), F.col("h.at").alias("a_at")
    )
    texts = _side(posts.select("token", "rid", "n", "at"), "b")
    pairs = texts.join(hubs, "token").where((F.col("a") != F.col("b")) & _in_prefixes(percent)).select("a", "b").distinct()
    pairs = _with_both(pairs, prefixes, ["n", *WORDS_OF_SIGNATURE])
    return written(pairs.where(_signatures_allow(percent)).select("a", "b"), "near")


def _other_pairs(posts: DataFrame, prefixes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a shingle where similar sets do."""
    named = posts.join(labels.withColumnRenamed("node", "rid"), "rid", "left").select(
        "token", "rid", "n", "at", F.coalesce("label", "rid").alias("comp")
    )
    named = written(named, "named")
    mixed = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    named = named.join(mixed, "token").join(prefixes.select("rid", *WORDS_OF_SIGNATURE), "rid")
    return _side(named, "a").join(_side(named, "b"), "token").where(
        (F.col("a") < F.col("b")) & (F.col("a_comp") != F.col("b_comp")) & _in_prefixes(percent) & _signatures_allow(percent)
    ).select("a", "b").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; a is the hub of its pairs.

    Compressed texts travel to the hubs, a third of what their sets would take.
    """
    groups = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / HUB_TEXTS).cast("int").alias("parts"))
    members = pairs.join(groups, "a").select(
        F.col("b").alias("rid"), F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("late"),
    )
    heads = groups.select(
        F.col("a").alias("rid"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("late"),
    )
    texts = classes.select("rid", F.col("doc_id").alias("_id"), "key")
    to = written(members.unionByName(heads).join(texts, "rid"), "to")
    sent = packed(docs, "key", marks=marks_of(to.select("key"))).join(to, "key").where(F.col("doc_id").eqNullSafe(F.col("_id")))
    sent = sent.select("hub", "part", "late", "rid", "data")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, heads, last = None, [], None
        for whole in batches:
            for batch in parts(whole):
                a, b = [], []
                sets = shingle_sets([unpacked(x).decode() for x in batch.column(4).to_pylist()], size)
                for own, hub, part, late, rid in zip(sets, *(batch.column(k).to_pylist() for k in range(4))):
                    if (hub, part) != group:
                        group, heads, last = (hub, part), [], None
                    if (late, rid) == last:  # rows equal in id and text stand together
                        continue
                    last = (late, rid)
                    if not late:
                        heads.append(own)
                        continue
                    for head in heads:
                        both = len(np.intersect1d(head, own, assume_unique=True))
                        if both * 100 >= percent * (len(head) + len(own) - both):
                            a.append(hub)
                            b.append(rid)
                            break
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "late", "rid")
    return written(dealt.mapInArrow(compare, "a long, b long"), "links")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of both, which tells the rows of one id and those of none apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))


def _first():
    """The least (id, key) of a group, null ids last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")).alias("h")


def join(docs: DataFrame, *, size: int = 3, percent: int = 90) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, set_key, component_id, key and head.

    `key` tells rows of one id apart; `head` is the key of the component's first row, whose id
    is component_id.
    """
    small_batches(docs.sparkSession)
    docs = _keyed(docs)
    base = _base(docs, size)
    rows = base.where(F.col("set_key").isNotNull()).select("doc_id", "key", "n", "set_key")
    order = _Order(_heavy(base, False, OFTEN), _heavy(base, True, 1))
    classes = rows.where("n > 0").groupBy("set_key").agg(_first()).select("set_key", "h.doc_id", "h.key")
    # Numbered as they are written: read again, a class keeps its number.
    classes = written(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")
    prefixes = _prefixes(docs, size, percent, order).join(classes.select("set_key", "key", "rid"), ["set_key", "key"])
    prefixes = written(prefixes.dropDuplicates(["set_key", "key"]).drop("set_key", "key"), "prefixes")
    posts = _postings(prefixes)
    stars = _enough(_star_pairs(posts, prefixes, percent), prefixes, percent)
    near = _verified(written(stars, "pairs"), docs, classes, size, percent)
    labels = components(near)
    others = _enough(_other_pairs(posts, prefixes, labels, percent), prefixes, percent)
    rest = _verified(written(others, "pairs"), docs, classes, size, percent)
    # Hub links stand for their components: a label is linked with its nodes.
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(rest))
    placed = classes.join(labels.withColumnRenamed("node", "rid"), "rid", "left")
    placed = written(placed.withColumn("label", F.coalesce("label", "rid")), "placed")
    heads = placed.groupBy("label").agg(_first()).select("label", F.col("h.doc_id").alias("component_id"), F.col("h.key").alias("head"))
    named = placed.join(heads, "label").select("set_key", "component_id", "head")
    linked = rows.where("n > 0").join(named, "set_key", "left")
    alone = rows.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("head", F.col("key"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "set_key", "component_id", "key", "head")


def keep_one(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, one of each component: its first, and one of the rows equal to that in id
    and text. Texts without words stay."""
    found = join(docs, size=size, percent=percent).where("n_shingles > 0")
    first = (F.col("key") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    fate = found.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.max(first).alias("first"), F.count("*").alias("rows")
    ).where("not first or rows > 1")
    fate = written(fate, "fate")
    # The row goes in one piece, so no column of it can clash with the keys.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row"), whole)
    same = (F.col("row") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))
    alone = rows.join(fate, same, "left_anti")
    folded = rows.join(fate.where("first"), same, "left_semi").dropDuplicates(["id", "row"])
    return alone.unionByName(folded).select("held.*")


def op8_link_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles are similar to 0.9."""
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
