"""Removal of long byte strings that occur more than once (suffix arrays, two-stage sorting).

A string of DEPTH bytes is repeated if it begins at two places, in one text or in two. No
suffix array of a whole corpus is built; suffixes that can share DEPTH bytes are brought
together and sorted there:

- Every string of DEPTH bytes has an anchor, the GRAM bytes in it whose hash is least.
  Equal strings have equal anchors at the same place, so only anchors that occur twice in
  the corpus matter, about one in 85 bytes. An anchor's context is all strings it can anchor.
- Equal contexts of an anchor fold into one, with the number of its places: each string in a
  context with two places is repeated, and nothing more is asked about it. Where an anchor has
  no other context, as in copies of a text, nothing is sent or sorted at all.
- A string of DEPTH bytes reaches REACH bytes beyond its anchor to one side at least. A context
  that shares neither side, so far, with another context of its anchor has no repeats and is
  left out: anchors that recur by chance end here.
- A text goes by a key, a hash of its id and itself: rows that differ in either are texts of
  their own, and rows equal in both share their places, which are counted.
- An anchor's home is the least id that has it (a null one counts as its row's key): rows of
  one id have one home, which only groups work. Documents send the stretches around
  anchors to their homes, overlapping contexts as one stretch. A task sorts the suffixes of
  its homes (see suffix_array) and reads repeats off the common prefixes of neighbours.
- A home that draws more than HOME_CONTEXTS contexts (a phrase in a great many different
  surroundings) would not fit a task. Its contexts are halved: the strings in a half have
  more bytes in common than the anchor, and are grouped by those. Halves that are equal
  fold, halves that stand alone are done, and groups that are still crowded are halved
  again, down to single strings, of which equal ones are all the same.
- What is repeated in a context then holds wherever the context stands: the places of a text
  take the repeats of their contexts along, and the text only cuts them out.

Texts travel compressed. Defined results: a null text is empty; texts shorter than DEPTH
keep everything; repeated rows are repeats of each other, ids equal or not; null ids are
rows like others; very long texts are worked on whole, one at a time; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, parts, slices, slide, table, unpacked, written
from .suffix_array import DEPTH, repeated_starts

GRAM = 32
#: Gram starts in a string of DEPTH bytes.
STARTS = DEPTH - GRAM + 1
#: Bytes beside the anchor that a string has on one side at least.
REACH = STARTS // 2
#: Places of a context's first pieces; a power of two.
HALF = 128
#: Contexts a home may draw; bytes whose suffixes are sorted together at least.
HOME_CONTEXTS, BATCH_BYTES = 10_000, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all anchors, the hash of every gram, and the least hash of every string."""
    none = np.zeros(0, dtype=np.uint64)
    if len(data) < DEPTH:
        return np.zeros(0, dtype=np.int64), none, none
    n = len(data) - GRAM + 1
    word = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    with np.errstate(over="ignore"):
        grams = word[:n] * _ODD
        for k in range(8, GRAM, 8):
            grams ^= grams >> np.uint64(29)
            grams += word[k:k + n]
            grams *= _ODD2
        grams ^= grams >> np.uint64(32)
        grams *= _ODD
    least = slide(grams, STARTS, np.minimum)
    edge = np.zeros(STARTS - 1, dtype=np.uint64)
    reach = slide(np.concatenate([edge, least, edge]), STARTS, np.maximum)
    return np.flatnonzero(grams == reach), grams, least


def context(data: bytes, at: int) -> tuple[int, int, int]:
    """Where an anchor's context begins and ends, and its hash (with the anchor's place in it)."""
    a, b = max(0, at - STARTS + 1), min(len(data), at + DEPTH)
    return a, b, _signed(xxhash.xxh3_64_intdigest(data[a:b], seed=at - a))


def sides(data: bytes, at: int) -> tuple[int | None, int | None]:
    """Hashes of an anchor with REACH bytes before it and with REACH bytes after it, where there are as many."""
    a, b = at - REACH, at + GRAM + REACH
    return (
        _signed(xxhash.xxh3_64_intdigest(data[a:at + GRAM])) if a >= 0 else None,
        _signed(xxhash.xxh3_64_intdigest(data[at:b], seed=1)) if b <= len(data) else None,
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bytes_of(part: pa.RecordBatch) -> list[bytes]:
    return [(x or "").encode() for x in part.column(1).to_pylist()]


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = [np.zeros(0, dtype=np.uint64)]
            for data in _bytes_of(part):
                at, grams, _ = anchors(data)
                found.append(grams[at])
            kinds, times = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], ["g", "n"])


_PLACES = ["g", "c", "doc", "key", "ats", "before", "after"]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of each text, with their places in it."""
    for batch in batches:
        for part in slices(batch):
            rows = []
            for key, data, doc in zip(part.column(0).to_pylist(), _bytes_of(part), part.column(2).to_pylist()):
                at, grams, _ = anchors(data)
                seen: dict[tuple[int, int], list[int]] = {}
                for p, g in zip(at.tolist(), grams[at].view(np.int64).tolist()):
                    seen.setdefault((g, context(data, p)[2]), []).append(p)
                rows += [(g, c, doc, key, ps, *sides(data, ps[0])) for (g, c), ps in seen.items()]
            if rows:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], _PLACES)


_MEMBER = pa.struct([(x, pa.int64()) for x in ("at", "g", "c", "n")])
_SENT = ["home", "key", "first", "bytes", "members", "crowded"]
_SENT_KINDS = [pa.int64()] * 3 + [pa.binary(), pa.list_(_MEMBER), pa.bool_()]
_SENT_SCHEMA = (
    "home long, key long, first long, bytes binary, members array<struct<at: long, g: long, c: long, n: long>>, "
    "crowded boolean"
)


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a document for its anchors' homes; for crowded homes, contexts in halves."""
    last, done = None, set()
    for whole in batches:
        for batch in parts(whole):
            rows = []
            for key, raw, wanted in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key != last:  # equal rows stand together
                    last, done = key, set()
                data, found = unpacked(raw), []
                for w in wanted:
                    a, b, c = context(data, w["at"]) if w["at"] + GRAM <= len(data) else (0, 0, None)
                    if c == w["c"] and (w["g"], c) not in done:
                        done.add((w["g"], c))
                        member = {k: w[k] for k in ("at", "g", "c", "n")}
                        if w["crowded"]:
                            rows += [(k, key, x, y, [member], True) for k, x, y in pieces_of(data[a:b], a, member, HALF)]
                        else:
                            found.append((w["home"], a, b, member))
                found.sort(key=lambda x: x[:3])
                start = None
                for home, a, b, member in found:
                    if start is not None and start[0] == home and a <= start[2]:
                        start[2] = b
                        start[3].append(member)
                        continue
                    if start is not None:
                        rows.append((start[0], key, start[1], data[start[1]:start[2]], start[3], False))
                    start = [home, a, b, [member]]
                if start is not None:
                    rows.append((start[0], key, start[1], data[start[1]:start[2]], start[3], False))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _SENT_KINDS)], _SENT)


def pieces_of(raw: bytes, first: int, member: dict, width: int) -> Iterator[tuple[int, int, bytes]]:
    """The strings of DEPTH bytes in a part of a context, `width` places a piece: key, place, bytes.

    Places are counted from the anchor, so equal strings fall into like pieces, cut off by a
    text's edge or not. The key is the hash of what all strings of a whole piece would share.
    """
    base = member["at"] - STARTS + 1 - first
    n = len(raw) - DEPTH + 1
    for k in range((0 - base) // width, (n - 1 - base) // width + 1):
        low, high = base + k * width, min(base + (k + 1) * width, base + STARTS) - 1
        a, b = max(low, 0), min(high, n - 1)
        key = xxhash.xxh3_64_intdigest(raw[high:low + DEPTH], seed=(member["g"] + k) & (1 << 64) - 1)
        yield _signed(key), first + a, raw[a:b + DEPTH]


def _halve(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in parts(whole, 4096):
            rows = [
                (k, key, place, piece, members, True)
                for _, key, first, raw, members in zip(*(batch.column(k).to_pylist() for k in range(5)))
                for k, place, piece in pieces_of(raw, first, members[0], width)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _SENT_KINDS)], _SENT)


def _thinned(pieces: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pieces of crowded homes by what remains to do: repeats found because whole pieces are equal,
    pieces for sorting, and pieces of groups that are still crowded."""
    pieces = pieces.withColumn("same", F.xxhash64("bytes")).withColumn("m", F.col("members")[0])
    place = F.struct("key", "first")  # a text that repeats itself can give one place twice
    times = F.when(F.min(place) != F.max(place), 2).otherwise(F.max("m.n")).cast("long").alias("n")
    folded = pieces.groupBy("home", "same", "bytes").agg(times, F.min(F.struct("key", "first", "m")).alias("p"))
    folded = written(folded, "pieces")
    equal = pieces.join(folded.where("n > 1").select("home", "same"), ["home", "same"], "left_semi")
    found = equal.select(
        "m.g", "m.c", F.array(F.col("first") - F.col("m.at")).alias("lo"),
        F.array(F.col("first") + F.length("bytes") - F.col("m.at")).alias("hi"),
    )
    member = F.struct(F.col("p.m.at").alias("at"), F.col("p.m.g").alias("g"), F.col("p.m.c").alias("c"), "n")
    rows = folded.select("home", "p.key", "p.first", "bytes", F.array(member).alias("members"))
    groups = folded.groupBy("home").agg(F.count("*").alias("kinds")).where("kinds > 1")
    rows = rows.join(groups, "home")
    few = F.col("kinds") <= HOME_CONTEXTS
    return found, rows.where(few).drop("kinds"), rows.where(~few).drop("kinds")


def _sort_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats in the contexts of whole homes, as (g, c, spans relative to the anchor)."""
    held, size, home = [], 0, None

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        key, first = (rows.column(x).to_numpy() for x in ("key", "first"))
        strings = rows.column("bytes").to_pylist()
        starts, begins = repeated_starts(strings, key, first)
        of = np.repeat(np.arange(len(strings)), pa.compute.list_value_length(rows.column("members")).to_numpy())
        at, g, c, n = (x.to_numpy() for x in rows.column("members").combine_chunks().flatten().flatten())
        # The strings of a context begin within fewer than DEPTH bytes, so what they cover is one span.
        base, at = begins[of], at - first[of]
        a = base + np.maximum(at - STARTS + 1, 0)
        b = base + np.minimum(at, np.diff(begins, append=begins[-1] + len(strings[-1]) + 1)[of] - 1 - DEPTH) + 1
        low, high = np.searchsorted(starts, a), np.searchsorted(starts, b)
        # Contexts that occur more than once are known to be repeated as a whole.
        some = np.flatnonzero((low < high) & (n < 2))
        low, high, zero = low[some], high[some], (base + at)[some]
        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32))
        spans = [pa.ListArray.from_arrays(ends, pa.array(x - zero)) for x in (starts[low], starts[high - 1] + DEPTH)]
        return pa.RecordBatch.from_arrays([pa.array(g[some]), pa.array(c[some]), *spans], ["g", "c", "lo", "hi"])

    for batch in batches:
        if not batch.num_rows:
            continue
        homes = batch.column(0).to_numpy()
        upto = np.cumsum(pa.compute.binary_length(batch.column(3)).to_numpy(), dtype=np.int64).tolist()
        opens = np.flatnonzero(np.diff(homes)) + 1
        begin, cut = 0, 0
        for k in opens.tolist() if homes[0] == home else [0, *opens.tolist()]:
            before = upto[k - 1] if k else 0
            if size + before - cut >= BATCH_BYTES:
                if k:
                    held.append(batch.slice(begin, k - begin))
                yield close()
                held, size, begin, cut = [], 0, k, before
        held.append(batch.slice(begin))
        size += upto[-1] - cut
        home = homes[-1]
    if held:
        yield close()


_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split(" ")[0] for x in _CUT.split(",")]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    for whole in batches:
        for batch in parts(whole):
            rows = []
            for doc_id, packed, marks in zip(*(batch.column(k).to_pylist() for k in range(3))):
                data, kept, spans = unpacked(packed), [], []
                for m in marks or ():
                    spans += [(max(0, p + x), min(len(data), p + y)) for p in m["ats"] for x, y in zip(m["lo"], m["hi"])]
                spans.sort()
                merged: list[list[int]] = []
                for a, b in spans:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edge = 0
                for a, b in merged:
                    kept.append(data[edge:a])
                    edge = b
                kept.append(data[edge:])
                rest = b"".join(kept)
                rows.append((doc_id, len(data), len(data) - len(rest), len(merged), rest))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    texts = docs.select("key", "text", F.coalesce("doc_id", "key").alias("doc"))
    twice = written(
        texts.mapInArrow(_anchor_counts, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1").select("g"),
        "anchors",
    )
    schema = "g long, c long, doc long, key long, ats array<long>, before long, after long"
    places = written(texts.mapInArrow(_contexts, schema).join(twice, "g"), "places")
    # Equal contexts have equal sides.
    contexts = places.groupBy("g", "c", "before", "after").agg(
        F.sum(F.size("ats")).alias("n"), F.min(F.struct("doc", "key", F.col("ats")[0].alias("at"))).alias("p")
    )
    contexts = written(contexts.select("g", "c", "before", "after", "n", "p.*"), "contexts")
    reached = contexts.select("g", "c", F.explode(F.array("before", "after")).alias("side")).where("side is not null")
    shared = reached.groupBy("side").agg(F.count("*").alias("kinds")).where("kinds > 1").select("side")
    live = reached.join(shared, "side").select("g", "c").distinct()
    folded = contexts.select("g", "c", "n", "doc", "key", "at").join(live, ["g", "c"])
    homes = folded.groupBy("g").agg(F.min("doc").alias("home"))
    folded = written(folded.drop("doc").join(homes, "g"), "folded")
    crowds = folded.groupBy("home").count().where(F.col("count") > HOME_CONTEXTS).select("home", F.lit(True).alias("crowded"))
    wanted = folded.join(crowds, "home", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))).groupBy("key").agg(
        F.collect_list(F.struct("at", "g", "c", "n", "home", "crowded")).alias("wanted")
    )
    moved = packed(docs, "key")
    sent = written(moved.join(wanted, "key").select("key", "data", "wanted").mapInArrow(_send, _SENT_SCHEMA), "stretches")
    stretches, repeats = sent.where(~F.col("crowded")).drop("crowded"), []
    crowded, width = sent.where("crowded").drop("crowded"), HALF
    result = "g long, c long, lo array<long>, hi array<long>"
    while width and crowded.limit(1).count():
        width //= 2
        found, few, many = _thinned(crowded)
        repeats.append(written(found, "repeats"))
        stretches = stretches.unionByName(few)
        halve = partial(_halve, width=max(width, 1))
        crowded = written(many.mapInArrow(halve, _SENT_SCHEMA), "pieces").drop("crowded")
    sorted_ = stretches.repartition("home").sortWithinPartitions("home", "key", "first").mapInArrow(_sort_homes, result)
    whole = contexts.where("n > 1").select(
        "g", "c", F.array(F.lit(1 - STARTS).cast("long")).alias("lo"), F.array(F.lit(DEPTH).cast("long")).alias("hi")
    )
    marks = places.join(reduce(DataFrame.unionByName, [whole, *repeats], sorted_), ["g", "c"]).groupBy("key").agg(
        F.collect_set(F.struct("ats", "lo", "hi")).alias("marks")
    )
    return moved.join(marks, "key", "left").select("doc_id", "data", "marks").mapInArrow(_cut, _CUT)


def op6_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that begin anywhere else too."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
