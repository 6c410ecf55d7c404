"""Removal of passages that occur more than once (method: seed and extend).

A passage of WINDOW words is repeated if it begins at two places, in one text or in two.

- Seeds are winnowed anchors: each passage of WINDOW words chooses the run of GRAM words in it
  whose hash is least, the first of them. Equal passages choose the same one, so each repeat
  holds a shared anchor, and only anchors that occur twice in the corpus are looked at. They
  are joined by their hash.
- A match is extended both ways as far as the passages that chose the anchor reach, the
  anchor's context. Places whose contexts are equal match over all of it: they are counted,
  and nothing more is asked of them, however many they are.
- Other places of an anchor match over a part of it: so many words to the left and the rest of
  a passage's words to the right. Each different context goes once to its anchor, with what it
  reads for every such split, and splits that two contexts read alike are matches. The work
  is the number of different contexts times the passages in one, never pairs of places. An
  anchor with more than CROWD different contexts is divided by split before they travel.
- Overlapping matches of a text, of one anchor or several, make its maximal repeats: the
  runs of words that go.

A text goes by a key, a hash of its id and itself. Texts travel compressed. Hashes are of 64
bits, those of contexts and splits beside that of their anchor.

Defined results: a null text has no words; texts with fewer than WINDOW words keep all, joined
by single spaces; rows equal in id and text, or in text alone, are repeats of each other; null
ids are rows like others; very long texts are worked on whole, one at a time; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, packed, parts, slices, slide, table, texts_of, unpacked, written

#: Words of a passage; words of an anchor.
WINDOW, GRAM = 35, 8
#: Different contexts of an anchor that meet in one place.
CROWD = 10_000
#: Words whose hashes a task remembers.
KNOWN_WORDS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 32) - 1)


class _Hashes(dict):
    """The hash of each word, worked out once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class _Powers:
    """Powers of the base and of its inverse, as far as any text needed them."""

    forth = back = np.zeros(0, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.forth) < n:
            size = max(n, 1 << 18)
            cls.forth = np.multiply.accumulate(np.full(size, _BASE, dtype=np.uint64))
            cls.back = np.multiply.accumulate(np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64))
        return cls.forth, cls.back


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return (x ^ (x >> np.uint64(29))) * np.uint64(_BASE)


class Words:
    """Some texts as one run of word hashes, with hashes of any of its stretches."""

    def __init__(self, texts: list[bytes], known: _Hashes):
        if len(known) > KNOWN_WORDS:
            known.clear()
        lists = [t.split() for t in texts]  # bytes split at the ASCII spaces only
        self.sizes = np.array([len(x) for x in lists], dtype=np.int64)
        self.size = int(self.sizes.sum())
        self.ends = np.cumsum(self.sizes)
        own = np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), dtype=np.uint64, count=self.size)
        forth, self.back = _Powers.upto(self.size + 1)
        with np.errstate(over="ignore"):
            own *= forth[: self.size]
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)])

    def hashes(self, a: np.ndarray, b: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        """Hashes of the words from a to b, for arrays of both."""
        with np.errstate(over="ignore"):
            return _mixed((self.sums[b] - self.sums[a]) * self.back[a] + np.asarray(salt, dtype=np.uint64) * _ODD)

    def anchors(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors by the texts' order: hash, context, where its first passage begins and how many
        passages chose it."""
        none = np.zeros(0, dtype=np.int64)
        if self.size < window:
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        at = np.arange(self.size - gram + 1)
        grams = self.hashes(at, at + gram)
        # The upper half of a hash is its rank, the place below it makes the first the least.
        chosen = slide((grams & ~_LOW) | at.astype(np.uint64), window - gram + 1, np.minimum) & _LOW
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        within = np.flatnonzero(text[: self.size - window + 1] == text[window - 1:])
        if not len(within):
            return none.astype(np.uint64), none.astype(np.uint64), none, none
        chosen = chosen[within].astype(np.int64)
        opens = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        place, first = chosen[opens], within[opens]
        number = np.diff(np.concatenate([opens, [len(chosen)]]))
        return grams[place], self.hashes(first, first + number - 1 + window, place - first), first, number


def _seen(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Anchors that occur twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for part in slices(batch):
                found = Words([t.encode() for t in texts_of(part)], known).anchors(window, gram)[0]
                kinds, times = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], ["a", "n"])

    counted = docs.mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    return written(counted.where("n > 1").select("a"), "anchors")


def _places(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Every place of an anchor: a, c (its context), key, lo (word of the first passage) and m (passages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for part in slices(batch):
                words = Words([t.encode() for t in texts_of(part)], known)
                a, c, first, number = words.anchors(window, gram)
                text = np.searchsorted(words.ends, first, side="right")
                lo = first - (words.ends - words.sizes)[text]
                columns = [
                    pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), part.column(0).take(pa.array(text)),
                    pa.array(lo.astype(np.int32)), pa.array(number.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["a", "c", "key", "lo", "m"])

    return docs.mapInArrow(run, "a long, c long, key long, lo int, m int")


_SPLITS = "a long, sub long, key long, open boolean, lo int, h array<long>"
_SPLIT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.list_(pa.int64())]


def _splits(texts: DataFrame, window: int) -> DataFrame:
    """What the contexts wanted of texts (key, data, wanted) read for each of their passages; a
    context of a crowded anchor a row for each, with `sub` to tell them apart."""
    names = [x.split()[0] for x in _SPLITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for whole in batches:
            for batch in parts(whole, 64):
                rows = []
                for key, data, wanted in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words = Words([unpacked(data)], known)
                    for w in wanted:
                        starts = np.arange(w["lo"], w["lo"] + w["m"])
                        h = words.hashes(starts, starts + window).view(np.int64)
                        if w["crowded"]:
                            rows += [(w["a"], x or 1, key, w["open"], s, [x]) for s, x in zip(starts.tolist(), h.tolist())]
                        else:
                            rows.append((w["a"], 0, key, w["open"], w["lo"], h))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _SPLIT_TYPES)], names)

    return texts.mapInArrow(run, _SPLITS)


def _matched(splits: DataFrame, window: int) -> DataFrame:
    """Spans (key, lo, hi) of open contexts that another context of their anchor reads too."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        sizes = np.diff(rows["h"].combine_chunks().offsets.to_numpy())
        h = rows["h"].combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(rows.num_rows), sizes)
        a = rows["a"].to_numpy()[row]
        start = rows["lo"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        by = np.lexsort((h, a))
        equal = (a[by][1:] == a[by][:-1]) & (h[by][1:] == h[by][:-1])
        twice = np.zeros(len(by), dtype=bool)
        twice[by[1:][equal]] = twice[by[:-1][equal]] = True
        twice &= rows["open"].to_numpy(zero_copy_only=False)[row]
        at = np.flatnonzero(twice)
        new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(row[at]) > 0)]) if len(at) else np.zeros(0, dtype=bool)
        first, last = at[new], at[np.concatenate([new[1:], [True]])] if len(at) else at
        columns = [rows["key"].to_numpy()[row[first]], start[first].astype(np.int32), (start[last] + window).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held else rows
            if not rows.num_rows:
                continue
            a, sub = rows["a"].to_numpy(), rows["sub"].to_numpy()
            edge = int(np.flatnonzero((a == a[-1]) & (sub == sub[-1]))[0])
            if sub[-1]:  # one split: two of its rows stand for all that came
                yield spans(rows)
                held = rows.slice(edge, 2).combine_chunks()
            else:
                if edge:
                    yield spans(rows.slice(0, edge).combine_chunks())
                held = rows.slice(edge).combine_chunks()
        if held:
            yield spans(held)

    dealt = splits.repartition("a", "sub").sortWithinPartitions("a", "sub")
    return dealt.mapInArrow(run, "key long, lo int, hi int")


_KEPT = "doc_id long, n_words long, n_removed long, n_spans long, kept string"


def _cut(texts: DataFrame) -> DataFrame:
    """Texts (doc_id, data, spans in words) without their spans."""
    names = [x.split()[0] for x in _KEPT.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole):
                rows = []
                for doc_id, data, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words, kept, edge, runs = unpacked(data).split(), [], 0, 0
                    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                        if lo > edge or not runs:
                            kept += words[edge:lo]
                            runs += 1
                        edge = max(edge, hi)
                    kept += words[edge:]
                    rows.append((doc_id, len(words), len(words) - len(kept), runs, b" ".join(kept).decode()))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return texts.mapInArrow(run, _KEPT)


def remove_passages(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans and the kept words of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    keyed = docs.select("key", "text")
    places = written(_places(keyed, window, gram).join(_seen(keyed, window, gram), "a"), "places")
    # Of equal contexts any place stands for all; key and lo come from one row.
    contexts = places.groupBy("a", "c").agg(
        F.count("*").alias("n"), F.first("key").alias("key"), F.first("lo").alias("lo"), F.first("m").alias("m")
    )
    contexts = written(contexts, "contexts")
    kinds = contexts.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = contexts.join(kinds, "a").groupBy("key").agg(F.collect_list(F.struct(
        "a", "lo", "m", (F.col("n") == 1).alias("open"), (F.col("kinds") > CROWD).alias("crowded")
    )).alias("wanted"))
    moved = packed(docs, "key")
    partly = _matched(_splits(moved.join(wanted, "key").select("key", "data", "wanted"), window), window)
    wholly = places.join(contexts.where("n > 1").select("a", "c"), ["a", "c"]).select(
        "key", "lo", (F.col("lo") + F.col("m") + (window - 1)).alias("hi")
    )
    spans = wholly.unionByName(partly).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return _cut(moved.join(spans, "key", "left").select("doc_id", "data", "spans"))


def op12_remove_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words that begin anywhere else too."""
    return remove_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_spans"
    )


SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS list FROM documents),
words AS (SELECT r, unnest(list) AS w, generate_subscripts(list, 1) AS i FROM texts),
passages AS (
    SELECT r, i, count(*) OVER p AS n, md5(string_agg(w, ' ') OVER p) AS h FROM words
    WINDOW p AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
twice AS (SELECT h FROM passages WHERE n = {WINDOW} GROUP BY h HAVING count(*) > 1),
starts AS (SELECT r, i FROM passages JOIN twice USING (h) WHERE n = {WINDOW}),
gone AS (
    SELECT w.r, w.i, w.w, max(s.i) OVER (PARTITION BY w.r ORDER BY w.i) > w.i - {WINDOW} AS cut
    FROM words w LEFT JOIN starts s ON s.r = w.r AND s.i = w.i),
runs AS (SELECT *, coalesce(cut, false) AND NOT coalesce(lag(cut) OVER (PARTITION BY r ORDER BY i), false) AS opens FROM gone),
kept AS (
    SELECT r, count(*) AS n_words, count(*) FILTER (cut) AS n_removed, count(*) FILTER (opens) AS n_spans,
           string_agg(w, ' ' ORDER BY i) FILTER (NOT coalesce(cut, false)) AS kept
    FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM texts LEFT JOIN kept USING (r)
"""
