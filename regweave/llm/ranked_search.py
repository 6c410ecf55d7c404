"""Ranked lexical search (method: pipelined term partitioning).

Terms belong to owners, by hash. An index block holds some documents, and for each owner the
postings of its terms in them. A bundle is a group of items on its way past the owners, with
sparse accumulators of the documents of a block: the owners are successive stages, at each
of which a cogroup brings a block's bundle and the owner's postings of that block together.
The owner adds w * impact, whole numbers all, to the accumulators of the items that ask for
its terms and sends the bundle on; behind the last one a block's best documents of each item
are selected, and the best of those come out of all blocks.

- A frequent term is spread over the blocks, so no list stands whole in one task. Blocks hold
  BLOCK documents at most and items come in groups of about GROUP, so what a stage holds is
  bounded: GROUP * BLOCK numbers. Blocks grow in number with the documents, groups with the
  items. Every item meets every block once, as a stated query set does.
- An accumulator that could not reach its block's best any more, whatever the owners to come
  add (they know what they can add at most), is left out of the bundle. Ties stay.
- Only terms that an item may ask for are indexed: those whose hash is marked in a bit map of
  fixed size, MARKS bits, whatever the number of items. N and L count all terms of all texts.

Defined results: a null or empty text has no terms and is not found, an item without terms
finds nothing; each row is a document of its own, and of the items, also where ids are equal
or null; equal scores come by ascending doc_id, null ids last, then by the rows' blocks;
very long texts are cut into words whole, one text at a time; an empty table of items or
documents gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, table, texts_of, written

#: Fixed value: a term is a run of ASCII letters and digits and of all that is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stages that a bundle passes; documents of a block; items of a group, about; bits that mark terms.
OWNERS, BLOCK, GROUP, MARKS = 4, 2_048, 200, 1 << 20
#: Fixed values of the score, in hundredths and billionths.
LENGTH_SHARE, SCALE, SATURATION = 50, 1_000_000_000, 20
#: More than any impact: tf has no bound, SCALE * tf div (1000 * tf + 20 * m) has.
MOST_IMPACT = SCALE // 1000

_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased."""
    return text.encode().translate(_BYTES).split()


def asked_terms(items: DataFrame) -> DataFrame:
    """item (a number for the row), item_id, term: what each row of items asks for, once each."""
    lower = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    numbered = written(
        items.select("item_id", lower.alias("text")).withColumn("item", F.monotonically_increasing_id()), "items"
    )
    terms = F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
    return numbered.select("item", "item_id", F.explode(terms).alias("term"))


def _marks(asked: DataFrame) -> bytes:
    """A bit for each of MARKS hashes, set where a term asked for has it; at most MARKS rows come here."""
    hashes = asked.select((F.crc32(F.encode("term", "UTF-8")) % MARKS).alias("h")).distinct().collect()
    marks = np.zeros(MARKS, dtype=bool)
    marks[[r["h"] for r in hashes]] = True
    return np.packbits(marks).tobytes()


_INDEX = (
    "block long, owner int, ids array<long>, n array<long>, terms array<string>, ends array<int>, "
    "docs array<int>, tf array<int>"
)
_INDEX_TYPES = [
    pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()),
    pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()),
]
_INDEX_NAMES = [x.split()[0] for x in _INDEX.split(", ")]


def index(docs: DataFrame, marks: bytes, owners: int, size: int) -> DataFrame:
    """Blocks of documents: a row for each owner, with the postings of its terms."""

    def block(number: int, ids: list, lengths: list, lists: list[dict]) -> pa.RecordBatch:
        rows = []
        for owner, postings in enumerate(lists):
            ends = np.cumsum([len(p) for p in postings.values()]).tolist()
            flat = [x for p in postings.values() for x in p]
            rows.append((
                number, owner, ids, lengths, [t.decode() for t in postings], ends,
                [d for d, _ in flat], [tf for _, tf in flat],
            ))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _INDEX_TYPES)], _INDEX_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(marks, np.uint8)).astype(bool)
        number = TaskContext.get().partitionId() << 32
        ids, lengths, lists = [], [], [{} for _ in range(owners)]
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), texts_of(part)):
                    found = terms_of(text)
                    if not found:
                        continue
                    for term, tf in Counter(found).items():
                        h = zlib.crc32(term)
                        if wanted[h % MARKS]:
                            lists[h // MARKS % owners].setdefault(term, []).append((len(ids), tf))
                    ids.append(doc_id)
                    lengths.append(len(found))
                    if len(ids) == size:
                        yield block(number, ids, lengths, lists)
                        number, ids, lengths, lists = number + 1, [], [], [{} for _ in range(owners)]
        if ids:
            yield block(number, ids, lengths, lists)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _INDEX)


_BUNDLE = "grp int, block long, item array<long>, doc array<int>, score array<long>"
_BUNDLE_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
_FOUND = "item long, block long, doc int, doc_id long, score long"
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    """The top-th largest score of each row, at least 1."""
    if scores.shape[1] <= top:
        return np.ones(len(scores), dtype=np.int64)
    return np.maximum(np.partition(scores, -top, axis=1)[:, -top], 1)


def _stage(total_docs: int, total_terms: int, top: int, last: bool):
    """What an owner does with a bundle: cogroup function of (bundle, its postings of the block)."""

    def add(bundle: pa.Table, owned: pa.Table) -> pa.Table:
        if not owned.num_rows:  # every block has a row for every owner and group
            return pa.Table.from_arrays([pa.array([], k) for k in (_FOUND_TYPES if last else _BUNDLE_TYPES)],
                                        [x.split()[0] for x in (_FOUND if last else _BUNDLE).split(", ")])
        own = {name: owned.column(name)[0] for name in owned.column_names}
        items = np.array(own["items"].as_py(), dtype=np.int64)
        later = np.array(own["later"].as_py(), dtype=np.int64)
        lengths = own["n"].values.to_numpy()
        scores = np.zeros((len(items), len(lengths)), dtype=np.int64)
        if bundle.num_rows:
            at = np.searchsorted(items, bundle.column("item")[0].values.to_numpy())
            scores[at, bundle.column("doc")[0].values.to_numpy()] = bundle.column("score")[0].values.to_numpy()
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * total_docs) // total_terms
        ends = own["ends"].values.to_numpy()
        docs, tf = own["docs"].values.to_numpy(), own["tf"].values.to_numpy().astype(np.int64)
        impact = (SCALE * tf) // (1000 * tf + SATURATION * m[docs])
        place = {t: k for k, t in enumerate(own["terms"].as_py())}
        for asked in own["asked"].as_py() or ():
            k = place.get(asked["term"])
            if k is not None:
                a, b = (ends[k - 1] if k else 0), ends[k]
                rows = np.searchsorted(items, np.array(asked["items"], dtype=np.int64))
                scores[np.ix_(rows, docs[a:b])] += asked["w"] * impact[a:b]
        least = _best(scores, top)
        grp, block = own["grp"].as_py(), own["block"].as_py()
        if not last:
            row, doc = np.nonzero((scores > 0) & (scores + later[:, None] >= least[:, None]))
            columns = [[grp], [block], [items[row]], [doc.astype(np.int32)], [scores[row, doc]]]
            return pa.Table.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _BUNDLE_TYPES)], [x.split()[0] for x in _BUNDLE.split(", ")]
            )
        row, doc = np.nonzero(scores >= least[:, None])
        ids = own["ids"].values
        columns = [
            pa.array(items[row]), pa.array(np.full(len(row), block)), pa.array(doc.astype(np.int32)),
            ids.take(pa.array(doc)), pa.array(scores[row, doc]),
        ]
        return pa.Table.from_arrays(columns, [x.split()[0] for x in _FOUND.split(", ")])

    return add


def search(
    items: DataFrame, docs: DataFrame, *, top: int = 50, owners: int = OWNERS, block: int = BLOCK, group: int = GROUP
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's `top` best documents, and the item's number."""
    asked = asked_terms(items)
    blocks = written(index(docs, _marks(asked), owners, block), "index")
    # N and L, and the number of items: three numbers.
    size = blocks.where("owner = 0").agg(
        F.sum(F.size("n")).alias("docs"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")
    ).first()
    counted = asked.agg(F.count_distinct("item").alias("n")).first()
    total_docs, total_terms = size["docs"] or 0, size["terms"] or 1
    groups = max(1, -(-counted["n"] // group))

    lists = blocks.select("owner", F.posexplode("terms").alias("k", "term"), "ends")
    df = F.sum(F.col("ends")[F.col("k")] - F.when(F.col("k") > 0, F.col("ends")[F.col("k") - 1]).otherwise(0))
    held = lists.groupBy("term", "owner").agg(df.alias("df"))
    w = F.floor(1000 * F.log((2 * F.lit(total_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = written(
        asked.join(held, "term").select(
            "item", "owner", "term", w.alias("w"), F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("grp")
        ), "weights",
    )
    asks = weighed.groupBy("grp", "owner", "term", "w").agg(F.collect_list("item").alias("items"))
    asks = asks.groupBy("grp", "owner").agg(F.collect_list(F.struct("term", "w", "items")).alias("asked"))
    # For each owner: the items of a group, and what the owners after it can add to each at most.
    each = [
        F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("w"))), F.lit(0)) * MOST_IMPACT for k in range(owners)
    ]
    ahead = weighed.groupBy("grp", "item").agg(F.array(*each).alias("ahead"))
    ahead = ahead.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("item", "ahead"))).alias("rows"))
    ahead = ahead.select("grp", F.explode(F.sequence(F.lit(0), F.lit(owners - 1))).alias("owner"), "rows")
    ahead = ahead.select(
        "grp", "owner", F.col("rows.item").alias("items"), F.transform("rows", lambda r: r["ahead"][F.col("owner")]).alias("later")
    )
    teams = written(ahead.join(asks, ["grp", "owner"], "left"), "teams")

    bundles = docs.sparkSession.createDataFrame([], _BUNDLE)
    for k in range(owners):
        # A block's postings go to each group of items, which are hundreds of items each.
        owned = blocks.where(F.col("owner") == k).join(teams.where(F.col("owner") == k), "owner").drop("owner")
        last = k == owners - 1
        step = _stage(total_docs, total_terms, top, last)
        bundles = bundles.groupBy("grp", "block").cogroup(owned.groupBy("grp", "block")).applyInArrow(
            step, _FOUND if last else _BUNDLE
        )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "block", "doc")
    ranked = bundles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    names = asked.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score", "item")


def op13_rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    found = search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
    return found.select("item_id", "rank", "doc_id", "score")


SQL = f"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id,
           unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM documents),
counts AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM counts GROUP BY r),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
held AS (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM held, whole),
items AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
asked AS (
    SELECT DISTINCT q, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM items),
scores AS (
    SELECT q, item_id, r, doc_id,
           sum(w * (({SCALE} * tf) // (1000 * tf + {SATURATION} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (r), whole
    GROUP BY q, item_id, r, doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
