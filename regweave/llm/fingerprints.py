"""Bottom-k sketches of word shingles: mergeable document fingerprints.

A document's shingles are its runs of five words (fewer words: all of them as one; no
words: none). Every shingle gets a 40-bit hash; the fingerprint is the K smallest
distinct ones, ascending. The K smallest of two fingerprints together are those of the
union of the documents, whence sketches of parts merge and

- resemblance is the share of them that both fingerprints hold,
- the K-th smallest hash tells how many distinct shingles there are,
- containment follows from resemblance and the two counts.

Up to K shingles everything is exact. All of it is DataFrame expressions.

Each document meets the next one (ascending id) within ranges of ids: quantiles of the
ids cut the table into ranges, and the first row of each range is copied to the end of
the range before, so a lead over each range is a lead over the table and the texts are
shuffled once.

Defined results: a null text is empty; two documents without words resemble each other
fully, one without words and one with some not at all; rows with a null id come last,
by their texts' hashes; equal ids go by the same; a table of one row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, words

#: Hashes of a fingerprint, words of a shingle, bits of a hash.
K, SHINGLE, BITS = 256, 5, 40
#: Rows of a range of ids, and the most ranges the driver holds the bounds of.
RANGE_ROWS, MOST_RANGES = 500, 100_000


def shingle_hashes(found: Column) -> Column:
    """Hashes of the shingles of an array of words.

    The array should be a column of its own: it is read once for every shingle.
    """
    n = F.size(found)

    def one(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*(F.get(found, i + k) for k in range(SHINGLE))), 64 - BITS)

    return F.when(n == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))), one)
    )


def bottom(hashes: Column) -> Column:
    """The K smallest distinct hashes, ascending."""
    return F.slice(F.array_distinct(F.sort_array(hashes)), 1, K)


def with_fingerprints(df: DataFrame, **texts: str) -> DataFrame:
    """df with a fingerprint column for each `name=text column`."""
    kept = df.columns
    df = df.select("*", *(words(F.col(t)).alias(f"_w_{name}") for name, t in texts.items()))
    df = df.select(*kept, *(shingle_hashes(F.col(f"_w_{name}")).alias(f"_h_{name}") for name in texts))
    return df.select(*kept, *(bottom(F.col(f"_h_{name}")).alias(name) for name in texts))


def merge(a: Column, b: Column) -> Column:
    """The fingerprint of two parts together."""
    return bottom(F.concat(a, b))


def merge_rows(df: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """One fingerprint a key. Each step folds up to 64 of a key, so a hot key spreads over tasks."""
    df = df.select(key, F.col(fingerprint).alias("f"), F.monotonically_increasing_id().alias("_part"))
    n = df.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    while n > 1:
        df = df.groupBy(key, F.floor(F.col("_part") / 64).alias("_part")).agg(bottom(F.flatten(F.collect_list("f"))).alias("f"))
        df = df.withColumn("_part", F.row_number().over(Window.partitionBy(key).orderBy("_part")) - 1)
        n = -(-n // 64) if n > 64 else 1
    return df.groupBy(key).agg(bottom(F.flatten(F.collect_list("f"))).alias(fingerprint))


def distinct_shingles(a: Column) -> Column:
    """Estimated number of distinct shingles; exact below K."""
    return F.when(F.size(a) < K, F.size(a).cast("double")).otherwise(
        F.lit(float((K - 1) * 2**BITS)) / F.greatest(F.get(a, F.lit(K - 1)), F.lit(1))
    )


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both."""
    union = merge(a, b)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too."""
    r = resemblance(a, b)
    common = r * (distinct_shingles(a) + distinct_shingles(b)) / (1 + r)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a)))


def as_text(a: Column) -> Column:
    """Ten hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def _ranges(docs: DataFrame) -> tuple[list[int], int | None]:
    """Ids that open ranges of about RANGE_ROWS rows (but the first range), and the least id."""
    n = docs.agg(F.count("doc_id")).first()[0]
    parts = min(-(-n // RANGE_ROWS), MOST_RANGES)
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts, least = docs.agg(
        F.percentile_approx("doc_id", shares, max(10_000, 10 * parts)), F.min("doc_id")
    ).first()
    if parts <= 1:
        return [], least
    return sorted(c for c in set(cuts) if c > least), least


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts are at or below the id, and the last of them; looked up in two steps."""
    if not cuts:
        return F.struct(F.lit(0).alias("at"), F.lit(None).cast("long").alias("cut"))
    side = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k:k + side] for k in range(0, len(cuts), side)]
    tops = F.array(*(F.lit(g[0]).cast("long") for g in groups))
    inner = F.array(*(F.array(*(F.lit(c).cast("long") for c in g)) for g in groups))
    at = F.size(F.filter(tops, lambda c: c <= doc_id))
    own = F.filter(F.get(inner, at - 1), lambda c: c <= doc_id)
    none = F.lit(None).cast("long")
    return F.when(doc_id.isNull(), F.struct(F.lit(len(cuts)).alias("at"), none.alias("cut"))).when(
        at == 0, F.struct(F.lit(0).alias("at"), none.alias("cut"))
    ).otherwise(F.struct(((at - 1) * side + F.size(own)).alias("at"), F.element_at(own, -1).alias("cut")))


def beside_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with range, order and whether a row is a copy from the range after."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts, least = _ranges(docs)
    opens = F.col("_cut") == F.col("doc_id")

    def place(part: Column, late: bool, copy: bool) -> Column:
        return F.struct(part.cast("int").alias("range"), F.lit(late).alias("late"), F.lit(copy).alias("copy"))

    places = F.array(
        place(F.col("_at"), False, False),
        F.when(opens, place(F.col("_at") - 1, False, True)),
        F.when(F.col("doc_id") == F.lit(least).cast("long"), place(F.lit(len(cuts)), True, True)),
    )
    return docs.withColumn("_range", _range_of(F.col("doc_id"), cuts)).select(
        "doc_id", "text", F.col("_range.at").alias("_at"), F.col("_range.cut").alias("_cut")
    ).withColumn(
        "_p", F.explode(F.filter(places, lambda p: p.isNotNull()))
    ).select("doc_id", "text", F.xxhash64("text").alias("tie"), "_p.*")


def op5_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = beside_next(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("range").orderBy("late", F.col("doc_id").asc_nulls_last(), "tie")
    n = F.length("text")
    rows = rows.withColumn("_next", F.coalesce(F.lead("text").over(order), F.lit("")))
    rows = rows.withColumns({"n_chars": n.cast("long"), "_cut": F.floor(n / 4).cast("int")}).withColumn(
        "_edited", F.concat(F.expr("substring(text, 1, length(text) - _cut)"), F.expr("substring(_next, 1, _cut)"))
    )
    keys = ["doc_id", "tie", "range", "late", "copy", "n_chars"]
    rows = rows.select(*keys, "text", "_edited", F.sha2("_edited", 256).alias("edited_sha256"))
    rows = with_fingerprints(rows, f="text", e="_edited").drop("text", "_edited")
    rows = rows.withColumn("_next", F.lead("f").over(order)).where(~F.col("copy"))
    nearest = F.when(F.col("_next").isNull(), 0.0).otherwise(resemblance(F.col("f"), F.col("_next")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"), resemblance(F.col("f"), F.col("e")).alias("near_edited"),
        nearest.alias("near_next"), distinct_shingles(F.col("f")).alias("distinct_shingles"),
    )
