"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at counts of one text and votes good, votes bad or abstains. Two
hidden classes explain the votes; expectation-maximisation over all documents
estimates for each rule how often it votes which way in either class, and the
posterior probability of the good class is the document's quality. A rule that agrees
with the others thus counts more than one that fires at random, and one failed rule
need not sink a document.

The votes of all documents fold into counts of vote patterns, of which there are at
most 3 ** len(RULES), so EM runs on a table of a fixed size and costs one aggregation
whatever the input. Bad votes never speak for quality, and what no rule objects to
is kept: rates that would say otherwise are pooled over the classes.

Defined results: a null or empty text has no words, every count is 0 and it fails the
base rules; repeated rows and null ids are judged row by row; an empty table gives no
rows; the verdict of a row depends on its text and the corpus's vote patterns alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, WORD, table, written

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
    "n_marked",
)
_WORD, _SYMBOLS = re.compile(WORD), "#*$%&|<>"
#: A pattern is rejected below this probability of quality.
LEAST_QUALITY = 0.5


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


@dataclass(frozen=True)
class Rule:
    """Bad above `bad`, good up to `good`, no opinion between."""

    name: str
    measure: Column
    good: float
    bad: float


def rules() -> list[Rule]:
    return [
        Rule("symbols", _share("n_symbols", "n_words"), 0.02, 0.2),
        Rule("marked_words", _share("n_marked", "n_words"), 0.05, 0.4),
        Rule("capitals", _share("n_upper", "n_words"), 0.1, 0.4),
        Rule("repeated_windows", _share("n_repeat_words", "n_words"), 0.2, 0.5),
        Rule("repeated_lines", _share("n_dup_lines", "n_lines"), 0.1, 0.4),
        Rule("few_words", 1 - _share("n_distinct", "n_words"), 0.7, 0.9),
        Rule("long_words", _share("word_chars", "n_words"), 9.0, 14.0),
        Rule("short", 60 / F.greatest(F.col("n_words"), F.lit(1)), 0.6, 1.2),
    ]


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _per_text(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, weights=values, minlength=n).astype(np.int64)


def repeated_words(codes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which words stand in a window of three that occurs twice or more in its text.

    `codes` are the words of several texts as numbers, `of` the text of each.
    """
    hit = np.zeros(len(codes), dtype=bool)
    if len(codes) < 3:
        return hit
    span = int(codes.max()) + 1
    key = of[:-2]
    for k in range(3):
        key = np.unique(key * span + codes[k:len(codes) - 2 + k], return_inverse=True)[1].astype(np.int64)
    whole = of[:-2] == of[2:]
    often = whole & (np.bincount(key[whole], minlength=len(key))[key] > 1)
    for k in range(3):
        hit[k:len(codes) - 2 + k] |= often
    return hit


def measure_texts(texts: list[str]) -> np.ndarray:
    """The COUNTS of each text, a row each."""
    out = []
    for part in _slices(texts):
        n, found, seen = len(part), [_WORD.findall(x) for x in part], {}
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        flat = [w for x in found for w in x]
        of = np.repeat(np.arange(n), sizes)
        codes = np.fromiter((seen.setdefault(w, len(seen)) for w in flat), dtype=np.int64, count=len(flat))
        kinds = list(seen)
        chars = np.array([len(w) for w in kinds], dtype=np.int64)
        upper = np.array([w.isupper() and len(w) > 1 for w in kinds], dtype=np.int64)
        marked = np.array([not w[-1].isalnum() and w[-1] not in ".,;:?'\")]" for w in kinds], dtype=np.int64)
        pairs = np.unique(of * (len(kinds) + 1) + codes) // (len(kinds) + 1)
        lines, again = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for k, text in enumerate(part):
            own = [x for x in text.split("\n") if _WORD.search(x)]
            lines[k], again[k] = len(own), len(own) - len(set(own))
        out.append(np.column_stack([
            sizes, _per_text(chars[codes], of, n), [sum(map(x.count, _SYMBOLS)) for x in part], again,
            _per_text(repeated_words(codes, of), of, n), lines, np.bincount(pairs, minlength=n),
            _per_text(upper[codes], of, n), _per_text(marked[codes], of, n),
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(COUNTS)), dtype=np.int64)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def text_counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(measure_texts([x or "" for x in texts]), columns=list(COUNTS))


def votes() -> Column:
    """-1 bad, 0 abstains, 1 good, for each rule, from the COUNTS of a row."""
    return F.array(*(
        F.when(r.measure > r.bad, -1).when(r.measure <= r.good, 1).otherwise(0).cast("byte") for r in rules()
    ))


@dataclass(frozen=True)
class Weights:
    """Log odds of quality: of the prior, and of each rule's vote (bad, abstains, good)."""

    prior: float
    rule: tuple[tuple[float, float, float], ...]

    def quality(self, vote: Column) -> Column:
        odds = F.lit(self.prior)
        for k, w in enumerate(self.rule):
            v = vote[k]
            odds = odds + F.when(v < 0, w[0]).when(v > 0, w[2]).otherwise(w[1])
        return 1 / (1 + F.exp(-odds))


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Weights:
    """Class and rule rates that explain the vote patterns; a count for each pattern.

    It starts from "an objection makes the bad class likelier than not".
    """
    if not len(patterns):
        return Weights(0.0, tuple((0.0, 0.0, 0.0) for _ in rules()))
    n = counts.sum()
    bad, good = patterns < 0, patterns > 0
    quality = np.where(bad.any(axis=1), 0.25, 0.95)
    old = -math.inf
    for _ in range(rounds):
        side = np.stack([quality * counts, (1 - quality) * counts])
        mass = side.sum(axis=1, keepdims=True)
        # Half a vote each way keeps rates off 0 and 1.
        p_bad = (side @ bad + 0.5) / (mass + 1)
        pooled = (counts @ bad + 0.5) / (n + 1)
        p_bad = np.where(p_bad[0] <= p_bad[1], p_bad, pooled)
        p_good = (side @ good + 0.5) / (side @ ~bad + 1)
        gain = np.log(np.maximum(p_good[0] / p_good[1], 1))
        rest = np.log1p(-p_bad[0]) - np.log1p(-p_bad[1])
        share = max(float(mass[0, 0] / n), 0.5)
        prior = math.log(share + 1e-9) - math.log(1 - share + 1e-9)
        rule = np.stack([np.log(p_bad[0]) - np.log(p_bad[1]), rest, rest + gain], axis=1)
        odds = prior + np.take_along_axis(rule[None].repeat(len(patterns), 0), (patterns + 1)[:, :, None], 2).sum((1, 2))
        quality = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        now = float(counts @ quality)
        if abs(now - old) <= 1e-9 * n:
            break
        old = now
    return Weights(prior, tuple(tuple(map(float, r)) for r in rule))


def fit(measured: DataFrame) -> Weights:
    """Weights from all rows of a table with the COUNTS; collects at most 3 ** len(rules()) patterns."""
    rows = measured.groupBy(votes().alias("votes")).count().collect()
    patterns = np.array([list(r["votes"]) for r in rows], dtype=np.int64).reshape(-1, len(rules()))
    order = np.lexsort(patterns.T)
    return em(patterns[order], np.array([r["count"] for r in rows], dtype=np.float64)[order])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdicts(measured: DataFrame) -> DataFrame:
    """A table with the COUNTS, with base_failed, quality and kept."""
    quality = fit(measured).quality(votes())
    return measured.withColumns({"base_failed": base_failed(), "quality": quality}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= LEAST_QUALITY)
    )


def measured(docs: DataFrame, name: str = "quality") -> DataFrame:
    """doc_id and the COUNTS of every text, worked out once."""
    return written(docs.select("doc_id", text_counts("text").alias("m")).select("doc_id", "m.*"), name)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with all their columns as they are."""
    weights = fit(measured(docs))
    seen = docs.select(F.struct("*").alias("row"), text_counts("text").alias("m")).select("row", "m.*")
    kept = ~base_failed() & (weights.quality(votes()) >= LEAST_QUALITY)
    return seen.where(kept).select("row.*")


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of every document."""
    return verdicts(measured(table(spark, sf_dir, "documents"))).select(
        "doc_id", *COUNTS[:5], "base_failed", "kept", "quality"
    )
