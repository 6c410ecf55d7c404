"""Keys and references: duplicates, orphans and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from regweave.registry import REGISTRY_KEY


def duplicate_keys(frame: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once; NULLs count as one key."""
    return frame.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphan_rows(child: DataFrame, parent: DataFrame, key: str = REGISTRY_KEY) -> DataFrame:
    """Child rows without a parent; a NULL key has none. Reads one parent column."""
    return child.join(parent.select(key), key, "left_anti")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per table in one job; no column is read."""
    counts = [
        frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def key_profile(
    frames: dict[str, DataFrame], parent: str = "facility", key: str = REGISTRY_KEY
) -> DataFrame:
    """Rows, duplicate parent keys and orphans of all tables from one shuffle.

    Each table contributes its key and a tag. Rows of one key fold into a row of
    counters on the map side, so a key that holds a third of the rows costs one
    small record per task; a join per child would shuffle every row instead.
    """
    names = sorted(frames)
    tagged = [
        frames[n].select(F.col(key).alias("k"), F.lit(i).alias("t")) for i, n in enumerate(names)
    ]
    # Not count_if: its tests are worked out below the union, so each row would carry all of them.
    per_key = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("k")
        .agg(*[F.count(F.when(F.col("t") == i, 1)).alias(f"n{i}") for i in range(len(names))])
    )
    measures = {}
    for i, name in enumerate(names):
        measures[f"rows.{name}"] = F.sum(f"n{i}")
    if parent in frames:
        owned = F.col(f"n{names.index(parent)}")
        known = F.col("k").isNotNull() & (owned > 0)
        measures[f"duplicates.{parent}"] = F.count_if(owned > 1)
        for i, name in enumerate(names):
            if name != parent:
                measures[f"orphans.{name}"] = F.sum(F.when(known, 0).otherwise(F.col(f"n{i}")))
    return per_key.agg(
        *[F.coalesce(m, F.lit(0)).cast("bigint").alias(name) for name, m in measures.items()]
    )
