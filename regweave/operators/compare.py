"""Differences between two builds or two reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regweave.registry import LINK_KEY


class IncomparableBuilds(ValueError):
    """The builds scanned different sources, so their counts do not compare."""


def _outer(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    before = old.select(*key, F.struct(*values).alias("before"))
    after = new.select(*key, F.struct(*values).alias("after"))
    return before.join(after, key, "full")


def _change(differs: Column) -> Column:
    return (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .when(differs, "changed")
    )


def require_same_sources(old_sources: DataFrame, new_sources: DataFrame) -> None:
    """Refuse to compare provenance over different denominators (tiny tables)."""
    old = {r.source_table for r in old_sources.select("source_table").collect()}
    new = {r.source_table for r in new_sources.select("source_table").collect()}
    if old != new:
        raise IncomparableBuilds(f"only one build scanned: {', '.join(sorted(old ^ new))}")


def link_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Links added, removed, or asserted by other sources than before.

    Both crosswalks are already distinct by link, so the join never fans out.
    """
    joined = _outer(old, new, list(LINK_KEY), ["source_tables"])
    change = _change(F.col("before.source_tables") != F.col("after.source_tables"))
    return joined.select(
        *LINK_KEY,
        change.alias("change"),
        F.col("before.source_tables").alias("before"),
        F.col("after.source_tables").alias("after"),
    ).filter(F.col("change").isNotNull())


def report_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Quality lines that appeared, vanished or changed between two reports."""
    joined = _outer(old, new, ["name"], ["status", "value"])
    change = _change(
        ~F.col("before.status").eqNullSafe(F.col("after.status"))
        | ~F.col("before.value").eqNullSafe(F.col("after.value"))
    )
    return joined.select(
        "name",
        change.alias("change"),
        F.col("before.status").alias("old_status"),
        F.col("after.status").alias("new_status"),
        F.col("before.value").alias("old_value"),
        F.col("after.value").alias("new_value"),
    ).filter(F.col("change").isNotNull())
