"""Scores on several axes and ranks over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.analytics.scan import before, value_piece


def total_score(rows: DataFrame, axes: list[str], name: str = "total") -> DataFrame:
    """rows with the sum of the axes; NULL where an axis is not scored, never a partial sum."""
    total = sum((F.col(a) for a in axes[1:]), F.col(axes[0]))
    return rows.withColumn(name, total)


def dense_rank(rows: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """rows with their place by falling value, from 1; equal values share one, NULL has none.

    The distinct values are cut into pieces by size and counted; a value's place is the number
    of values in greater pieces and before it in its own. No task sees all values.
    """
    values = rows.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_v")).distinct()
    piece = -value_piece(F.col("_v"))
    placed = before(values, [], [F.col("_v").desc()], piece, _above=(F.sum, F.lit(1)))
    placed = placed.select("_v", (F.coalesce("_above", F.lit(0)) + 1).alias(name))
    return rows.join(placed, F.col(value).cast("double") == F.col("_v"), "left").drop("_v")


def fused_score(rows: DataFrame, measures: dict[str, tuple[float, float]], name: str = "score") -> DataFrame:
    """rows with a weighted sum of measures, each cut at its scale and divided by it; a missing measure
    adds nothing and is counted in `missing`. measures: column -> (weight, scale)."""
    parts = [
        F.when(F.col(c).isNull(), 0.0).otherwise(weight * F.least(F.col(c) / scale, F.lit(1.0)))  # least() skips NULLs
        for c, (weight, scale) in measures.items()
    ]
    total = sum(parts[1:], parts[0])
    missing = sum((F.col(c).isNull().cast("int") for c in measures), F.lit(0))
    return rows.withColumn(name, total).withColumn("missing", missing)
