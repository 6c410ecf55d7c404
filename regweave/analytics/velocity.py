"""How fast rates change, and whether ever faster, over irregular dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.analytics.scan import block_window, numbered, with_edges, without_edges


def velocity(rates: DataFrame, series: list[str], day: str, rate: str, piece_days: int = 366, size: int = 4_096) -> DataFrame:
    """The change points of each series (one rate a day at most): the rate, its change, velocity (the
    change for a day since the change before) and acceleration (the velocity's, for a day).

    A day whose rate is that of the day before it in the series is no change. The first point
    has no change, the second no acceleration. Series are numbered in pieces and looked at in
    blocks of `size` days, each with the rows before it, so one of any length is many tasks' work.
    """
    piece = F.floor(F.datediff(F.col(day), F.lit("1970-01-01")) / piece_days)
    known = rates.filter(F.col(day).isNotNull() & F.col(rate).isNotNull())
    block = block_window(series)
    rows = with_edges(numbered(known, series, [F.col(day)], piece), 1, size)
    rows = rows.withColumn("_old", F.lag(rate).over(block))
    points = without_edges(rows).filter(F.col("_old").isNull() | (F.col("_old") != F.col(rate))).drop("_old", "_at")
    rows = with_edges(numbered(points, series, [F.col(day)], piece), 2, size)
    gap = F.datediff(F.col(day), F.lag(day).over(block))
    rows = rows.withColumn("change", F.col(rate) - F.lag(rate).over(block)).withColumn("days", gap)
    rows = rows.withColumn("velocity", F.col("change") / F.col("days"))
    rows = rows.withColumn("acceleration", (F.col("velocity") - F.lag("velocity").over(block)) / F.col("days"))
    return without_edges(rows).drop("_at")
