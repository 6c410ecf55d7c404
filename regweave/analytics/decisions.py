"""Decisions beside what was asked for: time to decision, spread, and where the spread drifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regweave.analytics.scan import as_of, block_window, numbered, with_edges, without_edges


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def decided(decisions: DataFrame, filings: DataFrame, by: list[str], time: str, piece: Column) -> DataFrame:
    """decisions (awarded) with the latest earlier filing (requested) of their group: filed, requested,
    spread and days_to_decision; NULL where nothing was filed before."""
    found = as_of(decisions, filings, by, time, piece, filed=time, requested="requested")
    waited = (_micros(F.col(time)) - _micros(F.col("filed"))) / 86_400_000_000
    return found.withColumn("spread", F.col("requested") - F.col("awarded")).withColumn("days_to_decision", waited)


def drift(cases: DataFrame, by: list[str], order: list[str], piece: Column, value: str, last: int) -> DataFrame:
    """cases with `rolling`, the mean of the last so many values of their series, and `drift`, what it
    has moved since the same number of cases before; both NULL until there are as many.

    Frames run in blocks of positions that carry the rows their frames reach back to.
    """
    rows = numbered(cases.filter(F.col(value).isNotNull()), by, [F.col(c) for c in order], piece)
    rows = with_edges(rows, 2 * last - 1)
    block = block_window(by)
    now, then = block.rowsBetween(1 - last, 0), block.rowsBetween(1 - 2 * last, -last)
    rows = rows.select(
        "*", F.avg(value).over(now).alias("_now"), F.avg(value).over(then).alias("_then"),
    )
    full, twice = F.col("_at") >= last - 1, F.col("_at") >= 2 * last - 1
    rows = rows.withColumn("rolling", F.when(full, F.col("_now"))).withColumn(
        "drift", F.when(twice, F.col("_now") - F.col("_then"))
    )
    return without_edges(rows).drop("_now", "_then", "_at")


def settlement_gap(cases: DataFrame, by: list[str], settled: str, value: str) -> DataFrame:
    """Mean spread of settled and of litigated cases, their difference, and the share settled."""
    own = F.col(settled)
    a, b = F.avg(F.when(own, F.col(value))), F.avg(F.when(~own, F.col(value)))
    return cases.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("cases"), F.avg(own.cast("int")).alias("settled_share"),
        a.alias("settled"), b.alias("litigated"), (a - b).alias("gap"),
    )
