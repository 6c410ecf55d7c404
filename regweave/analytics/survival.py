"""Survival curves by cohort, from subjects that left or are still there."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.analytics.scan import before


def product_limit(subjects: DataFrame, cohort: list[str], time: str, left: str, width: int = 64) -> DataFrame:
    """The product-limit estimate: for each cohort and time seen, at_risk, events, censored,
    survival and its standard error (Greenwood).

    Subjects fold to their cohort and time before anything is sorted. Those at risk are a total
    from the end, the curve a running sum of logarithms; both are cut into pieces of `width`
    times, so a cohort that holds most subjects is many tasks' work. A time without events
    keeps the curve level; where all at risk leave, the curve ends at 0. Subjects without a
    time are left out; a NULL cohort is one of its own; NULL in `left` counts as still there.
    """
    gone = F.coalesce(F.col(left), F.lit(False))
    seen = subjects.filter(F.col(time).isNotNull()).groupBy(*cohort, time).agg(
        F.count("*").alias("_n"), F.count_if(gone).alias("events")
    )
    piece = F.floor(F.col(time) / width)
    risk = before(seen, cohort, [F.col(time).desc()], -piece, _later=(F.sum, F.col("_n")))
    risk = risk.withColumn("at_risk", F.col("_n") + F.coalesce("_later", F.lit(0)))
    some = F.col("events") < F.col("at_risk")
    step = F.when(some, F.log1p(-F.col("events") / F.col("at_risk"))).otherwise(0.0)
    spread = F.when(some, F.col("events") / (F.col("at_risk") * (F.col("at_risk") - F.col("events")))).otherwise(0.0)
    steps = risk.select(*cohort, time, "at_risk", "events", (F.col("_n") - F.col("events")).alias("censored"),
                        step.alias("_step"), spread.alias("_spread"), (~some).cast("int").alias("_end"))
    run = before(steps, cohort, [F.col(time)], piece, _steps=(F.sum, F.col("_step")),
                 _spreads=(F.sum, F.col("_spread")), _ends=(F.sum, F.col("_end")))

    def upto(name: str):
        return F.coalesce(F.col(f"{name}s"), F.lit(0)) + F.col(name)

    alive = F.when(upto("_end") > 0, 0.0).otherwise(F.exp(upto("_step")))
    return run.select(*cohort, time, "at_risk", "events", "censored", alive.alias("survival"),
                      (alive * F.sqrt(upto("_spread"))).alias("std_error"))


def median_time(curve: DataFrame, cohort: list[str], time: str, share: float = 0.5) -> DataFrame:
    """For each cohort the first time at which no more than `share` are left; NULL where more stay."""
    return curve.groupBy(*cohort).agg(F.min(F.when(F.col("survival") <= share, F.col(time))).alias("median_time"))


def cost_per_unit(projects: DataFrame, place: list[str], cost: str, capacity: str) -> DataFrame:
    """Cost of a unit of capacity by place; projects without both are counted apart."""
    sized = F.col(cost).isNotNull() & (F.col(capacity) > 0)
    return projects.groupBy(*place).agg(
        F.count_if(sized).alias("projects"), F.count_if(~F.coalesce(sized, F.lit(False))).alias("without_size"),
        (F.sum(F.when(sized, F.col(cost))) / F.sum(F.when(sized, F.col(capacity)))).alias("cost_per_unit"),
        F.min(F.when(sized, F.col(cost) / F.col(capacity))).alias("least"),
        F.max(F.when(sized, F.col(cost) / F.col(capacity))).alias("most"),
    )
