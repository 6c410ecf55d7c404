"""How far rates for one service lie apart, and from a benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Cells a group's range is cut into in each pass.
CELLS = 1_024


def moments(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, and the sums of squared and cubed deviations: what merges, in four numbers."""
    n = F.count(value)
    square = F.var_pop(value) * n
    cube = F.coalesce(F.skewness(value), F.lit(0.0)) * F.sqrt(square * square * square / n)
    return rows.groupBy(*by).agg(n.alias("n"), F.avg(value).alias("mean"), square.alias("m2"), cube.alias("m3")).filter("n > 0")


def merged_moments(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of coarser groups from those of finer ones, about the common mean."""
    whole = parts.groupBy(*by).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    whole = whole.select(*(F.col(c).alias(f"_{c}") for c in by), "_mean")
    d = F.col("mean") - F.col("_mean")
    near = parts.join(whole, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return near.groupBy(*by).agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + F.col("n") * d * d * d).alias("m3"),
    )


def shape(parts: DataFrame) -> DataFrame:
    """Standard deviation, its share of the mean, and skewness, from moments."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    skewness = F.when(F.col("m2") > 0, F.col("m3") / F.sqrt(F.col("m2") * F.col("m2") * F.col("m2") / F.col("n")))
    return parts.select("*", deviation.alias("deviation"), (deviation / F.col("mean")).alias("relative"), skewness.alias("skewness"))


def medians(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The lower median of a column of whole numbers (longs) for each group.

    Every pass counts a group's rows in CELLS cells of the range where its median must lie and
    goes on in one of them, until the range is one number: a group's state is CELLS counts,
    whatever its rows, and the passes are the logarithm of the widest range, at most seven.
    """
    rows = rows.filter(F.col(value).isNotNull()).select(F.struct(*by).alias("_by"), F.col(value).cast("long").alias("_v"))
    found = rows.groupBy("_by").agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.floor((F.count("*") - 1) / 2).alias("_rank")
    )
    width = found.agg(F.max(F.col("_hi") - F.col("_lo"))).first()[0] or 0  # one number
    while width:
        step = F.floor((F.col("_hi") - F.col("_lo")) / CELLS) + 1
        cell = F.floor((F.col("_v") - F.col("_lo")) / step)
        inside = rows.join(found, "_by").filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        counts = inside.groupBy("_by", "_lo", "_hi", "_rank", cell.alias("_cell")).agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy("_by").orderBy("_cell"))  # CELLS rows at most
        hit = counts.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
        first = F.col("_lo") + F.col("_cell") * step
        found = hit.select(
            "_by", first.alias("_lo"), F.least(F.col("_hi"), first + step - 1).alias("_hi"),
            (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"),
        )
        width = width // CELLS
    return found.select("_by.*", F.col("_lo").alias("median"))


def median_deviation(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The lower median of each group and that of the distances from it."""
    middle = medians(rows, by, value)
    keyed = middle.select(*(F.col(c).alias(f"_{c}") for c in by), "median")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    away = rows.join(keyed, on).select(*by, F.abs(F.col(value) - F.col("median")).alias("_away"))
    far = medians(away, by, "_away").withColumnRenamed("median", "deviation")
    far = far.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("deviation").alias("median_deviation"))
    return middle.join(far, on).drop(*(f"_{c}" for c in by))


def percent_of_benchmark(rows: DataFrame, by: list[str], paid: str, benchmark: str) -> DataFrame:
    """What is paid in percent of what the benchmark would be; rows without one are counted apart."""
    known = F.col(paid).isNotNull() & (F.col(benchmark) > 0)
    return rows.groupBy(*by).agg(
        F.count_if(known).alias("compared"), F.count_if(~F.coalesce(known, F.lit(False))).alias("without_benchmark"),
        (100 * F.sum(F.when(known, F.col(paid))) / F.sum(F.when(known, F.col(benchmark)))).alias("percent"),
        F.count_if(known & (F.col(paid) > F.col(benchmark))).alias("above"),
    )
