"""Unit prices: exact ranks and quantiles of a cell, an index over quarters, summaries that merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from regweave.analytics.scan import before, value_piece

#: Size of a summary; a quantile's rank is off by at most RANK_ERROR of the count, 99 times of 100.
SUMMARY, RANK_ERROR = 200, 0.0165


def _folded(bids: DataFrame, cell: list[str], price: str) -> DataFrame:
    """Each price of a cell once, with its bids, the bids below it and all of the cell's.

    Prices are cut into pieces by size, so a cell with a third of all bids is many tasks' work.
    """
    seen = bids.filter(F.col(price).isNotNull()).groupBy(*cell, price).agg(F.count("*").alias("n"))
    low = before(seen, cell, [F.col(price)], value_piece(F.col(price)), below=(F.sum, F.col("n")))
    return low.withColumn("below", F.coalesce("below", F.lit(0)))


def _matching(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which NULL keys match."""
    right = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, on).drop(*(f"_{k}" for k in keys))


def _with_totals(bids: DataFrame, cell: list[str], price: str) -> DataFrame:
    folded = _folded(bids, cell, price)
    return _matching(folded, folded.groupBy(*cell).agg(F.sum("n").alias("bids")), cell)


def quantiles(bids: DataFrame, cell: list[str], price: str, **shares: float) -> DataFrame:
    """For each cell and name the least price that this share of the bids does not exceed."""
    ranked = _with_totals(bids, cell, price)
    reached = F.col("below") + F.col("n")
    return ranked.groupBy(*cell).agg(
        *(F.min(F.when(reached >= F.col("bids") * share, F.col(price))).alias(name) for name, share in shares.items())
    )


def percentile(bids: DataFrame, cell: list[str], price: str) -> DataFrame:
    """bids with `percentile`: the share of the cell's other bids that are lower; 0 for a single one.

    Equal prices share theirs. A bid without a price has none.
    """
    ranked = _with_totals(bids, cell, price)
    share = F.when(F.col("bids") > 1, F.col("below") / (F.col("bids") - 1)).otherwise(0.0)
    ranked = ranked.select(*cell, price, share.alias("percentile"))
    priced = _matching(bids.filter(F.col(price).isNotNull()), ranked, [*cell, price])
    rest = bids.filter(F.col(price).isNull()).withColumn("percentile", F.lit(None).cast("double"))
    return priced.unionByName(rest)


def index(
    bids: DataFrame, item: list[str], quarter: str, price: str, cost: str, amount: str, bidder: str
) -> DataFrame:
    """Normalised price of each item and quarter: bids, bidders, the median, the mean by amount, the
    spread of the bids in medians, and the change of the median since the item's quarter before."""
    cell = [*item, quarter]
    measured = bids.filter(F.col(price).isNotNull()).groupBy(*cell).agg(
        F.count("*").alias("bids"), F.count_distinct(bidder).alias("bidders"),
        (F.sum(cost) / F.sum(amount)).alias("mean_price"), (F.max(price) - F.min(price)).alias("_range"),
    )
    joined = _matching(measured, quantiles(bids, cell, price, median_price=0.5), cell)
    earlier = F.lag("median_price").over(Window.partitionBy(*item).orderBy(quarter))  # a row for a quarter
    return joined.select(
        *cell, "bids", "bidders", "median_price", "mean_price",
        (F.col("_range") / F.col("median_price")).alias("spread"),
        (F.col("median_price") / earlier - 1).alias("escalation"),
    )


def summary(bids: DataFrame, cell: list[str], price: str, size: int = SUMMARY) -> DataFrame:
    """A quantile summary of each cell, of bounded size whatever the number of bids, to be stored."""
    return bids.filter(F.col(price).isNotNull()).groupBy(*cell).agg(
        F.kll_sketch_agg_double(price, size).alias("summary")
    )


def merged(summaries: DataFrame, cell: list[str], size: int = SUMMARY) -> DataFrame:
    """Summaries of coarser cells from those of finer ones; no bid is read again."""
    return summaries.groupBy(*cell).agg(F.kll_merge_agg_double("summary", size).alias("summary"))


def summary_quantile(share: float) -> Column:
    return F.kll_sketch_get_quantile_double("summary", F.lit(float(share)))


def summary_count() -> Column:
    return F.kll_sketch_get_n_double("summary")
