"""Registered queries of the analytics: dated and priced records derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.analytics import decisions, disclosure, dispersion, funding, prices, scores, survival, velocity
from workload.bindings import table

#: Where observation ends, and the day deadlines are counted from.
HORIZON, TODAY, LAST_PERIOD = "2001-12-31", "2000-01-15", "2001-06-30"
COMMISSIONS, LAST_CASES = 8, 20


def _rounded(frame: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so both engines print them alike."""
    return frame.select(*[
        F.round(c, places).alias(c) if frame.schema[c].dataType.typeName() == "double" else c for c in frame.columns
    ])


def _cents(c: str):
    """Money as a whole number, whose sums do not depend on their order."""
    return F.round(F.col(c) * 100).cast("long")


def _day(c: str):
    return F.to_date(c)


def _quarter(c: str):
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


# -- cohorts ----------------------------------------------------------------------


def projects(spark, sf_dir) -> DataFrame:
    """Orders as queued projects: a project leaves with its first returned line after it was placed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_shipdate")
    after = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate"))
    left = orders.join(lines, after, "left").groupBy("o_orderkey", "o_orderdate", "o_orderpriority").agg(
        F.min("l_shipdate").alias("exit")
    )
    end = F.coalesce(_day("exit"), F.lit(HORIZON).cast("date"))
    return left.select(
        F.year("o_orderdate").alias("entered"), F.col("o_orderpriority").alias("priority"),
        F.datediff(end, _day("o_orderdate")).alias("days"), F.col("exit").isNotNull().alias("left_queue"),
    )


def survival_curves(spark, sf_dir):
    return _rounded(survival.product_limit(projects(spark, sf_dir), ["entered", "priority"], "days", "left_queue"))


def cost_per_unit(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    sized = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).withColumn(
        "capacity", F.expr("CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity END")
    )
    sized = sized.withColumn("cents", _cents("l_extendedprice"))
    return survival.cost_per_unit(sized, ["s_nationkey"], "cents", "capacity")


# -- prices -----------------------------------------------------------------------


def bids(spark, sf_dir) -> DataFrame:
    """Lines as bids: item class, region, quarter, bidder and unit price."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("item"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("region"))
    return lines.join(parts, "l_partkey").join(suppliers.join(nations, "s_nationkey"), "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "item", "region", _quarter("l_shipdate").alias("quarter"),
        "l_quantity", _cents("l_extendedprice").alias("cents"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )


def price_index(spark, sf_dir):
    """Prices in money, their means by amount in cents."""
    return prices.index(bids(spark, sf_dir), ["item", "region"], "quarter", "price", "cents", "l_quantity", "l_suppkey")


def bid_percentile(spark, sf_dir):
    ranked = prices.percentile(bids(spark, sf_dir), ["item", "region", "quarter"], "price")
    return ranked.select("l_orderkey", "l_linenumber", "l_suppkey", "item", "region", "quarter", "percentile")


def price_summaries(spark, sf_dir):
    """Medians of items and quarters from merged summaries of their regions, held against the bids."""
    offers = bids(spark, sf_dir)
    cell = ["item", "quarter"]
    summaries = prices.merged(prices.summary(offers, [*cell, "region"], "price"), cell)
    middles = summaries.select(*cell, prices.summary_count().alias("bids"), prices.summary_quantile(0.5).alias("middle"))
    ranked = offers.join(middles, cell).groupBy(*cell, "bids").agg(
        F.count_if(F.col("price") < F.col("middle")).alias("below"), F.count_if(F.col("price") <= F.col("middle")).alias("upto")
    )
    # Three times the error that one quantile in a hundred exceeds.
    slack = F.col("bids") * (3 * prices.RANK_ERROR) + 1
    half = F.col("bids") / 2
    return ranked.select(*cell, "bids", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("within"))


# -- funding ----------------------------------------------------------------------


def needs_and_lines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Open orders as needs, due in half a year, and finished ones as funding lines, by nation."""
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("place"))
    orders = table(spark, sf_dir, "orders").join(nations, "o_custkey").withColumn("day", _day("o_orderdate"))
    needs = orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("need"), "place", F.col("o_totalprice").alias("amount"), F.date_add("day", 180).alias("due"), "o_custkey"
    )
    lines = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("line"), "place", F.col("o_totalprice").alias("amount"), F.col("day").alias("opens")
    )
    return needs, lines


def funding_match(spark, sf_dir):
    return _rounded(funding.match(*needs_and_lines(spark, sf_dir), "place", TODAY))


def intent_rank(spark, sf_dir):
    """Buyers by fused intent: share returned, unfunded needs, and the nearest deadline to come."""
    needs, lines = needs_and_lines(spark, sf_dir)
    owners = needs.select(F.col("need").alias("_need"), "o_custkey")
    matched = funding.match(needs, lines, "place", TODAY).join(owners, F.col("need") == F.col("_need"))
    due = matched.groupBy("o_custkey").agg(
        F.count_if(F.col("line").isNull()).alias("unfunded"),
        F.min(F.when(F.col("months_to_deadline") >= 0, F.col("months_to_deadline"))).alias("months"),
    )
    sold = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    ).groupBy("o_custkey").agg(
        (100 * F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))) / F.sum("l_quantity")).alias("measured")
    )
    rows = sold.join(due, "o_custkey", "full").withColumn("nearness", F.greatest(24 - F.col("months"), F.lit(0.0)))
    scored = scores.fused_score(rows, {"measured": (0.5, 60.0), "unfunded": (0.3, 4.0), "nearness": (0.2, 24.0)})
    scored = scored.withColumn("score", F.round("score", 4))
    ranked = scores.dense_rank(scored, "score")
    segment = F.coalesce(F.col("measured") >= 12, F.lit(False))
    return ranked.select("o_custkey", "score", "missing", segment.alias("segment"), "rank")


# -- decisions --------------------------------------------------------------------


def cases(spark, sf_dir) -> DataFrame:
    """Purchases as decisions on the same user's latest click before, by commission."""
    events = table(spark, sf_dir, "events")
    decided = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", F.col("value").alias("awarded"))
    filed = events.filter("event_type = 'click'").select("user_id", "ts", F.col("value").alias("requested"))
    day = F.datediff(_day("ts"), F.lit("1970-01-01"))
    found = decisions.decided(decided, filed, ["user_id"], "ts", F.floor(day / 7))
    return found.withColumn("commission", F.col("user_id") % COMMISSIONS)


def decision_drift(spark, sf_dir):
    day = F.datediff(_day("ts"), F.lit("1970-01-01"))
    moved = decisions.drift(cases(spark, sf_dir), ["commission"], ["ts", "event_id"], day, "spread", LAST_CASES)
    return _rounded(moved.select("event_id", "commission", "spread", "days_to_decision", "rolling", "drift"))


def settlement_gap(spark, sf_dir):
    settled = cases(spark, sf_dir).withColumn("agreed", F.col("event_id") % 3 != 0)
    return _rounded(decisions.settlement_gap(settled, ["commission"], "agreed", "spread"))


# -- disclosure -------------------------------------------------------------------


def filing_lateness(spark, sf_dir):
    filings = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("issuer"), _day("o_orderdate").alias("filed"))
    since = filings.groupBy("issuer").agg(F.min("filed").alias("since"))
    peers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("issuer"), F.col("c_mktsegment").alias("peers"))
    due = disclosure.obligations(since.join(peers, "issuer"), LAST_PERIOD)
    late = disclosure.lateness(disclosure.matched(due, filings), ["peers"])
    return late.select(
        "issuer", F.col("period_end").cast("string").alias("period_end"), F.col("filed").cast("string").alias("filed"),
        "filer", "days_late", "own_mean", "peer_mean", "peer_non_filers",
    )


# -- rates ------------------------------------------------------------------------


def rate_velocity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", _day("l_shipdate").alias("day")).agg(
        F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("rate")
    )
    found = velocity.velocity(lines, ["l_suppkey"], "day", "rate")
    return found.withColumn("day", F.col("day").cast("string"))


def rate_dispersion(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("service"), F.col("p_brand").alias("market"))
    rates = lines.join(parts, "l_partkey").withColumn("cents", F.floor(F.col("price") * 100).cast("long"))
    by = ["service", "market"]
    whole = dispersion.merged_moments(dispersion.moments(rates, [*by, "l_returnflag"], "price"), by)
    apart = dispersion.median_deviation(rates, by, "cents")
    return _rounded(dispersion.shape(whole).drop("m2", "m3").join(apart, by), 4)


def benchmark_percent(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    known = F.expr("CASE WHEN p_size % 10 <> 0 THEN p_retailprice END")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), known.alias("listed"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = lines.join(parts, "l_partkey").join(suppliers, "l_suppkey").withColumn("paid", _cents("l_extendedprice"))
    rows = rows.withColumn("benchmark", _cents("listed") * F.col("l_quantity"))
    return dispersion.percent_of_benchmark(rows, ["s_nationkey"], "paid", "benchmark")


# -- scores -----------------------------------------------------------------------


def portfolio_score(spark, sf_dir):
    axes = {
        "derived": "1 + c_custkey % 5", "fragmentation": "1 + c_nationkey % 5",
        "deadline": "CASE WHEN c_acctbal >= 0 THEN least(5, 1 + cast(floor(c_acctbal / 2000) AS int)) END",
        "incumbent": "1 + length(c_mktsegment) % 5",
    }
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_acctbal", *(f"cast({e} AS int) AS {a}" for a, e in axes.items()),
        "CASE c_nationkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'moderate' ELSE 'severe' END AS crowding",
    )
    scored = scores.dense_rank(scores.total_score(rows, list(axes)), "total")
    return scores.dense_rank(scored, "c_acctbal", "place").select("c_custkey", *axes, "total", "crowding", "rank", "place")


QUERIES = {
    f.__name__: f
    for f in (
        survival_curves, cost_per_unit, price_index, bid_percentile, price_summaries, funding_match, intent_rank,
        decision_drift, settlement_gap, filing_lateness, rate_velocity, rate_dispersion, benchmark_percent,
        portfolio_score,
    )
}
