"""Filings against the calendar of what was due: lateness, non-filers, own history and peers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regweave.analytics.scan import AT, before, numbered

#: Days after the end of a quarter until its filing is due.
GRACE = 45


def obligations(issuers: DataFrame, last: str, grace: int = GRACE) -> DataFrame:
    """A row for each quarter of each issuer (issuer, since): number from 0, period_end and due, up
    to the quarter that ends at `last` at the latest."""
    ends = F.sequence(F.last_day(F.add_months(F.date_trunc("quarter", "since"), 2)), F.lit(last).cast("date"),
                      F.expr("INTERVAL 3 MONTHS"))
    begun = issuers.filter(F.last_day(F.add_months(F.date_trunc("quarter", "since"), 2)) <= F.lit(last).cast("date"))
    rows = begun.select("*", F.posexplode(ends).alias("number", "period_end"))
    rows = rows.withColumn("period_end", F.last_day("period_end"))
    return rows.withColumn("due", F.date_add("period_end", grace))


def matched(due: DataFrame, filings: DataFrame, piece_days: int = 366) -> DataFrame:
    """Obligations (issuer, number, period_end, due) with the filing (issuer, filed) that met each.

    In order of their periods, each obligation takes the issuer's earliest filing after the
    period's end that no earlier one took. If `first` filings were made by its end, obligation
    i takes number max(its predecessor's + 1, first), which is i plus the greatest first - j of
    all j up to i: a running maximum, cut into pieces, instead of a loop over an issuer.
    """
    def piece(c: Column) -> Column:
        return F.floor(F.datediff(c, F.lit("1970-01-01")) / piece_days)

    made = numbered(filings.select("issuer", "filed").distinct(), ["issuer"], [F.col("filed")], piece(F.col("filed")))
    blank = F.lit(None).cast("int")
    dated = due.select("issuer", "number", F.col("period_end").alias("day"), F.lit(0).alias("one")).unionByName(
        made.select("issuer", blank.alias("number"), F.col("filed").alias("day"), F.lit(1).alias("one"))
    )
    # A filing on the last day of a period was made by its end.
    order = [F.col("day"), F.col("number").isNotNull()]
    known = before(dated, ["issuer"], order, piece(F.col("day")), first=(F.sum, F.col("one")))
    known = known.filter(F.col("number").isNotNull()).select(
        "issuer", "number", "day", (F.coalesce("first", F.lit(0)) - F.col("number")).alias("_lead")
    )
    taken = before(known, ["issuer"], [F.col("number")], piece(F.col("day")), _most=(F.max, F.col("_lead")))
    taken = taken.select("issuer", "number", (F.greatest("_most", "_lead") + F.col("number")).alias("_at"))
    met = made.select(F.col("issuer").alias("_issuer"), F.col(AT).alias("_filing"), "filed")
    found = taken.join(met, (F.col("issuer") == F.col("_issuer")) & (F.col("_at") == F.col("_filing")), "left")
    return due.join(found.select("issuer", "number", "filed"), ["issuer", "number"], "left")


def lateness(met: DataFrame, peers: list[str], piece_periods: int = 16) -> DataFrame:
    """Matched obligations with days_late, the mean of the issuer's earlier ones and that of the other
    issuers of its peer group in the period; a non-filer has no lateness, but peers and history."""
    late = F.datediff("filed", "due")
    rows = met.withColumn("days_late", late).withColumn("filer", F.col("filed").isNotNull())
    rows = before(
        rows, ["issuer"], [F.col("number")], F.floor(F.col("number") / piece_periods),
        _sum=(F.sum, F.col("days_late")), _n=(F.sum, F.col("filer").cast("long")),
    )
    group = [*peers, "period_end"]
    sums = rows.groupBy(*group).agg(F.sum("days_late").alias("_all"), F.count("days_late").alias("_filers"),
                                    F.count_if(~F.col("filer")).alias("peer_non_filers"))
    sums = sums.select(*(F.col(c).alias(f"_{c}") for c in group), "_all", "_filers", "peer_non_filers")
    rows = rows.join(sums, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    own = F.coalesce("days_late", F.lit(0))
    others = F.col("_filers") - F.col("filer").cast("long")
    return rows.select(
        *met.columns, "filer", "days_late",
        F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).alias("own_mean"),
        F.when(others > 0, (F.col("_all") - own) / others).alias("peer_mean"),
        (F.col("peer_non_filers") - (~F.col("filer")).cast("long")).alias("peer_non_filers"),
    )
