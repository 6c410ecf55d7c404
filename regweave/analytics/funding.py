"""Funding lines for needs: the best match of each side within bands of amount and date."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: A line may exceed its need by this share; it must open at most so many days before the need is due.
SLACK, DAYS = 0.25, 90
#: Bands of amounts to a cell; the more, the fewer needs look into two cells.
WIDE = 12


def _amount_band(amount: Column, slack: float) -> Column:
    """Amounts up to 1 + slack times another lie in its band or the next one."""
    return F.floor(F.log(amount) / F.log(F.lit((1.0 + slack) * (1 + 1e-9)))).cast("long")


def candidates(
    needs: DataFrame, lines: DataFrame, place: str, slack: float = SLACK, days: int = DAYS
) -> DataFrame:
    """Pairs (need, line, place, excess, days_before) of needs (need, amount, due) and lines (line,
    amount, opens) of one place: the line covers the need by at most `slack` more and opens
    within `days` before it is due.

    Amounts and dates are cut into bands as wide as the conditions reach. A need looks into two
    bands of each, a line lies in one, and they meet by equal bands: a plain equi-join, whose
    rows are near misses at worst.
    """
    day = F.datediff(F.col("due"), F.lit("1970-01-01"))
    band = _amount_band(F.col("amount"), slack)
    wanted = needs.filter("amount > 0 AND due IS NOT NULL").select(
        "need", place, F.col("amount").alias("needed"), "due",
        F.explode(F.array(band, band + 1)).alias("_amount"), F.floor(day / days).alias("_last"),
    ).select("*", F.explode(F.array(F.col("_last") - 1, F.col("_last"))).alias("_date")).drop("_last")
    offered = lines.filter("amount > 0 AND opens IS NOT NULL").select(
        "line", place, "amount", "opens", _amount_band(F.col("amount"), slack).alias("_amount"),
        F.floor(F.datediff(F.col("opens"), F.lit("1970-01-01")) / days).alias("_date"),
    )
    early = F.datediff("due", "opens")
    fits = (F.col("amount") >= F.col("needed")) & (F.col("amount") <= F.col("needed") * (1 + slack))
    return wanted.join(offered, [place, "_amount", "_date"]).filter(fits & early.between(0, days - 1)).select(
        "need", "line", place, (F.col("amount") - F.col("needed")).alias("excess"), early.alias("days_before")
    )


def _day(date: str) -> Column:
    return F.datediff(F.col(date), F.lit("1970-01-01"))


def _folded(rows: DataFrame, who: str, place: str, date: str) -> DataFrame:
    """Distinct (place, amount, day) with the least id and the number of rows; rows that meet none are left out."""
    kept = rows.filter(f"amount > 0 AND {date} IS NOT NULL").filter(F.col(place).isNotNull())
    return kept.groupBy(place, "amount", _day(date).alias("_day")).agg(
        F.min(F.struct(who))[who].alias(who), F.count("*").alias("_rows")
    )


def _by_day(days: np.ndarray):
    """Each day with the ascending positions that have it."""
    order = np.argsort(days, kind="stable")
    found, starts = np.unique(days[order], return_index=True)
    return zip(found, np.split(order, starts[1:]))


def _best_lines(first, after, due, opens, weight, days):
    """For needs the number of their lines and the best one: the first that is open on the due day of
    those from `first` up to `after`."""
    count, best = np.zeros(len(due), "int64"), np.full(len(due), -1)
    for d, asked in _by_day(due):
        at = np.flatnonzero((opens <= d) & (opens > d - days))
        low, high = np.searchsorted(at, first[asked]), np.searchsorted(at, after[asked])
        total = np.concatenate([[0], np.cumsum(weight[at])])
        count[asked] = total[high] - total[low]
        some = high > low
        best[asked[some]] = at[low[some]]
    return count, best


def _best_needs(first, after, due, opens, days):
    """For lines the best need: the last that is due while the line is open of those whose `first` is not
    after it, unless it ends before; then all others do."""
    wish = np.full(len(opens), -1)
    for d, offered in _by_day(opens):
        at = np.flatnonzero((due >= d) & (due < d + days))
        last = np.searchsorted(first[at], offered, "right") - 1
        offered, chosen = offered[last >= 0], at[last[last >= 0]]
        fits = after[chosen] > offered
        wish[offered[fits]] = chosen[fits]
    return wish


def _meet(place: str, days: int, of_needs: bool):
    """What a cell's needs find in its lines, or its lines in its needs.

    Both are sorted by amount, of one amount the latest first, so the lines that cover a need lie
    between two places of that order.
    """
    def meet(rows: pa.Table) -> pa.Table:
        amount, top = (rows[c].cast("float64").to_numpy() for c in ("amount", "_top"))
        day, weight, wants = (rows[c].to_numpy() for c in ("_day", "_rows", "_wants"))
        order = np.lexsort((-day, amount))
        need, line = order[wants[order]], order[~wants[order]]
        first = np.searchsorted(amount[line], amount[need], "left")
        after = np.searchsorted(amount[line], top[need], "right")
        if of_needs:
            count, at = _best_lines(first, after, day[need], day[line], weight[line], days)
            own, other, who = need, line, "line"
        else:
            at = _best_needs(first, after, day[need], day[line], days)
            count, own, other, who = at, line, need, "need"
        found = at >= 0
        mine, its = rows.take(own[found]), rows.take(other[at[found]])
        key = {c: mine[c] for c in (place, "amount", "_day")}
        return pa.table({**key, "_lines": count[found], "_amount": its["amount"], "_its_day": its["_day"], who: its[who]})

    return meet


def _found(needs: DataFrame, lines: DataFrame, place: str, slack: float, days: int) -> tuple[DataFrame, DataFrame]:
    """Per distinct (place, amount, day) of the needs its number of lines (_lines) and the best one, and
    of the lines the best need, as _pair (excess, days_before, id). Those that meet none are left out.

    Every line lies in one cell of amounts and dates, and a need looks into the few cells that its
    conditions reach: rows travel that often at most, however many pairs there are. A cell is
    one task's work, which grows with its rows and the days of its dates, not with its pairs.
    """
    band, date = _amount_band(F.col("amount"), slack), F.floor(F.col("_day") / days)
    cells = F.array_distinct(F.array(F.floor(band / WIDE), F.floor((band + 1) / WIDE)))
    wanted, offered = _folded(needs, "need", place, "due"), _folded(lines, "line", place, "opens")
    wanted = wanted.select(
        "*", (F.col("amount") * (1 + slack)).cast("double").alias("_top"), F.lit(True).alias("_wants"),
        F.explode(cells).alias("_band"),
    ).select("*", F.explode(F.array(date - 1, date)).alias("_date"))
    offered = offered.select(
        "*", F.lit(None).cast("double").alias("_top"), F.lit(False).alias("_wants"),
        F.floor(band / WIDE).alias("_band"), date.alias("_date"),
    )
    cell = wanted.unionByName(offered, allowMissingColumns=True).groupBy(place, "_band", "_date")
    key = [place, "amount", "_day"]

    def met(own: DataFrame, other: DataFrame, who: str, sign: int) -> DataFrame:
        schema = own.select(*key, F.lit(0).cast("long").alias("_lines")).schema
        schema = schema.add("_amount", other.schema["amount"].dataType).add("_its_day", "integer").add(who, other.schema[who].dataType)
        found = cell.applyInArrow(_meet(place, days, who == "line"), schema)
        excess, early = (F.col("_amount") - F.col("amount")) * sign, (F.col("_day") - F.col("_its_day")) * sign
        return found.select(*key, "_lines", F.struct(excess.alias("excess"), early.alias("days_before"), who).alias("_pair"))

    by_need = met(wanted, offered, "line", 1).groupBy(*key).agg(F.sum("_lines").alias("_lines"), F.min("_pair").alias("_pair"))
    return by_need, met(offered, wanted, "need", -1).drop("_lines")


def match(
    needs: DataFrame, lines: DataFrame, place: str, as_of: str, slack: float = SLACK, days: int = DAYS
) -> DataFrame:
    """Every need with its number of candidate lines, the best one, whether that line has no better
    need, and the months from `as_of` until it is due. Needs without funding have NULLs.

    The best pair has the least excess; of those the nearest date, then the least id. Pairs are
    counted and chosen in cells and never listed; results go back to the rows that asked.
    """
    wanted, offered = _found(needs, lines, place, slack, days)
    key = [place, "amount", "_day"]
    asked = needs.select("need", place, "amount", _day("due").alias("_day")).join(wanted, key)
    by_need = asked.groupBy("need").agg(F.sum("_lines").alias("_lines"), F.min("_pair").alias("_best"))
    opened = lines.select("line", place, "amount", _day("opens").alias("_day")).join(offered, key)
    by_line = opened.groupBy("line").agg(F.min("_pair").alias("_wish")).select(
        F.col("line").alias("_line"), F.col("_wish.need").alias("_wished")
    )
    found = needs.join(by_need, "need", "left").join(by_line, F.col("_best.line") == F.col("_line"), "left")
    return found.select(
        "need", place, "amount", F.coalesce("_lines", F.lit(0)).alias("candidates"),
        F.col("_best.line").alias("line"), F.col("_best.excess").alias("excess"),
        F.col("_best.days_before").alias("days_before"),
        F.coalesce(F.col("_wished") == F.col("need"), F.lit(False)).alias("mutual"),
        F.months_between(F.col("due"), F.lit(as_of).cast("date"), False).alias("months_to_deadline"),
    )
