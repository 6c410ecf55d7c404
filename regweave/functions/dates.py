"""Day-month-year text with two-digit years, resolved by a fixed century rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Two-digit years from 50 on belong to the 1900s. A C-style parser
# would place 50-68 in the 2000s, so the quality checks report those as adjusted.
FIRST_OLD_YEAR = "50"
ADJUSTED_YEARS = (1950, 1968)

_EDGE_BLANKS = " \t\n\x0b\f\r"
_SHAPE = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{1,2}\z"
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
_MONTH_NUMBERS = "01-02-03-04-05-06-07-08-09-10-11-12-"  # each where its month stands


def bare_date(c: Column) -> Column:
    """Date text without the whitespace around it."""
    return F.trim(c, F.lit(_EDGE_BLANKS))


def pivot_date(bare: Column) -> Column:
    """``DD-MON-YY`` text as a date, NULL when it names no real day.

    Text of the right shape is respelled with its century as an ISO date, and a
    cast checks the calendar. Unlike a format parser the cast raises nothing
    inside and knows no time zone; the clock is never read either. The shape decides
    over the century alone: no part stands in a branch, so those used twice are worked out once.
    """
    dash = F.instr(bare, "-")
    day = F.substring(bare, F.lit(1), dash - 1)
    month_at = F.instr(F.lit(_MONTHS), F.upper(F.substring(bare, dash + 1, F.lit(3))))
    month = F.when(month_at % 3 == 1, F.substring(F.lit(_MONTH_NUMBERS), month_at, F.lit(3)))
    year = F.lpad(F.substring(bare, dash + 5, F.lit(2)), 2, "0")
    century = F.when(year < FIRST_OLD_YEAR, "20").otherwise("19")
    return F.concat(F.when(bare.rlike(_SHAPE), century), year, F.lit("-"), month, day).try_cast("date")


def has_text(c: Column) -> Column:
    """True where a date column holds anything but spaces."""
    return F.trim(c) != ""


def century_adjusted(day: Column) -> Column:
    """True for a parsed date whose C-style reading the century rule overrode."""
    return F.year(day).between(*ADJUSTED_YEARS)
