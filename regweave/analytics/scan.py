"""Running totals and neighbours over ordered series, none of which is one task's work.

A window over a whole series puts all of it into one task. Here a series is cut into pieces
along its order: windows run inside the pieces, the pieces' totals are run over, a row for a
piece, and what came before a piece is added to its rows. Neighbours are looked up in blocks
of rows by position, each with the last rows of the block before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Column names the functions here use for themselves.
GROUP, PIECE, AT, BLOCK, EDGE = "_group", "_piece", "_at", "_block", "_edge"
#: Pieces of a value between a number and its double; neighbouring pieces run over together.
PER_OCTAVE, RUN = 32, 64

Total = tuple[Callable[[Column], Column], Column]


def value_piece(value: Column, per_octave: int = PER_OCTAVE) -> Column:
    """A number that never falls as the value grows, so many to an octave; the same on every run."""
    far = 1100 * per_octave  # beyond the least exponent of a double
    size = F.floor(F.log2(F.abs(value)) * per_octave) + far
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("long")


def before(rows: DataFrame, by: list[str], order: list[Column], piece: Column, **totals: Total) -> DataFrame:
    """rows with, for each name, a total (F.sum or F.max of a column) over the rows of their group
    that come before them in `order`; NULL where there is none.

    `piece` must not fall along the order, and NULLs in `by` are a group of their own. Rows of
    one order come in any: totals that must not depend on that need orders without ties.
    Without `by` there is one group, whose pieces are run over in runs of RUN (sums only).
    """
    key = F.struct(*by) if by else F.floor(piece / RUN)
    rows = rows.withColumn(PIECE, piece).withColumn(GROUP, key)
    inside = Window.partitionBy(GROUP, PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    past = Window.partitionBy(GROUP).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(GROUP, PIECE).agg(*(f(c).alias(name) for name, (f, c) in totals.items()))
    carried = pieces.select(GROUP, PIECE, *(f(F.col(name)).over(past).alias(f"_{name}") for name, (f, _) in totals.items()))
    if not by:
        carried = _with_earlier_runs(carried, pieces, list(totals))
    own = rows.select("*", *(f(c).over(inside).alias(name) for name, (f, c) in totals.items()))
    joined = own.join(carried, [GROUP, PIECE])
    for name, (f, _) in totals.items():
        joined = joined.withColumn(name, _both(f, F.col(name), F.col(f"_{name}")))
    return joined.drop(GROUP, PIECE, *(f"_{name}" for name in totals))


def _both(f: Callable, a: Column, b: Column) -> Column:
    if f is F.max:
        return F.greatest(F.coalesce(a, b), F.coalesce(b, a))
    return F.coalesce(a + b, a, b)


def _with_earlier_runs(carried: DataFrame, pieces: DataFrame, names: list[str]) -> DataFrame:
    """What came in earlier runs of pieces, added; the runs are a bounded number of rows."""
    runs = pieces.groupBy(GROUP).agg(*(F.sum(name).alias(name) for name in names))
    listed = runs.agg(F.sort_array(F.collect_list(F.struct(GROUP, *names))).alias("all"))

    def earlier(run: Column, name: str) -> Column:
        return F.aggregate(
            F.filter("all", lambda x: x[GROUP] < run[GROUP]), F.lit(None).cast(runs.schema[name].dataType),
            lambda s, x: F.coalesce(s + x[name], x[name]),
        )

    table = listed.select(F.explode(F.transform("all", lambda run: F.struct(
        run[GROUP].alias(GROUP), *(earlier(run, name).alias(f"_before_{name}") for name in names)
    ))).alias("run")).select("run.*")
    joined = carried.join(table, GROUP)
    for name in names:
        joined = joined.withColumn(f"_{name}", _both(F.sum, F.col(f"_{name}"), F.col(f"_before_{name}")))
    return joined.drop(*(f"_before_{name}" for name in names))


def numbered(rows: DataFrame, by: list[str], order: list[Column], piece: Column) -> DataFrame:
    """rows with their place in their series, from 0, in AT."""
    return before(rows, by, order, piece, **{AT: (F.sum, F.lit(1))}).withColumn(AT, F.coalesce(AT, F.lit(0)))


def with_edges(rows: DataFrame, reach: int, size: int = 4_096) -> DataFrame:
    """Numbered rows by blocks of at least `size`; a block also has, marked, the `reach` rows before it."""
    size = max(size, reach)
    block = F.floor(F.col(AT) / size)
    own = F.struct(block.alias(BLOCK), F.lit(False).alias(EDGE))
    edge = F.struct((block + 1).alias(BLOCK), F.lit(True).alias(EDGE))
    copies = F.when(F.col(AT) % size >= size - reach, F.array(own, edge)).otherwise(F.array(own))
    return rows.select("*", F.explode(copies).alias("_copy")).select("*", "_copy.*").drop("_copy")


def block_window(by: list[str]):
    """A block in order; frames may reach back as far as the edges do."""
    return Window.partitionBy(*by, BLOCK).orderBy(AT)


def without_edges(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col(EDGE)).drop(BLOCK, EDGE)


def as_of(rows: DataFrame, events: DataFrame, by: list[str], time: str, piece: Column, **values: str) -> DataFrame:
    """rows with values of the latest of `events` of their group at or before their time, NULL where
    there is none; of events at one time the one with the greatest values, in the order given.

    Both are laid into one series, and the latest event is the greatest of those before.
    """
    kept = F.struct(F.col(time), *(F.col(column).alias(name) for name, column in values.items()))
    blank = F.lit(None).cast(events.select(kept.alias("e")).schema["e"].dataType)
    left = rows.select(*by, time, F.struct(*rows.columns).alias("_row"), blank.alias("_event"))
    empty = F.lit(None).cast(left.schema["_row"].dataType)
    right = events.select(*by, time, empty.alias("_row"), kept.alias("_event"))
    order = [F.col(time), F.col("_row").isNotNull()]  # an event at the same time comes first
    found = before(left.unionByName(right), by, order, piece, _last=(F.max, F.col("_event")))
    found = found.filter(F.col("_row").isNotNull())
    return found.select("_row.*", *(F.col(f"_last.{name}").alias(name) for name in values))
