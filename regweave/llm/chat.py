"""Conversations made legal at the least cost, and rendered.

A legal conversation is an optional system turn, then user and assistant in turn. A turn
of the input is kept, given another role, or merged into the turn before; an empty turn may
be inserted in front of it. Dynamic programming over the automaton "role of the last turn"
finds the cheapest repair of the whole conversation.

A turn's choices are a small matrix of costs (from role, to role); matrices multiply by
(min, +), which is associative. So a conversation of any length is cut into blocks: each
block gives one matrix, a scan over the blocks' matrices gives the best role at each
border, and every block is then repaired by itself between its two borders. Almost all
conversations are one block and skip the first two steps.

A conversation is rendered block by block: the fragments of its turns, one after another,
closed by END, are its text, and a block is never longer than its turns are.

Defined results: turns go by number, null last, then by the hash of role, text and copy;
exact repeats of a numbered turn (same conversation, number, role, text) are one turn that
tells how many copies it stands for, repeats without a number are turns of their own; a
null or unknown role costs `GUESS` to read as any; a null text is empty; rows with a null
conversation are one conversation; very long texts are passed on whole; other columns are
not read; an empty table gives no rows. Among repairs of equal cost the earliest in the
order keep, merge, insert wins. Giving a turn another role costs more than an empty turn
before it, so an answer that opens a conversation stays an answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import matched, table

ROLES = ("system", "user", "assistant")
START = 3
#: Costs of a repair.
GUESS, MERGE, RELABEL, INSERT = 1, 2, 5, 4
#: Turns a block spans, and distinct turns from which a span is cut further.
SPAN, LIMIT = 1024, 4096
#: What may follow what (role numbers; START before the first turn).
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}

#: One way to take a turn: cost, rank, action, role inserted before it.
Choice = tuple[int, int, str, int | None]


def _choices() -> dict[int | None, list[list[Choice | None]]]:
    """For each role given (None: unknown), the cheapest choice from state to state."""
    out = {}
    for given in (0, 1, 2, None):
        grid: list[list[Choice | None]] = [[None] * 4 for _ in range(4)]
        for state in range(4):
            for to in range(3):
                label = GUESS if given is None else 0 if given == to else RELABEL
                ways: list[Choice] = []
                if to in NEXT[state]:
                    ways.append((label, 0, "keep" if not label else "relabel", None))
                if to == state:
                    ways.append((label + MERGE, 1, "merge", None))
                ways += [(label + INSERT, 2, "insert", x) for x in NEXT[state] if to in NEXT[x]]
                grid[state][to] = min(ways, key=lambda w: w[:2], default=None)
        out[given] = grid
    return out


CHOICES = _choices()


def role_number(role: str | None) -> int | None:
    role = (role or "").strip().lower()
    return ROLES.index(role) if role in ROLES else None


def block_costs(roles: list[int | None], entry: int) -> list[float]:
    """Least cost of taking all turns from an entry state, for each state at the end."""
    cost = [math.inf] * 4
    cost[entry] = 0
    for given in roles:
        grid, new = CHOICES[given], [math.inf] * 4
        for state in range(4):
            if cost[state] < math.inf:
                for to in range(3):
                    if (c := grid[state][to]) is not None and cost[state] + c[0] < new[to]:
                        new[to] = cost[state] + c[0]
        cost = new
    return cost


def repair(roles: list[int | None], entry: int = START, leave: int | None = None) -> list[tuple[int, Choice]]:
    """For each turn its new role and choice; `leave` is the state to end in, if it is fixed."""
    cost, back = [math.inf] * 4, []
    cost[entry] = 0
    for given in roles:
        grid, new, came = CHOICES[given], [math.inf] * 4, [0] * 4
        for state in range(4):
            if cost[state] < math.inf:
                for to in range(3):
                    if (c := grid[state][to]) is not None and cost[state] + c[0] < new[to]:
                        new[to], came[to] = cost[state] + c[0], state
        cost = new
        back.append(came)
    state = min(range(4), key=lambda s: cost[s]) if leave is None else leave
    out = []
    for given, came in zip(reversed(roles), reversed(back)):
        out.append((state, CHOICES[given][came[state]][state]))
        state = came[state]
    return out[::-1]


def fragment(role: str, choice: Choice, text: str, first: bool) -> str:
    """What a turn adds to the rendered conversation, which END closes."""
    if choice[2] == "merge":
        return "\n" + text
    inserted = f"<|{ROLES[choice[3]]}|>\n{END}" if choice[3] is not None else ""
    return ("" if first else END) + inserted + f"<|{role}|>\n{text}"


END = "<|end|>\n"
_ORDER = ["conv_id", "span", "part", "turn", "tie", "role", "text"]


def _blocks(turns: DataFrame, span: int, limit: int) -> DataFrame:
    """Distinct turns with the block they belong to: blocks of a conversation follow each other
    by (span, part)."""
    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    # Without a number every copy is a turn.
    apart = F.when(F.col("turn").isNull(), F.sequence(F.lit(1).cast("long"), F.col("copies"))).otherwise(F.array(F.lit(0).cast("long")))
    turns = turns.withColumn("copy", F.explode(apart)).withColumn(
        "copies", F.when(F.col("turn").isNull(), F.lit(1).cast("long")).otherwise(F.col("copies"))
    )
    turns = turns.withColumn("span", F.coalesce(F.floor(F.col("turn") / span), F.lit((1 << 62))))
    tie = F.when(F.col("copy") == 0, F.xxhash64("role", "text")).otherwise(F.xxhash64("role", "text", "copy"))
    turns = turns.withColumn("tie", F.pmod(tie, F.lit(1 << 31))).drop("copy")
    # Spans with too many turns: by turn, and by ranges of the hash within a turn.
    crowds = turns.groupBy("conv_id", "span", "turn").count()
    spans = crowds.groupBy("conv_id", "span").agg(F.sum("count").alias("n")).where(F.col("n") > limit).drop("n")
    big = matched(crowds, spans, ["conv_id", "span"], "left_semi").select(
        "conv_id", "span", "turn", F.ceil(F.col("count") / limit).alias("cuts")
    )
    parts = matched(turns, big, ["conv_id", "span", "turn"], "left")
    part = F.when(F.col("cuts").isNull(), F.array(F.lit(0).cast("long"), F.lit(0).cast("long"))).otherwise(
        F.array(F.coalesce("turn", F.lit(1 << 62)), F.floor(F.col("tie") * F.col("cuts") / (1 << 31)))
    )
    return parts.select("conv_id", "span", part.alias("part"), "turn", "tie", "role", "text", "copies")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Blocks of a sorted stream, whole."""
    held, key = [], None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
            own = (row[0], row[1], tuple(row[2]))
            if own != key and held:
                yield key, held
                held = []
            key = own
            held.append(row)
    if held:
        yield key, held


def _mended(turns: DataFrame, span: int, limit: int) -> DataFrame:
    """Blocks sorted and together, with the states at their borders, their number in the
    conversation and whether it ends there."""
    blocks = _blocks(turns, span, limit)
    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, of, part), rows in _by_block(batches):
            roles = [role_number(r[5]) for r in rows]
            costs = [c for entry in range(4) for c in block_costs(roles, entry)]
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "span": of, "part": list(part), "costs": costs}],
                pa.schema([("conv_id", pa.int64()), ("span", pa.int64()), ("part", pa.list_(pa.int64())), ("costs", pa.list_(pa.float64()))]),
            )

    def scan(blocks_of: pd.DataFrame) -> pd.DataFrame:
        """Best states at the borders of one conversation's blocks."""
        blocks_of = blocks_of.assign(p=[tuple(p) for p in blocks_of["part"]]).sort_values(["span", "p"])
        cost, back = [math.inf] * 3 + [0.0], []
        for costs in blocks_of["costs"]:
            new, came = [math.inf] * 4, [0] * 4
            for state in range(4):
                for to in range(4):
                    if cost[state] + costs[4 * state + to] < new[to]:
                        new[to], came[to] = cost[state] + costs[4 * state + to], state
            cost = new
            back.append(came)
        state, borders = min(range(4), key=lambda s: cost[s]), []
        for came in reversed(back):
            borders.append((came[state], state))
            state = came[state]
        blocks_of["entry"], blocks_of["leave"] = zip(*borders[::-1])
        blocks_of["number"] = range(len(blocks_of))
        blocks_of["ends"] = blocks_of["number"] == len(blocks_of) - 1
        return blocks_of[["conv_id", "span", "part", "entry", "leave", "number", "ends"]]

    several = blocks.select("conv_id", "span", "part").distinct().groupBy("conv_id").count().where("count > 1").select("conv_id")
    long = matched(blocks, several, ["conv_id"], "left_semi").repartition("conv_id", "span", "part").sortWithinPartitions(*_ORDER)
    borders = long.select(*_ORDER).mapInArrow(
        matrix, "conv_id long, span long, part array<long>, costs array<double>"
    ).groupBy("conv_id").applyInPandas(
        scan, "conv_id long, span long, part array<long>, entry int, leave int, number long, ends boolean"
    )
    return matched(blocks, borders, ["conv_id", "span", "part"], "left").select(
        *_ORDER, "copies", F.coalesce("entry", F.lit(START)).alias("entry"), "leave",
        F.coalesce("number", F.lit(0).cast("long")).alias("number"), F.coalesce("ends", F.lit(True)).alias("ends"),
    ).repartition("conv_id", "span", "part").sortWithinPartitions(*_ORDER)


def _repairs(rows: list[tuple]) -> Iterator[tuple[tuple, str, Choice, str]]:
    """A block's turns with their new role, what was done, and what they add to the text."""
    done = repair([role_number(r[5]) for r in rows], rows[0][8], rows[0][9])
    for k, (r, (to, choice)) in enumerate(zip(rows, done)):
        text = fragment(ROLES[to], choice, r[6] or "", k == 0 and r[8] == START)
        yield r, ROLES[to], choice, text + (END if r[11] and k == len(rows) - 1 else "")


def repaired(turns: DataFrame, *, span: int = SPAN, limit: int = LIMIT) -> DataFrame:
    """Every turn with its new role, what was done, and its rendered fragment.

    A conversation's fragments in the order of (span, part, turn, tie, role, text) are its
    rendered text.
    """
    names = ["conv_id", "turn", "role", "copies", "new_role", "action", "inserted", "fragment", "span", "part", "tie"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, rows in _by_block(batches):
            for r, role, choice, text in _repairs(rows):
                inserted = None if choice[3] is None else ROLES[choice[3]]
                out.append((r[0], r[3], r[5], r[7], role, choice[2], inserted, text, r[1], r[2], r[4]))
            if len(out) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return _mended(turns, span, limit).mapInArrow(
        mend, "conv_id long, turn long, role string, copies long, new_role string, action string, inserted string, "
        "fragment string, span long, part array<long>, tie long"
    )


_TEXT = "conv_id long, block long, turns long, copies long, relabelled long, merged long, inserted long, text string"


def rendered_blocks(turns: DataFrame, *, span: int = SPAN, limit: int = LIMIT) -> DataFrame:
    """The text of every conversation in blocks numbered from 0, with what was repaired there."""
    names = [x.split()[0] for x in _TEXT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (conv, _, _), rows in _by_block(batches):
            done = list(_repairs(rows))
            actions = [choice[2] for _, _, choice, _ in done]
            text = "".join(x for _, _, _, x in done)
            out.append((
                conv, rows[0][10], len(rows), sum(r[7] for r in rows), actions.count("relabel"), actions.count("merge"),
                sum(choice[3] is not None for _, _, choice, _ in done), text,
            ))
            size += len(text)
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return _mended(turns, span, limit).mapInArrow(render, _TEXT)


def rendered(fragments: DataFrame) -> DataFrame:
    """One text a conversation, for conversations that fit a row."""
    parts = F.sort_array(F.collect_list(F.struct("span", "part", F.coalesce("turn", F.lit(1 << 62)), "tie", "role", "fragment")))
    return fragments.groupBy("conv_id").agg(parts.alias("p")).select("conv_id", F.array_join(F.col("p.fragment"), "").alias("text"))


def op7_repair_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, repaired and rendered, in numbered blocks."""
    return rendered_blocks(table(spark, sf_dir, "conversations"))
