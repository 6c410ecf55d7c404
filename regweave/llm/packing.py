"""Vector bin packing of tokenised examples (method: dot-product heuristic).

An example is a run of token ids of which a tail bears loss. A sequence holds at
most so many tokens, segments and loss-bearing tokens at once. The open sequence
takes the piece that fits and whose demand has the largest weighted dot product with
what is left of the three limits; the weights are the mean demands of the pool, so a
scarce limit counts more. When nothing fits any more, the longest piece is cut at the
gap. So every sequence but the last of a task is filled up to a limit.

Each task packs its own partition: no shuffle, and a lost task is repeated as it was.
A task holds a pool of at most `POOL` pieces of one sequence's length.

Defined results: a null text counts as empty and is one end id; a null or repeated
doc_id is carried through, each row being an example of its own; an empty table gives
no rows; very long texts become whole sequences and one rest; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, texts_of
from .tokens import added_tokens, default_vocabulary, encoder

#: Pieces in a task's pool before sequences are closed.
POOL = 2048
#: Rows of a batch on its way back.
OUT_ROWS = 2048

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, "
    "sequence_id long, offset long"
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at once."""

    tokens: int = 1024
    segments: int = 128
    loss_tokens: int = 1024


def pack(
    docs: DataFrame, *, limits: Limits = Limits(), vocabulary: str | None = None, end_id: int = 0,
    prompt_chars: str | None = None, added: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Pieces of all texts, placed in sequences.

    `prompt_chars` names a column with the number of leading characters that bear no
    loss (the prompt of an instruction); without it every token bears loss. `added` are
    tokens outside the vocabulary (string, id) that texts are cut at.
    Sequences are `sequence_id`; a piece is `ids` (unsigned 32-bit, little-endian),
    which are the text's ids from `start` on, and stands at `offset` of its sequence.
    """
    vocabulary = vocabulary or default_vocabulary()
    prompt = F.col(prompt_chars).cast("long") if prompt_chars else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", prompt.alias("prompt"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Packer(limits, encoder(vocabulary, end_id, added)).run(batches)

    return rows.mapInArrow(place, SCHEMA)


class _Packer:
    """The pool and the open output of one task."""

    def __init__(self, limits: Limits, ids_of):
        self.limits, self.ids_of = limits, ids_of
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        context = TaskContext.get()
        self.sequence = (context.partitionId() if context else 0) << 40
        self.pool: list[tuple] = []  # (doc_id, doc_tokens, first token, ids, first loss-bearing token)
        self.out: list[tuple] = []

    def run(self, batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                self.read(part)
                if len(self.pool) >= POOL:
                    self.close(last=False)
                while len(self.out) >= OUT_ROWS:
                    yield self.give(OUT_ROWS)
        self.close(last=True)
        while self.out:
            yield self.give(OUT_ROWS)

    def give(self, n: int) -> pa.RecordBatch:
        rows, self.out = self.out[:n], self.out[n:]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
        names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def read(self, part: pa.RecordBatch) -> None:
        """Tokenise; whole sequences leave at once, the rest waits in the pool."""
        texts = texts_of(part)
        ids, bounds = self.ids_of.batch(texts)
        doc_ids, prompts = part.column(0).to_pylist(), part.column(2).to_pylist()
        for k, text in enumerate(texts):
            own = ids[bounds[k]:bounds[k + 1]]
            silent = 0
            if prompts[k]:
                head, ends = self.ids_of.batch([text[: prompts[k]]])
                silent = int(ends[-1]) - 1
            at, total = 0, len(own)
            while at < total:
                n = min(self.longest(at, silent, self.limits.tokens, self.limits.loss_tokens), total - at)
                piece = (doc_ids[k], total, at, own[at:at + n], silent)
                if n == self.limits.tokens:
                    self.emit(piece, n, 0)
                    self.sequence += 1
                else:
                    self.pool.append((*piece[:3], piece[3].copy(), silent))
                at += n

    @staticmethod
    def longest(at: int, silent: int, tokens: int, loss: int) -> int:
        """How long a piece from `at` on may be, so that neither limit is passed."""
        return min(tokens, max(0, silent - at) + loss)

    @staticmethod
    def loss(piece: tuple, n: int) -> int:
        return max(0, piece[2] + n - max(piece[2], piece[4]))

    def emit(self, piece: tuple, n: int, offset: int) -> None:
        self.out.append((
            piece[0], piece[2], n, piece[3][:n].tobytes(), piece[1], self.loss(piece, n), self.sequence, offset,
        ))

    def close(self, *, last: bool) -> None:
        """Fill sequences from the pool; unless it is the last time, what can't fill one stays."""
        pool = self.pool
        demand = np.array([(len(p[3]), 1, self.loss(p, len(p[3]))) for p in pool], dtype=np.float64).reshape(-1, 3)
        weight = (demand / self.caps).mean(axis=0) / self.caps**2 if len(pool) else None
        live = np.ones(len(pool), dtype=bool)
        left_tokens = int(demand[:, 0].sum())
        while left_tokens and (last or left_tokens >= 4 * self.limits.tokens):
            room = self.caps.copy()
            while room[1] >= 1 and room[0] >= 1 and left_tokens:
                fits = live & (demand <= room).all(axis=1)
                if fits.any():
                    best = int(np.argmax(np.where(fits, demand @ (weight * room), -1)))
                    n = len(pool[best][3])
                else:  # cut the longest piece at the gap
                    best = int(np.argmax(np.where(live, demand[:, 0], -1)))
                    n = min(self.longest(pool[best][2], pool[best][4], int(room[0]), int(room[2])), len(pool[best][3]))
                    if n <= 0:
                        break
                piece = pool[best]
                self.emit(piece, n, int(self.caps[0] - room[0]))
                room -= (n, 1, self.loss(piece, n))
                left_tokens -= n
                if n == len(piece[3]):
                    live[best] = False
                else:
                    pool[best] = rest = (piece[0], piece[1], piece[2] + n, piece[3][n:], piece[4])
                    demand[best] = (len(rest[3]), 1, self.loss(rest, len(rest[3])))
            self.sequence += 1
        self.pool = [p for p, on in zip(pool, live) if on]


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, ids as the vocabulary's tokenizer gives them."""
    return pack(table(spark, sf_dir, "documents"), added=added_tokens()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "loss_tokens",
    )
