"""Whitening of embeddings (method: bidiagonal qd solver).

Entries become whole numbers, x = floor(1024 * c) + 100000, so their sums are exact. Every
task reduces its centred rows to one triangular factor, block by block; factors of FAN tasks
at a time are stacked and reduced again, until one is left, of the size of a vector's
dimensions squared whatever the number of rows. Householder reflections make it bidiagonal,
dqds finds its singular values, twisted factorisations the directions (see bidiagonal).
Nothing is squared on the way: the covariance itself is never formed.

Defined results: rows whose vector is null, or holds a null, a non-finite entry or one beyond
what x can be as a long, are left out, as are those whose length is not the most frequent one
(of equally frequent ones the greatest); a null id and repeated rows are rows of their own;
components without variance are not returned, so that vectors all alike, or a single one,
give no rows, like an empty table; equal eigenvalues share their plane in some orthogonal way;
a deviation beyond a long is null in `deviation` and whole in `deviation_text`; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bidiagonal import largest
from .common import table, written

#: How an entry becomes a whole number.
SCALE, SHIFT = 1024, 100_000
#: Components; rows reduced at a time; factors stacked in one step.
COMPONENTS, BLOCK, FAN = 8, 2_048, 16
#: Entries must stay below this, times SCALE.
_LIMIT = float(1 << 62)
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """n vectors with these sums per dimension; eigenvalues and unit components (columns) of their
    covariance, and its trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float


def vectors(rows: DataFrame, key: str, column: str) -> DataFrame:
    """id and vec (doubles) of the rows that count, all of one length."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < _LIMIT)
    doubles = F.col(column).cast("array<double>")
    good = rows.select(F.col(key).alias("id"), doubles.alias("vec")).where(F.col("vec").isNotNull() & F.forall("vec", entry))
    common = good.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("vec") == (common["d"] if common else 0))


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of a batch, a row each."""
    entries = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(entries * SCALE).astype(np.int64) + SHIFT


def _safe(x: np.ndarray, n: int) -> np.ndarray:
    """x, as unbounded integers where n times it could leave a long."""
    return x.astype(object) if x.size and n * int(np.abs(x).max()) >= 1 << 61 else x


def _deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    sums = np.array(model.sums, dtype=object if max(map(abs, model.sums), default=0) >= 1 << 61 else np.int64)
    return _safe(x, model.n) * model.n - sums


def _sums(good: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and their sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for batch in batches:
            x = _safe(_whole(batch, d), batch.num_rows)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
            n += batch.num_rows
        if n:
            columns = [pa.array(range(-1, d), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "total"])

    found = good.mapInArrow(run, "dim int, total decimal(38, 0)").groupBy("dim").agg(F.sum("total").alias("total"))
    totals = {r["dim"]: int(r["total"]) for r in found.collect()}  # a row per dimension
    return totals.pop(-1, 0), tuple(totals.get(k, 0) for k in range(d))


def _triangle(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _factor(good: DataFrame, model: Whitening) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d = len(model.sums)
    kind = "part long, r binary"

    def rows(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                x = _whole(batch.slice(k, BLOCK), d)
                r = _triangle([r, _deviations(x, model).astype(float) / model.n])
        if len(r):
            yield rows(TaskContext.get().partitionId(), r)

    def stack(key: tuple, group: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(x, dtype=float).reshape(-1, d) for x in group.sort_by("part").column("r").to_pylist()]
        return pa.Table.from_batches([rows(key[0].as_py(), _triangle(blocks))])

    # Numbered by task; a level of the tree leaves one in FAN.
    factors = written(good.mapInArrow(run, kind), "factors")
    most = factors.agg(F.max("part")).first()[0]
    while most:
        groups = factors.withColumn("up", F.floor(F.col("part") / FAN)).groupBy("up")
        factors, most = written(groups.applyInArrow(stack, kind), "factors"), most // FAN
    r = np.frombuffer(factors.first()["r"], dtype=float).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def fit(good: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors (id, vec); None where there are none."""
    first = good.select(F.size("vec").alias("d")).first()
    d = first["d"] if first else 0
    if not d:
        return None
    n, sums = _sums(good, d)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    r = _factor(good, model)
    squares, directions = largest(r, components)
    return Whitening(n, sums, squares[: directions.shape[1]] / n, directions, float(np.sum(r * r)) / n)


def _white(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (_deviations(x, model).astype(float) / model.n) @ (model.components / np.sqrt(model.values))


def identity_error(good: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    d, k = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            white = _white(_whole(batch, d), model)
            total += np.vstack([white.T @ white, white.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "total"])

    found = good.mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((k + 1) * k)  # a row per pair of components
    for row in found:
        total[row["at"]] = row["total"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_text string"
)


def whiten(rows: DataFrame, *, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: its whitened value, with what the whole fit says."""
    good = vectors(rows, key, column)
    model = fit(good, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], _OUT)
    error = identity_error(good, model)
    d, k = model.components.shape
    explained = model.values / model.trace
    names = [x.split()[0] for x in _OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(a, BLOCK)
                x = _whole(batch, d)
                v = _deviations(x, model)
                if x.size and (v.dtype == object or d * int(np.abs(v).max()) ** 2 > _LONG):
                    v = v.astype(object)
                far = [int(s) for s in (v * v).sum(axis=1)]
                at = np.repeat(np.arange(len(x)), k)
                longs = pa.array([s if s <= _LONG else None for s in far], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), model.n)),
                    longs.take(pa.array(at)),
                    pa.array(_white(x, model).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                    pa.array([str(s) for s in far]).take(pa.array(at)),
                ], names)

    return good.select(F.col("id").cast("long").alias("id"), "vec").mapInArrow(run, _OUT)


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along their first eight whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))
