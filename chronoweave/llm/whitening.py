"""Whitening of vectors by a two-pass covariance.

Entries become whole numbers, floor(scale * c), and each distinct vector counts once. First pass: exact sums, so the mean is a
fraction S / n. Second pass: each task centres its rows, (n * x - S) / n with a whole numerator, adds up their outer products by
matrix products, and ``treeAggregate`` merges the tasks' matrices on the executors. LAPACK's symmetric solver gives the components on the
driver, which holds one matrix of dimension x dimension; components, sums and eigenvalues are broadcast (dimension x (components + 1)
numbers) to project all rows. A third pass over the distinct vectors measures how far the covariance of the result is from the identity.

The distinct vectors are written once and read by the three passes. Equal vectors meet in an aggregate that combines before
it shuffles, so a vector that most rows share is no one task's work.

Nulls, ties: rows whose vector is null or holds a null or non-finite entry go; so do none for a null id, and repeated rows give repeated
results. Vectors of different length count as padded with zeros; those without entries have no components. Components whose eigenvalue
is 1e-12 of the trace or less have nothing to be scaled by and are left out; so one distinct vector, or no rows, gives no rows. Equal eigenvalues
leave their components' choice to the solver. Whole numbers must be below 2**53, sums and deviations fit 64 bits; else an error says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import release, written
from .topk import _matrix, _pad, usable

SCALE = 256
COMPONENTS = 4
#: Share of the trace that an eigenvalue must exceed.
LEAST = 1e-12
#: Rows of a matrix product.
ROWS = 8192
#: Sums and products of whole numbers stay below it, or are made of Python's integers.
SAFE = 1 << 62


def numerator(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S for whole numbers, exact."""
    most = max((abs(int(s)) for s in sums), default=0)
    if n * int(np.abs(x).max(initial=0)) + most < SAFE:
        return n * x.astype(np.int64) - sums.astype(np.int64)
    return n * x.astype(np.int64).astype(object) - sums


def deviations(top: np.ndarray) -> np.ndarray:
    """Sums of squares, exact."""
    if top.dtype != object and int(np.abs(top).max(initial=0)) ** 2 * max(1, top.shape[1]) < SAFE:
        return (top * top).sum(axis=1)
    return (top.astype(object) ** 2).sum(axis=1)


@dataclass
class Whitening:
    """n distinct vectors with sums S; axes: one column a component, of falling eigenvalue; the covariance's trace."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def of(self, top: np.ndarray) -> np.ndarray:
        """Whitened rows, from their numerators."""
        return (top / self.n).astype(np.float64) @ (self.axes / np.sqrt(self.values))


def _rows(vectors: DataFrame, vector_col: str, scale: float) -> DataFrame:
    """Usable rows, with whole numbers ``x``."""
    v = F.col(vector_col).cast("array<double>")
    return vectors.where(usable(v)).withColumn("x", F.transform(v, lambda c: F.floor(c * scale)))


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, len(whole), ROWS):
            b = whole.slice(at, ROWS)
            yield b, _pad(_matrix(b.column("x")), width)


def _added(rows: DataFrame, each, width: int) -> np.ndarray | None:
    """The sum of ``each(x)``, a matrix, over all rows: a matrix a task, merged in a tree on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _batches(batches, width):
            total = each(x) if total is None else total + each(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def add(a, b):
        return b if a is None else a if b is None else a + b

    parts = rows.mapInArrow(run, "m binary").rdd
    got = parts.treeAggregate(None, lambda a, row: add(a, np.frombuffer(bytes(row["m"]))), add)
    return None if got is None else got.reshape(-1, int(np.sqrt(len(got))))


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> Whitening | None:
    """The whitening of a table's vectors; None if no component has a variance."""
    rows = _rows(vectors, vector_col, scale).select("x")
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    distinct, n = written(rows.select(F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))).alias("x")).distinct(), "fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for _, x in _batches(batches, width):
            x = x.astype(np.int64)
            total += (x if int(np.abs(x).max(initial=0)) * len(x) < SAFE else x.astype(object)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([list(map(int, total))], pa.list_(pa.int64()))], ["s"])

    # one row a dimension
    got = dict(distinct.mapInArrow(sums, "s array<long>").select(F.posexplode("s")).groupBy("pos").agg(F.sum("col")).collect())
    exact = np.array([got[i] for i in range(width)], object)

    def centred(x: np.ndarray) -> np.ndarray:
        return (numerator(x, n, exact) / n).astype(np.float64)

    def outer(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        return c.T @ c

    covariance = _added(distinct, outer, width) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes, trace = values[::-1], axes[:, ::-1], float(np.trace(covariance))
    k = int((values[:components] > LEAST * trace).sum())
    model = Whitening(n, exact, np.ascontiguousarray(axes[:, :k]), values[:k], trace)

    def check(x: np.ndarray) -> np.ndarray:
        # its mean is 0, as x is centred
        w = model.of(numerator(x, n, exact))
        return w.T @ w

    if k:
        model.identity_error = float(np.abs(_added(distinct, check, width) / n - np.eye(k)).max())
    release(distinct)
    return model if k else None


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """(id, deviation, whitened array<double>) for every row with a usable vector. Vectors must not be longer than the fitted ones."""
    held = vectors.sparkSession.sparkContext.broadcast(model)
    width = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b, x in _batches(batches, width):
            if x.shape[1] > width:
                raise ValueError(f"a vector of {x.shape[1]} entries; the fitted ones have {width}")
            top = numerator(x, m.n, m.sums)
            w = m.of(top)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(list(map(int, deviations(top))), pa.int64()), lists], ["id", "deviation", "whitened"])

    return _rows(vectors, vector_col, scale).select(F.col(id_col).cast("long").alias("id"), "x").mapInArrow(run, "id long, deviation long, whitened array<double>")


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = fit(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = whiten(vectors, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(e / model.trace)) for e in model.values]), F.col("at") + 1)
    return rows.select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
