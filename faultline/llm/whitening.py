"""Whitening of embeddings, from singular values and not from a covariance matrix.

Components become whole numbers, and every distinct vector counts once in the fit. Sums per dimension are added exactly. Each
task then reduces its centred rows to a triangle, a block of rows at a time (QR), and triangles are
merged in rounds until a few are left for the driver; a triangle has as many numbers as the dimension squared, whatever
the number of rows. The last one is made bidiagonal by Householder reflections, its singular values come from dqds to high
relative accuracy, and twisted factorisations give the directions (``bidiagonal``). Squaring rows into a covariance first would lose half
of the digits of small eigenvalues. How far the whitened fit list is from unit covariance is measured by another pass.

Defined cases: null vectors, vectors with a null or non-finite component, empty ones and those of a length other than the most
frequent (the shorter, if two are) take no part, nor do those whose numbers exceed ``LARGEST``; rows without an id stay, under a
null id; repeated rows are returned as often, but fitted once; directions of no variance beyond rounding are left out, so
equal vectors alone give no rows, and neither does an empty table; eigenvalues that agree to rounding have any orthogonal
directions of their space; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.bidiagonal import leading_directions
from faultline.llm.vector_rows import usable
from faultline.plans.durable import durable

SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 52)
COMPONENTS = 16
SLICE = 4_096
FAN = 16  # triangles merged at a time
LOW_BITS = 26
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("raw")).where(usable(F.col("raw")))
    lengths = rows.groupBy(F.size("raw").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("raw") == (lengths[0] if lengths else 0))
    scaled = F.transform("raw", lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    fits = F.forall("raw", lambda c: F.abs(c.cast("double") * SCALE) <= LARGEST)
    return rows.where(fits).select("vec_id", scaled.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


class Centre:
    """The exact mean ``m + r / n`` of every dimension, ``m`` and ``r`` whole and ``0 <= r < n``."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.m = np.array([s // n for s in sums], np.int64)
        self.r = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.m) - self.r / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """``sum((n x - S) ** 2)`` per row, exact; null beyond a long."""
        off = x - self.m
        widest = int(np.abs(off).max(initial=0))
        if ((widest + 1) * self.n) ** 2 * x.shape[1] < 1 << 63:
            return pa.array(((off * self.n - self.r) ** 2).sum(axis=1))
        r = self.r.tolist()
        exact = [sum((d * self.n - s) ** 2 for d, s in zip(row, r, strict=True)) for row in off.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def centre(fit: DataFrame) -> Centre | None:
    """Sums in two halves of their bits, so that none passes a long before it is added in the driver's whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 0):
            high, low = x >> LOW_BITS, x & ((1 << LOW_BITS) - 1)
            arrays = [np.arange(x.shape[1]), np.full(x.shape[1], part.num_rows), high.sum(axis=0), low.sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["pos", "n", "high", "low"])

    sums = fit.mapInArrow(run, "pos long, n long, high long, low long").groupBy("pos")
    total = sums.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")])
    rows = total.orderBy("pos").collect()  # as many as the dimension
    return Centre(int(rows[0]["n"]), [(int(r["high"]) << LOW_BITS) + int(r["low"]) for r in rows]) if rows else None


def _triangle(*blocks: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _unpacked(packed: bytes, d: int) -> np.ndarray:
    return np.frombuffer(packed, np.float64).reshape(-1, d)


def triangle(fit: DataFrame, mean: Centre) -> np.ndarray:
    """Square ``r`` with ``r.T r`` equal to the products of the centred rows."""
    d = len(mean.m)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, number = np.zeros((0, d)), 0
        for part, x in _matrices(batches, 0):
            r, number = _triangle(r, mean.centred(x)), part.column(1)[0].as_py()
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        r = _triangle(*[_unpacked(p, d) for p in group["r"]])
        return pd.DataFrame({"part": [group["part"].iloc[0] // FAN], "r": [r.tobytes()]})

    parts = fit.select("x", F.spark_partition_id().cast("long").alias("part"))
    left = durable(parts.mapInArrow(reduce, "part long, r binary"))
    while left.count() > FAN:
        left = durable(left.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(merge, "part long, r binary"))
    rows = left.orderBy("part").collect()  # at most FAN triangles
    r = _triangle(np.zeros((d, d)), *[_unpacked(row["r"], d) for row in rows])
    return r


def identity_error(fit: DataFrame, mean: Centre, projection: np.ndarray) -> float:
    """Largest entry of the whitened covariance minus the identity, from all rows of the fit list."""
    k = projection.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for _, x in _matrices(batches, 0):
            w = np.column_stack([mean.centred(x) @ projection, np.ones(len(x))])
            total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "value"])

    sums = fit.select("x").mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value"))
    total = np.zeros((k + 1, k + 1))
    for i, j, value in sums.collect():  # (k + 1) ** 2 rows
        total[i, j] = value
    means = total[:k, k] / mean.n
    return float(np.abs(total[:k, :k] / mean.n - np.outer(means, means) - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component, falling eigenvalue first: the whitened coordinate, and what describes the fit."""
    rows = whole_vectors(df, key, vector)
    fit = durable(rows.select("x").distinct())
    mean = centre(fit)
    if mean is None:
        return df.sparkSession.createDataFrame([], RESULT)
    r = triangle(fit, mean)
    squares, vectors = leading_directions(r, components)
    if not len(squares):
        return df.sparkSession.createDataFrame([], RESULT)
    projection = vectors / np.sqrt(squares / mean.n)
    explained = squares / (r**2).sum()
    error = identity_error(fit, mean, projection)
    k = len(squares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 1):
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), mean.n)),
                    mean.deviations(x).take(pa.array(each)),
                    pa.array((mean.centred(x) @ projection).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                [c.split()[0] for c in RESULT.split(", ")],
            )

    return rows.mapInArrow(run, RESULT)
