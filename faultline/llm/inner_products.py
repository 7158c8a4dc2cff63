"""Exact top-k by inner product, vectors taken by descending length.

Components become ``floor(64 * x)``, so scores are whole numbers. Vectors are numbered by descending length and
cut into blocks; queries are cut into blocks too, and each pair of blocks is one group of a shuffle. Every query first
meets the block of the longest vectors, whose ``k``-th score bounds what later blocks must beat:

- a block whose longest vector times the query's length stays below the bound is not shipped to at all;
- inside a block, the same test ends the walk down the lengths;
- for the rest, the inner product over the leading components in the basis of the data's singular vectors, plus the product of
  the lengths of what is left (Cauchy-Schwarz), must reach the bound before the score is computed.

The basis comes from the sums of products of all vectors, added up in Spark. It only decides what is
skipped; scores are computed from the whole numbers themselves, exactly.

Defined cases: null vectors, and vectors with a null or non-finite component, take no part, nor do empty ones, those of a
length other than the most frequent, and rows without an id; repeated rows count once; equal scores go by
the smaller id; an empty table gives an empty result. A score beyond the range of a long is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.vector_rows import K, QUERY_STEP, Best, answers, classes, vector_rows
from faultline.plans.durable import durable
from faultline.plans.ordering import position

SCALE = 64
BLOCK = 8_192
QUERY_BLOCK = 2_048
CHUNK = 1_024
LEADING = (16, 32)
EXACT = float(1 << 53)
DENSE = 0.2  # above this share of open pairs, whole products are cheaper than single ones


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))


def singular_basis(vectors: DataFrame) -> np.ndarray:
    """Right singular vectors of all rows, largest singular value first, from the matrix of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0).to_numpy(zero_copy_only=False))
                x = x / np.maximum(np.abs(x).max(), 1)  # only directions matter; no overflow
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "value"])

    sums = vectors.select("v").mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = sums.toPandas()  # as many rows as the dimension squared
    if found.empty:
        return np.zeros((0, 0))
    products = np.zeros((found["i"].max() + 1,) * 2)
    products[found["i"], found["j"]] = found["value"]
    _, basis = np.linalg.eigh((products + products.T) / 2)
    return basis[:, ::-1]


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, as whole numbers."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < EXACT:
        return np.einsum("ij,ij->i", q, x)
    big = [sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(q.tolist(), x.tolist(), strict=True)]
    if any(not -(1 << 63) <= b < 1 << 63 for b in big):
        raise OverflowError("a score exceeds the range of a long")
    return np.array(big, object)


def search_block(
    q: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: list[np.ndarray], basis: np.ndarray, k: int
) -> Best:
    """Best rows of ``x`` for every query, of those that reach its ``floor``."""
    best = Best(len(q), k, object if np.abs(q).max() * np.abs(x).max() * q.shape[1] >= EXACT else np.float64)
    best.floor = floor.copy()
    length = np.linalg.norm(x, axis=1)
    order = np.argsort(-length, kind="stable")
    x, length, ids = x[order], length[order], [ids[i] for i in order.tolist()]
    q_length = np.linalg.norm(q, axis=1)
    q_turned, x_turned = q @ basis, x @ basis
    rest = [(m, np.linalg.norm(q_turned[:, m:], axis=1), np.linalg.norm(x_turned[:, m:], axis=1)) for m in LEADING if m < q.shape[1]]
    for start in range(0, len(x), CHUNK):
        part = slice(start, start + CHUNK)
        # Rounding of the turned numbers must not hide a row.
        slack = 1e-9 * q_length * length[start] + 1e-9
        open_q = np.flatnonzero(q_length * length[start] + slack >= best.floor)
        if not len(open_q):
            break
        alive = np.ones((len(open_q), len(x[part])), bool)
        done, partial = 0, np.zeros(alive.shape)
        for m, q_rest, x_rest in rest:
            partial += q_turned[open_q, done:m] @ x_turned[part, done:m].T
            done = m
            bound = partial + np.outer(q_rest[open_q], x_rest[part]) + slack[open_q, None]
            alive &= bound >= best.floor[open_q, None]
            if not alive.any():
                break
        row, column = np.nonzero(alive)
        if not len(row):
            continue
        query, entry = open_q[row], start + column
        if len(row) > DENSE * alive.size and best.score.dtype != object:
            score = (q[open_q] @ x[part].T)[row, column]
        else:
            score = np.concatenate(
                [_exact(q[query[i : i + 65536]], x[entry[i : i + 65536]]) for i in range(0, len(row), 65536)]
            )
        fits = score >= best.floor[query]
        query, score, entry = query[fits], score[fits], entry[fits]
        # Of many candidates of a query only its k + 1 best classes matter, with all that tie.
        if len(query) > 4 * best.k * len(open_q) and score.dtype != object:
            grid = np.full((len(q), len(x[part])), -np.inf)
            grid[query, entry - start] = score
            cut = -np.partition(-grid, min(best.k, grid.shape[1] - 1), axis=1)[:, min(best.k, grid.shape[1] - 1)]
            fits = score >= cut[query]
            query, score, entry = query[fits], score[fits], entry[fits]
        best.add(query, score, entry, ids)
    return best


def _cells(basis: np.ndarray, k: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        names = ["vkey", "score", "id"]
        if queries.empty or vectors.empty:
            return pd.DataFrame({"vkey": [], "score": [], "id": []}).astype({"vkey": str, "score": "int64", "id": "int64"})
        ids = [np.asarray(i, np.int64) for i in vectors["own"]]
        floor = queries["floor"].to_numpy(np.float64)
        best = search_block(_matrix(queries["v"]), floor, _matrix(vectors["x"]), ids, basis, k)
        keys = queries["vkey"].to_numpy()
        return pd.DataFrame(dict(zip(names, (keys[best.query], best.score.astype(np.int64), best.id), strict=True)))

    return run


def top_products(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    step: int = QUERY_STEP,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest products of every query with the other rows."""
    rows = vector_rows(df, key, vector, whole)
    every = classes(rows, k, step)
    basis = singular_basis(every)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    numbered = durable(
        position(every.withColumn("length", length), [F.desc("length"), F.asc("vkey")], "place").withColumn(
            "block", F.floor(F.col("place") / block)
        )
    )
    asked = numbered.where("asked")
    slices = asked.count() // query_block + 1
    queries = asked.select("vkey", "v", "length", F.pmod(F.xxhash64("vkey"), F.lit(slices)).alias("slice"))
    blocks = numbered.groupBy("block").agg(F.max("length").alias("longest"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")).alias("to")

    def meet(asking: DataFrame, members: DataFrame) -> DataFrame:
        left = asking.select("slice", "block", "vkey", "v", "floor").groupBy("slice", "block")
        # New names, as both sides come from one table.
        right = members.select(copies, F.col("block").alias("of"), F.col("v").alias("x"), F.col("ids").alias("own"))
        right = right.groupBy("to", "of")
        return left.cogroup(right).applyInPandas(_cells(basis, k), "vkey string, score long, id long")

    nowhere = F.lit(float("-inf")).alias("floor")
    head = durable(meet(queries.select("*", F.lit(0).cast("long").alias("block"), nowhere), numbered.where("block = 0")))
    kth = head.groupBy("vkey").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = kth.select("vkey", F.when(F.col("n") > k, F.col("least").cast("double")).otherwise(nowhere).alias("floor"))
    bounded = queries.join(floors, "vkey", "left").withColumn("floor", F.coalesce("floor", nowhere))
    # A block is shipped the queries that its longest vector could serve.
    later = bounded.join(blocks.where("block > 0"), F.col("length") * F.col("longest") * (1 + 1e-9) + 1e-9 >= F.col("floor"))
    found = head.unionByName(meet(later, numbered.where("block > 0")))
    return answers(found, rows, "long", k, step)
