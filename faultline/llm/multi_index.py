"""Approximate nearest neighbours by an inverted multi-index.

A vector is cut into two halves, and each half is quantised by a codebook of its own; the pair of codes is its cell. A query
sorts the centroids of either half by distance (minus the inner product, as nearness is the largest inner product) and
walks the cells by summed distance: a heap holds the next pairs, and taking pair ``(i, j)`` adds ``(i + 1, j)`` and
``(i, j + 1)``. The walk ends when the visited cells hold a given share of all entries, and ``k + 1`` of them
or all if fewer. Entries of visited cells are reranked by their exact inner product.

The codebooks are trained on at most ``TRAIN_ROWS`` distinct vectors, chosen by a hash; all vectors are indexed. Entries are
ordered by cell and cut into blocks of bounded size, so a full cell is split. ``VISIT`` was set by measuring recall: the test
vectors are nearly uniform in direction, which is the worst case, and half of the entries give about 0.94.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part, nor do empty ones, those of a
length other than the most frequent, and rows without an id; repeated rows count once; equal scores go by the smaller id; vectors of
one component have an empty first half; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.vector_rows import K, QUERY_STEP, Best, answers, classes, vector_rows
from faultline.plans.durable import durable
from faultline.plans.ordering import position

CENTROIDS = 64
TRAIN_ROWS = 20_000
TRAIN_ROUNDS = 12
VISIT = 0.5
BLOCK = 8_192
QUERY_BLOCK = 2_048


def as_double(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def codebook(x: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """k-means of the rows of ``x``, started from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, min(centroids, len(x))).astype(int)].copy()
    for _ in range(rounds):
        code = nearest_centre(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, x)
        counts = np.bincount(code, minlength=len(centres))
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)


def walk(near_a: np.ndarray, near_b: np.ndarray, counts: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Cells by falling sum of the nearness of their two centroids, until they hold ``enough`` entries."""
    order_a, order_b = np.argsort(-near_a, kind="stable").tolist(), np.argsort(-near_b, kind="stable").tolist()
    far_a, far_b = (-near_a[order_a]).tolist(), (-near_b[order_b]).tolist()
    held = counts.tolist()
    heap, seen, visited, total = [(far_a[0] + far_b[0], 0, 0)], {(0, 0)}, [], 0
    while heap and total < enough:
        _, i, j = heapq.heappop(heap)
        a, b = order_a[i], order_b[j]
        if held[a][b]:
            visited.append((a, b))
            total += held[a][b]
        for u, v in ((i + 1, j), (i, j + 1)):
            if u < len(order_a) and v < len(order_b) and (u, v) not in seen:
                seen.add((u, v))
                heapq.heappush(heap, (far_a[u] + far_b[v], u, v))
    return visited


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


class Codebooks:
    """The codebooks of both halves; a cell is ``code_a * number of b + code_b``."""

    def __init__(self, sample: np.ndarray, centroids: int, rounds: int) -> None:
        self.cut = sample.shape[1] // 2
        self.a = codebook(sample[:, : self.cut], centroids, rounds)
        self.b = codebook(sample[:, self.cut :], centroids, rounds)
        self.shape = (len(self.a), len(self.b))

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest_centre(x[:, : self.cut], self.a) * len(self.b) + nearest_centre(x[:, self.cut :], self.b)

    def nearness(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return q[:, : self.cut] @ self.a.T, q[:, self.cut :] @ self.b.T


def train(every: DataFrame, centroids: int, rows: int, rounds: int) -> Codebooks | None:
    sample = every.select("vkey", "v").orderBy(F.xxhash64("vkey"), "vkey").limit(rows).toPandas()
    return None if sample.empty else Codebooks(_matrix(sample["v"]), centroids, rounds)


def with_cells(every: DataFrame, books: Codebooks) -> DataFrame:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(books.cells(_matrix(vectors)) if len(vectors) else [], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return every.withColumn("cell", F.pandas_udf(run, "long")("v"))


def _visits(books: Codebooks, counts: np.ndarray, visit: float, block: int, k: int):
    """Per query and block it must see: the query with the bits of its visited cells."""
    flat = counts.ravel()
    ends = np.cumsum(flat)
    enough = max(visit * flat.sum(), k + 1)  # the query's own entry may be among them
    first_block, last_block = (ends - flat) // block, np.maximum(ends - 1, 0) // block

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            near_a, near_b = books.nearness(_matrix(batch["v"])) if len(batch) else ([], [])
            for row, a, b in zip(batch.itertuples(index=False), near_a, near_b, strict=True):
                cells = np.array([i * len(books.b) + j for i, j in walk(a, b, counts, enough)])
                bits = np.zeros(len(flat), bool)
                bits[cells] = True
                packed = np.packbits(bits).tobytes()
                spans = {n for c in cells.tolist() for n in range(first_block[c], last_block[c] + 1)}
                rows += [(row.slice, n, row.vkey, row.v, packed) for n in sorted(spans)]
            yield pd.DataFrame(rows, columns=["slice", "block", "vkey", "v", "bits"])

    return run


def _rerank(k: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or entries.empty:
            return pd.DataFrame({"vkey": [], "score": [], "id": []}).astype({"vkey": str, "score": "float64", "id": "int64"})
        q, keys = _matrix(queries["v"]), queries["vkey"].to_numpy()
        bits = np.unpackbits(np.array([np.frombuffer(b, np.uint8) for b in queries["bits"]]), axis=1).astype(bool)
        entries = entries.sort_values("cell_of", kind="stable")
        x, cell = _matrix(entries["x"]), entries["cell_of"].to_numpy()
        ids = [np.asarray(i, np.int64) for i in entries["own"]]
        best = Best(len(q), k, np.float64)
        for start in range(0, len(x), 1024):
            part = slice(start, start + 1024)
            open_pairs = bits[:, cell[part]]
            score = np.where(open_pairs, q @ x[part].T, -np.inf)
            at = min(best.k, score.shape[1] - 1)
            cut = np.maximum(-np.partition(-score, at, axis=1)[:, at], best.floor)
            query, column = np.nonzero((score >= cut[:, None]) & open_pairs)
            best.add(query, score[query, column], start + column, ids)
        return pd.DataFrame({"vkey": keys[best.query], "score": best.score, "id": best.id})

    return run


def nearest(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    step: int = QUERY_STEP,
    centroids: int = CENTROIDS,
    visit: float = VISIT,
    train_rows: int = TRAIN_ROWS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query the ``k`` nearest entries of its visited cells."""
    not_zero = df.where(F.exists(vector, lambda x: x != 0))
    rows = vector_rows(not_zero, key, vector, as_double)
    every = classes(rows, k, step)
    books = train(every, centroids, train_rows, TRAIN_ROUNDS)
    if books is None:
        return rows.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    indexed = durable(position(with_cells(every, books), [F.asc("cell"), F.asc("vkey")], "place"))
    blocked = indexed.withColumn("block", F.floor(F.col("place") / block))
    counts = np.zeros(books.shape, np.int64)
    for cell, n in indexed.groupBy("cell").count().collect():  # at most centroids squared rows
        counts[divmod(cell, books.shape[1])] = n
    asked = blocked.where("asked")
    slices = asked.count() // query_block + 1
    queries = asked.select(F.pmod(F.xxhash64("vkey"), F.lit(slices)).alias("slice"), "vkey", "v")
    # The walks take most of the time, and the queries are few against the entries.
    visits = queries.repartition(queries.sparkSession.sparkContext.defaultParallelism * 2).mapInPandas(
        _visits(books, counts, visit, block, k), "slice long, block long, vkey string, v array<double>, bits binary"
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")).alias("to")
    # New names, as both sides come from one table.
    entries = blocked.select(
        copies, F.col("block").alias("of"), F.col("v").alias("x"), F.col("ids").alias("own"), F.col("cell").alias("cell_of")
    )
    found = (
        visits.groupBy("slice", "block")
        .cogroup(entries.groupBy("to", "of"))
        .applyInPandas(_rerank(k), "vkey string, score double, id long")
    )
    return answers(found, rows, "double", k, step)
