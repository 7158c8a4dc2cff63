"""What both vector searches share: usable rows, classes of equal vectors, best rows per query.

Equal vectors have equal scores, so they form one class that is scored once. A query has at most ``k``
results, hence the ``k + 1`` smallest ids of a class (one may be the query's own) are all that any query
can return from it. This is how a vector that a third of all rows share costs no more than another.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.skew import attach
from faultline.plans.durable import durable

QUERY_STEP = 20
K = 20


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def vector_rows(df: DataFrame, key: str, vector: str, convert: Callable[[Column], Column]) -> DataFrame:
    """``id, v, vkey`` of the usable rows; ``convert`` makes the numbers that are searched.

    Vectors of a length other than the most frequent one (the shorter, if two are as frequent) take no part,
    nor do rows without an id; a repeated row counts once.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("raw"))
    rows = rows.where(usable(F.col("raw")) & F.col("id").isNotNull())
    lengths = rows.groupBy(F.size("raw").alias("length")).count().orderBy(F.desc("count"), "length").first()
    dimension = lengths[0] if lengths else 0
    rows = rows.where(F.size("raw") == dimension).select("id", convert(F.col("raw")).alias("v"))
    both = F.concat_ws("/", F.xxhash64("v").cast("string"), F.xxhash64(F.lit(7), "v").cast("string"))
    return durable(rows.withColumn("vkey", both).dropDuplicates(["id", "vkey"]))


def classes(rows: DataFrame, k: int = K, step: int = QUERY_STEP) -> DataFrame:
    """One row per distinct vector: ``vkey, v, ids`` (its ``k + 1`` smallest), ``cls`` (the smallest), ``asked``."""
    first = Window.partitionBy("vkey").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    grouped = few.groupBy("vkey").agg(
        F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("cls")
    )
    asked = rows.where(F.col("id") % step == 0).select("vkey").distinct().withColumn("asked", F.lit(True))
    return durable(grouped.join(asked, "vkey", "left").withColumn("asked", F.coalesce("asked", F.lit(False))))


def answers(found: DataFrame, rows: DataFrame, score_type: str, k: int = K, step: int = QUERY_STEP) -> DataFrame:
    """``query_id, rank, vec_id, score`` from the best rows that tasks ``found`` per asked vector.

    ``found`` has ``vkey, score, id``. Own rows are left out here, so one row more than ``k`` is kept before.
    """
    order = Window.partitionBy("vkey").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    asking = rows.where(F.col("id") % step == 0).select("id", "vkey")
    counts = asking.groupBy("vkey").agg(F.count("*").alias("n"))
    lists = best.groupBy("vkey").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("best"))
    groups = durable(lists.join(counts, "vkey"))
    joined = attach(asking, groups, "vkey", "n", asking.count(), "id")
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k)
    placed = joined.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b"))
    return placed.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").cast(score_type).alias("score")
    )


class Best:
    """The ``k + 1`` best rows of each query seen so far: higher score first, then smaller id."""

    def __init__(self, queries: int, k: int, dtype: type) -> None:
        self.k = k + 1
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, dtype)
        self.id = np.zeros(0, np.int64)
        self.floor = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, entry: np.ndarray, ids: list[np.ndarray]) -> None:
        """Candidates ``(query, score)`` with their class, and the ids of every class."""
        if not len(query):
            return
        counts = np.array([len(ids[e]) for e in entry.tolist()])
        query = np.concatenate([self.query, np.repeat(query, counts)])
        score = np.concatenate([self.score, np.repeat(score, counts)])
        own = np.concatenate([self.id, *(ids[e] for e in entry.tolist())])
        order = np.lexsort((own, -score, query))
        query, score, own = query[order], score[order], own[order]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        lengths = np.diff(np.append(starts, len(query)))
        place = np.arange(len(query)) - np.repeat(starts, lengths)
        kept = place < self.k
        last = place == self.k - 1
        self.floor[query[last]] = score[last]
        self.query, self.score, self.id = query[kept], score[kept], own[kept]
