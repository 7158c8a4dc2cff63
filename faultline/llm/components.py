"""Connected components by contraction.

Every node moves to the neighbour, or itself, whose hash is smallest; edges are rewritten to where their ends have
moved, and those within one place vanish. Stars collapse in two rounds and paths lose a constant share of their nodes
in each, so the rounds grow with the logarithm of the longest chain. Nothing is collected; each round is a checkpoint.
Once ``FEW_EDGES`` or fewer are left, one task takes them to their ends: a round leaves plans, jobs and task records on the
driver, however small it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.skew import attach
from faultline.plans.durable import durable


FEW_EDGES = 1 << 20


def smallest_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each end of the edges, and the smallest node that edges lead to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = np.split(ends, 2)
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [[batch.column(i).to_numpy() for i in range(2)] for batch in batches if batch.num_rows]
    if parts:
        nodes, least = smallest_ends(*map(np.concatenate, zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["node", "to"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of the edges ``a, b``; the component is its smallest node."""
    current = durable(edges.where("a != b").distinct())
    moves: list[DataFrame] = []
    while left := current.count():
        if left <= FEW_EDGES:
            moves.append(durable(current.select("a", "b").coalesce(1).mapInArrow(_collapsed, "node long, to long")))
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("x"))).alias("best"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("x"))
        moved = durable(least.select(F.col("a").alias("node"), F.least(own, F.col("best"))["x"].alias("to")))
        moves.append(moved)
        first = moved.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        second = moved.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        ends = current.join(first, "a").join(second, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        current = durable(ends.where("a != b").distinct())
    if not moves:
        return current.select(F.col("a").alias("node"), F.col("a").alias("component"))
    placed = moves[0]
    if left and len(moves) == 1:  # no round came before, so these are the smallest nodes
        return placed.withColumnRenamed("to", "component")
    for later in moves[1:]:
        step = later.select(F.col("node").alias("to"), F.col("to").alias("next"))
        placed = placed.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    placed = durable(placed)
    smallest = durable(placed.groupBy("to").agg(F.min("node").alias("component"), F.count("*").alias("n")))
    joined = attach(placed, smallest, "to", "n", placed.count(), "node")
    return joined.select("node", "component")
