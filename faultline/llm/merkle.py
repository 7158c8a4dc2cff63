"""Merkle manifest of a table: one tree per language, their roots below one root, a proof per row.

A leaf is the digest of a row's fields. Rows of a language stand in order of their id; every ``ARITY`` consecutive nodes become
one node of the next level until one is left, the subroot, and the subroots of all languages are reduced alike.

A superblock is ``ARITY ** DEPTH`` consecutive nodes, so its subtree can be built without any other. The way up exchanges
one top node per superblock, and that again until a tree has one node; the way down hands each superblock the nodes outside it
that its proofs need: the others of each run on the path from its top to the root. In one cogroup by superblock, rows meet those
outer nodes, and the local levels, the proofs and the folding of (tampered) leaves are finished together. No task holds more than
one superblock, and what is exchanged is one row per superblock.

Defined cases: null fields are written ``-``, so a null differs from an empty text; rows without an id come first within
their language and are never tampered with; rows without a language form a tree of their own, the first; rows of equal ids go by
their leaf, and equal rows are leaves of their own that may stand for each other; a language of one row has its leaf as
subroot, and with a single language the subroot is the root; a proof without siblings is the digest of no bytes; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.plans.durable import durable
from faultline.plans.ordering import position
from faultline.plans.sizing import measured_side

ARITY = 8
DEPTH = 4  # levels of a superblock
BLOCK = ARITY**DEPTH
TAMPERED = 3  # one row in so many
HEX = 64  # length of a digest as text
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<place: int, others: string>>"
PLACED = f"tree string, pos long, root string, path {PATH}"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row's fields, as bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def subtree(nodes: list[str], n: int) -> list[list[str]]:
    """The levels above consecutive ``nodes`` of a tree that has ``n`` nodes on theirs; a superblock of a larger tree has all of its."""
    levels = [nodes]
    while len(levels) <= DEPTH if n > BLOCK else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[int, str]]:
    """Per level below the top: the node's place in its run, and the others of the run, joined."""
    out = []
    for level in levels[:-1]:
        start = at - at % ARITY
        out.append((at - start, "".join(level[start:at] + level[at + 1 : start + ARITY])))
        at //= ARITY
    return out


def folded(node: str, path: list[tuple[int, str]]) -> str:
    """The top that follows from a node and the others on its way."""
    for place, others in path:
        node = digest(others[: place * HEX] + node + others[place * HEX :])
    return node


def _hexes(column: pd.Series) -> list[str]:
    return [bytes(b).hex() for b in column]


def _path(cell) -> list[tuple[int, str]]:
    return [(int(p["place"]), p["others"]) for p in cell]


def _top(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    top = subtree(_hexes(nodes["node"]), int(nodes["n"].iloc[0]))[-1][0]
    first = nodes.iloc[0]
    n = -(-int(first["n"]) // BLOCK)
    return pd.DataFrame({"tree": [first["tree"]], "n": [n], "pos": [first["pos"] // BLOCK], "node": [bytes.fromhex(top)]})


def _node_paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    if nodes.empty:
        return pd.DataFrame({"tree": [], "pos": [], "root": [], "path": []})
    nodes = nodes.sort_values("pos")
    levels = subtree(_hexes(nodes["node"]), int(nodes["n"].iloc[0]))
    rest, root = _path(outer["path"].iloc[0]), outer["root"].iloc[0]
    paths = [
        [{"place": place, "others": others} for place, others in siblings(levels, i) + rest] for i in range(len(nodes))
    ]
    return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], "root": root, "path": paths})


def _proofs(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Local levels, proofs and folding of one superblock."""
    if leaves.empty:
        return pd.DataFrame({c.split()[0]: [] for c in RESULT.split(", ")})
    leaves = leaves.sort_values("pos")
    nodes = _hexes(leaves["node"])
    levels = subtree(nodes, int(leaves["n"].iloc[0]))
    rest = _path(outer["path"].iloc[0])
    tail = "".join(others for _, others in rest)
    proofs, tops = [], []
    for i, (node, changed) in enumerate(zip(nodes, leaves["changed"], strict=True)):
        local = siblings(levels, i)
        proofs.append(digest("".join([others for _, others in local]) + tail))
        tops.append(folded(node if changed is None else bytes(changed).hex(), local + rest))
    root = outer["root"].iloc[0]
    return pd.DataFrame(
        {
            "doc_id": leaves["doc_id"].astype("Int64"),
            "leaf": nodes,
            "subroot": outer["subroot"].iloc[0],
            "root": root,
            "proof_sha256": proofs,
            "folded_root": tops,
            "verified": [t == root for t in tops],
        }
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))


def tops(nodes: DataFrame) -> DataFrame:
    """``tree, n, pos, node`` of the next nodes exchanged: one per superblock of ``nodes``."""
    return durable(
        _blocks(nodes.select("tree", "n", "pos", "node"))
        .groupBy("tree", "block")
        .applyInPandas(_top, "tree string, n long, pos long, node binary")
    )


def paths(nodes: DataFrame, largest: int) -> DataFrame:
    """``tree, pos, root, path`` of every node, in trees of at most ``largest`` nodes on their level."""
    if largest <= 1:
        return nodes.select("tree", "pos", F.lower(F.hex("node")).alias("root"), F.array().cast(PATH).alias("path"))
    outer = paths(tops(nodes), -(-largest // BLOCK))
    # The same names on both sides would be one table's columns.
    outer = outer.select(F.col("tree").alias("of"), F.col("pos").alias("at"), "root", "path")
    met = _blocks(nodes).groupBy("tree", "block").cogroup(outer.groupBy("of", "at"))
    return durable(met.applyInPandas(_node_paths, PLACED))


def manifest(df: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: its leaf, the subroot of its language, the root, the digest of its proof, and what its tampered form folds to."""
    tampered = F.crc32(F.col(key).cast("string")) % TAMPERED == 0
    lowered = [F.translate(F.col(f), UPPER, LOWER) if f == text else F.col(f) for f in fields]
    changes = tampered & (F.translate(F.col(text), UPPER, LOWER) != F.col(text))
    # Written once: digests take the place of texts, and row numbers part equal rows for good.
    leaves = durable(
        df.select(
            F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("tree"),
            F.col(key).cast("long").alias("doc_id"),
            leaf(*[F.col(f) for f in fields]).alias("node"),
            F.when(changes, leaf(*lowered)).alias("changed"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sizes = durable(leaves.groupBy("tree").agg(F.count("*").alias("n")))
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is None:
        return leaves.sparkSession.createDataFrame([], RESULT)
    order = [F.asc_nulls_first("doc_id"), F.asc("node"), F.asc("row")]
    placed = position(leaves, order, "pos", ["tree"]).drop("row")
    nodes = durable(placed.join(measured_side(sizes), "tree"))

    upper = paths(tops(nodes), -(-largest // BLOCK))
    subroots = upper.where("pos = 0").select(F.col("tree").alias("name"), F.unhex("root").alias("node"))
    trees = durable(position(subroots, [F.asc("name")], "pos"))
    n = trees.count()
    joint = paths(trees.select(F.lit("").alias("tree"), F.lit(n).cast("long").alias("n"), "pos", "node"), n)
    last = joint.select("pos", F.col("root").alias("whole"), F.col("path").alias("above"))
    above = durable(trees.select("name", "pos").join(last, "pos").drop("pos"))
    outer = upper.join(measured_side(above), F.col("tree") == F.col("name")).select(
        F.col("tree").alias("of"),
        F.col("pos").alias("at"),
        F.col("root").alias("subroot"),
        F.col("whole").alias("root"),
        F.concat("path", "above").alias("path"),
    )
    met = _blocks(nodes).groupBy("tree", "block").cogroup(outer.groupBy("of", "at"))
    return met.applyInPandas(_proofs, RESULT)
