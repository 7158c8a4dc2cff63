"""Catalogue classification, vector search and the vector table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from faultline.functions.vectors import dot, unit
from faultline.operators.joins import applicable
from faultline.operators.reports import top_per_group
from faultline.plans.durable import durable
from faultline.plans.ordering import position
from faultline.plans.sizing import is_small, measured_side

SCORE_DIGITS = 9  # scores are rounded before ranking, so that ties do not depend on summation order
MAX_CATALOGUE_ROWS = 10_000
MAX_CATALOGUE_BYTES = 64 << 20
SCORED_ROWS = 2_048  # tickets of one matrix product
MAX_QUERY_ROWS = 5_000
MAX_QUERY_BYTES = 32 << 20
QUESTION_BLOCK = 2_048
QUESTION_CHUNK = 256
ROW_BLOCK = 16_384


def score_pairs(
    tickets: DataFrame, catalogue: DataFrame, key: str, vector: str = "vector"
) -> DataFrame:
    """Every applicable ``(ticket, error)`` pair with its cosine, tickets without one kept.

    ``tickets`` has ``CAR3``, ``CAR2`` and a vector; ``catalogue`` has ``ID_ERROR``,
    ``CODCAR3``, ``CODCAR2``, ``catalogue_pos`` and a vector.
    """
    left = tickets.select(key, "CAR3", "CAR2", unit(vector).alias("__t"))
    right = catalogue.select(
        "ID_ERROR", "catalogue_pos", "CODCAR3", "CODCAR2", unit(vector).alias("__c")
    )
    if is_small(right, MAX_CATALOGUE_ROWS):
        right = F.broadcast(right)
    pairs = left.join(right, applicable("CAR3", "CAR2", "CODCAR3", "CODCAR2"), "left")
    return pairs.select(
        key, "ID_ERROR", "catalogue_pos", F.round(dot("__t", "__c"), SCORE_DIGITS).alias("score")
    )


def classify(
    tickets: DataFrame,
    catalogue: DataFrame,
    key: str,
    vector: str = "vector",
    keep: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """Best applicable error per ticket; ties go to the first catalogue row.

    A catalogue of checked rows and bytes travels to the tasks, its entries of a family as one matrix; each batch of
    tickets is one matrix product per family, without a shuffle. A larger one is joined by family and reduced per
    ticket row, with the same result.

    ``compat`` also lets inapplicable errors compete with score 0, as a table with
    one zero-filled column per error does.
    """
    entries = catalogue.select(
        "ID_ERROR", F.col("catalogue_pos").cast("long").alias("pos"), F.col("CODCAR3").alias("family"),
        F.col("CODCAR2").cast("long").alias("system"), F.col("vector").cast("array<double>").alias("v"),
    )
    size = F.coalesce(F.size("v"), F.lit(0)) * 8 + 64
    if not is_small(entries, MAX_CATALOGUE_ROWS) or (entries.agg(F.sum(size)).first()[0] or 0) > MAX_CATALOGUE_BYTES:
        return _classify_large(tickets, catalogue, key, vector, keep, compat)
    rows = entries.toPandas()  # at most MAX_CATALOGUE_ROWS rows and MAX_CATALOGUE_BYTES
    names = list(dict.fromkeys([key, *keep]))
    chosen = tickets.select(
        *names, F.col("CAR3").alias("__family"), F.col("CAR2").cast("long").alias("__system"),
        F.col(vector).cast("array<double>").alias("__vector"),
    )
    schema = T.StructType(
        [chosen.schema[n] for n in names]
        + [T.StructField("ID_ERROR", catalogue.schema["ID_ERROR"].dataType), T.StructField("score", T.DoubleType())]
    )
    ids = pa.array(rows["ID_ERROR"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = _Catalogue(rows, compat)
        for batch in batches:
            for start in range(0, batch.num_rows, SCORED_ROWS):
                part = batch.slice(start, SCORED_ROWS)
                best, score = matrices.best(*(part.column(c) for c in ("__family", "__system", "__vector")))
                none = best < 0
                found = ids.take(pa.array(np.maximum(best, 0), mask=none)) if len(ids) else pa.nulls(len(best), pa.string())
                columns = [*(part.column(n) for n in names), found, pa.array(score, mask=none)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "ID_ERROR", "score"])

    return chosen.mapInArrow(run, schema)


def _vector_matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the commonest length as a matrix, and the rows that have one; the others are zero there."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    whole = np.zeros(len(sizes), bool)
    if not (sizes >= 0).any():
        return np.zeros((len(sizes), 0)), whole
    lengths, counts = np.unique(sizes[sizes >= 0], return_counts=True)
    width = lengths[np.argmax(counts)]
    usable = np.flatnonzero(sizes == width)
    flat = column.take(pa.array(usable)).flatten().to_numpy(zero_copy_only=False).reshape(len(usable), width)
    full = ~np.isnan(flat).any(axis=1)
    out = np.zeros((len(sizes), width))
    out[usable[full]] = _unit_rows(flat[full])
    whole[usable[full]] = True
    return out, whole


class _Catalogue:
    """Entries in catalogue order, and a matrix of unit vectors for those of each family."""

    def __init__(self, rows: pd.DataFrame, compat: bool) -> None:
        self.compat = compat
        self.rows = rows
        # Of entries at one place the greatest id wins, as the first of the highest scores is taken.
        self.ranked = rows.sort_values("ID_ERROR", ascending=False, kind="stable").sort_values("pos", kind="stable").index.to_numpy()
        self.place = np.empty(len(rows), np.int64)
        self.place[self.ranked] = np.arange(len(rows))
        matrix, usable = _vector_matrix(pa.array(rows["v"], pa.list_(pa.float64())))
        self.width = matrix.shape[1]
        families = rows["family"].to_numpy()
        self.of_family = {}
        for family in pd.unique(rows["family"].dropna()):
            members = self.ranked[families[self.ranked] == family]
            scored = members[usable[members]]
            self.of_family[family] = members, scored, matrix[scored].T
        system = rows["system"]
        self.system = system.fillna(-1).to_numpy(np.int64)
        self.no_system = system.isna().to_numpy()
        firsts = rows.loc[self.ranked].drop_duplicates("ID_ERROR")
        self.errors = firsts.sort_values(["pos", "ID_ERROR"], kind="stable").index.to_numpy()
        self.rivals: dict[tuple, int] = {}

    def rival(self, family, system: int | None) -> int:
        """The first error that does not apply to the family and system, -1 if all do."""
        if (family, system) not in self.rivals:
            members = self.of_family.get(family, (np.zeros(0, np.int64),))[0]
            own = set(self.rows["ID_ERROR"].iloc[members[self.fits(members, system)]])
            ids = self.rows["ID_ERROR"]
            self.rivals[family, system] = next((int(e) for e in self.errors if ids.iat[e] not in own), -1)
        return self.rivals[family, system]

    def fits(self, members: np.ndarray, system: int | None) -> np.ndarray:
        own = self.system[members]
        return ~self.no_system[members] & ((own == 0) | (False if system is None else own == system))

    def best(self, families: pa.Array, systems: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each ticket the row of its best entry, -1 for none, and the score."""
        n = len(families)
        best, score = np.full(n, -1), np.zeros(n)
        matrix, usable = _vector_matrix(vectors)
        family_of, system_of = families.to_pylist(), systems.to_pylist()
        groups: dict[tuple, list[int]] = {}
        for i, group in enumerate(zip(family_of, system_of, strict=True)):
            groups.setdefault(group, []).append(i)
        by_family: dict[object, list[tuple]] = {}
        for group in groups:
            by_family.setdefault(group[0], []).append(group)
        for family, members in by_family.items():
            _, scored, packed = self.of_family.get(family, (None, np.zeros(0, np.int64), None))
            for _, system in members:
                rows = np.array(groups[family, system])
                rows = rows[usable[rows]]
                fitting = np.flatnonzero(self.fits(scored, system))
                if len(rows) and len(fitting) and matrix.shape[1] == self.width:
                    scores = np.round(matrix[rows] @ packed[:, fitting], SCORE_DIGITS)
                    at = scores.argmax(axis=1)  # the first of equal ones stands first in the catalogue
                    best[rows], score[rows] = scored[fitting[at]], scores[np.arange(len(rows)), at]
                if self.compat and (rival := self.rival(family, system)) >= 0:
                    every = np.array(groups[family, system])
                    ahead = (score[every] == 0) & (self._before(rival, best[every]))
                    loses = (best[every] < 0) | (score[every] < 0) | ahead
                    best[every[loses]], score[every[loses]] = rival, 0.0
        return best, score

    def _before(self, rival: int, best: np.ndarray) -> np.ndarray:
        return self.place[rival] < self.place[np.maximum(best, 0)]


def _classify_large(
    tickets: DataFrame, catalogue: DataFrame, key: str, vector: str, keep: Sequence[str], compat: bool
) -> DataFrame:
    """``classify`` through a join; rows are told apart by a number, as keys may repeat."""
    columns = dict.fromkeys([key, "CAR3", "CAR2", vector, *keep])
    rows = durable(tickets.select(*columns).withColumn("__row", F.monotonically_increasing_id()))
    pairs = score_pairs(rows, catalogue, "__row", vector).select("__row", "score", "catalogue_pos", "ID_ERROR")
    if compat:
        rivals = _first_inapplicable(rows, catalogue)
        same = rows["CAR3"].eqNullSafe(rivals["__family"]) & rows["CAR2"].eqNullSafe(rivals["__system"])
        zeros = rows.join(measured_side(rivals), same).select(
            "__row", F.lit(0.0).alias("score"), F.col("pos").alias("catalogue_pos"), "ID_ERROR"
        )
        pairs = pairs.unionByName(zeros)
    winner = F.max(F.struct("score", -F.col("catalogue_pos"), "ID_ERROR"))
    best = pairs.where("score is not null").groupBy("__row").agg(winner.alias("__b"))
    best = best.select("__row", F.col("__b.ID_ERROR"), F.col("__b.score"))
    return rows.select("__row", key, *keep).join(best, "__row", "left").drop("__row")


def _first_inapplicable(tickets: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Per family and system of the tickets, the first error that does not apply to them.

    Errors are numbered in catalogue order. Those that apply are numbered again, and the
    first of the others comes after the last of them up to which both numbers agree.
    """
    every = catalogue.groupBy("ID_ERROR").agg(F.min("catalogue_pos").alias("pos"))
    every = durable(position(every, [F.col("pos"), F.col("ID_ERROR")], "__place"))
    groups = tickets.select(F.col("CAR3").alias("__family"), F.col("CAR2").alias("__system")).distinct()
    entries = catalogue.select("ID_ERROR", "CODCAR3", "CODCAR2")
    own = groups.join(entries, applicable("__family", "__system", "CODCAR3", "CODCAR2"))
    own = own.select("__family", "__system", "ID_ERROR").distinct().join(every, "ID_ERROR")
    in_order = Window.partitionBy("__family", "__system").orderBy("__place")
    agrees = F.count_if(F.col("__place") == F.col("__rank")).alias("__place")
    leading = own.withColumn("__rank", F.row_number().over(in_order) - 1).groupBy("__family", "__system").agg(agrees)
    none = groups.withColumn("__place", F.lit(0))
    places = leading.unionByName(none).groupBy("__family", "__system").agg(F.max("__place").alias("__place"))
    return places.join(every, "__place").select("__family", "__system", "ID_ERROR", "pos")


def top_per_error(classified: DataFrame, n: int, key: str, error: str = "ID_ERROR") -> DataFrame:
    """The ``n`` best scored tickets of each error."""
    return top_per_group(
        classified.where(F.col(error).isNotNull()), error, [F.desc("score"), F.asc(key)], n
    )


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _best_rows(score: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by key."""
    rows = np.arange(len(score))
    if len(rows) > k:
        rows = rows[score >= np.partition(score, -k)[-k]]
    return rows[np.lexsort((keys[rows], -score[rows]))][:k]


class _Best:
    """The ``k`` best rows seen so far for one question."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.floor = -np.inf
        self.rows: pa.Table | None = None

    def add(self, rows: pa.RecordBatch, score: np.ndarray, keys: np.ndarray) -> None:
        best = _best_rows(score, keys, self.k)
        found = pa.Table.from_batches([rows.take(pa.array(best))])
        found = found.append_column("score", pa.array(score[best]))
        if self.rows is not None:
            found = pa.concat_tables([self.rows, found])
            order = _best_rows(found["score"].to_numpy(), found.column(0).to_numpy(), self.k)
            found = found.take(pa.array(order))
        self.rows = found
        if found.num_rows == self.k:
            self.floor = found["score"][-1].as_py()


def _nearest_in_tasks(
    collection: DataFrame,
    asked: pd.DataFrame,
    key: str,
    vector: str,
    family: str | None,
    payload: Sequence[str],
    k: int,
) -> DataFrame:
    """The ``k`` best rows of every task per question, by one matrix product per batch and family."""
    questions = _unit_rows(np.array(asked["vector"].tolist(), dtype=np.float64))
    ids = asked["query_id"].to_numpy()
    groups = (
        [(value, rows.to_numpy()) for value, rows in asked.groupby("family").groups.items()]
        if family
        else [(None, np.arange(len(ids)))]
    )
    kept = [key, *payload]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [_Best(k) for _ in ids]
        for batch in batches:
            batch = batch.filter(batch.column(vector).is_valid())
            if not batch.num_rows:
                continue
            flat = batch.column(vector).flatten().to_numpy(zero_copy_only=False)
            vectors = _unit_rows(flat.astype(np.float64).reshape(batch.num_rows, -1))
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            rows = batch.select(kept)
            families = batch.column(family).to_numpy(zero_copy_only=False) if family else None
            for value, chosen in groups:
                members = slice(None)
                if family is not None:
                    members = np.flatnonzero(families == value)
                    if not len(members):
                        continue
                    rows = batch.select(kept).take(pa.array(members))
                scores = np.round(vectors[members] @ questions[chosen].T, SCORE_DIGITS)
                for column, question in enumerate(chosen):
                    score, best = scores[:, column], state[question]
                    # An equal score may still win by its key.
                    if score.max() >= best.floor:
                        best.add(rows, score, keys[members])
        for question, best in zip(ids, state):
            if best.rows is not None:
                asker = pa.array(np.full(best.rows.num_rows, question))
                yield from best.rows.add_column(0, "query_id", asker).to_batches()

    fields = [T.StructField("query_id", asked.attrs["query_type"])]
    fields += [T.StructField(c, collection.schema[c].dataType) for c in kept]
    fields += [T.StructField("score", T.DoubleType())]
    columns = [*kept, vector, *([family] if family and family not in kept else [])]
    return collection.select(*columns).mapInArrow(run, T.StructType(fields))


def nearest(
    collection: DataFrame,
    queries: DataFrame,
    k: int,
    key: str,
    vector: str = "vector",
    family: str | None = None,
    payload: Sequence[str] = (),
) -> DataFrame:
    """``(query_id, key, payload, score, rank)``: the ``k`` rows of highest cosine per question.

    ``queries`` has ``query_id``, ``vector`` and, when ``family`` names a column of
    the collection, ``family``. Questions of checked rows and bytes travel to the tasks, and rows stay where they are:
    each task keeps its own best ``k``, so the shuffle carries at most ``k`` rows per question and task. More
    questions meet the rows in blocks, by one shuffle of both. Vectors have one length.
    """
    columns = ["query_id", "vector", *(["family"] if family else [])]
    queries = queries.select(*columns).where(F.col("vector").isNotNull())
    size = F.size("vector") * 8 + 64
    if is_small(queries, MAX_QUERY_ROWS) and (queries.agg(F.sum(size)).first()[0] or 0) <= MAX_QUERY_BYTES:
        asked = queries.toPandas()  # at most MAX_QUERY_ROWS rows and MAX_QUERY_BYTES
        if asked.empty:
            asker = F.lit(None).cast(queries.schema["query_id"].dataType).alias("query_id")
            found = collection.where("1 = 0").select(asker, key, *payload, F.lit(0.0).alias("score"))
        else:
            asked.attrs["query_type"] = queries.schema["query_id"].dataType
            source = collection
            if family:
                source = collection.where(F.col(family).isin(*asked["family"].unique().tolist()))
            found = _nearest_in_tasks(source, asked, key, vector, family, payload, k)
    else:
        found = _nearest_of_blocks(collection, queries, key, vector, family, payload, k)
    return top_per_group(found, "query_id", [F.desc("score"), F.asc(key)], k)


def _nearest_of_blocks(
    collection: DataFrame, queries: DataFrame, key: str, vector: str, family: str | None, payload: Sequence[str], k: int
) -> DataFrame:
    """The ``k`` best rows per question of every pair of blocks: questions and rows of a family meet by a shuffle.

    Both sides are dealt into blocks by hash, as many as their family's size asks for, so that a large family is many groups. Only the
    sizes of families are collected into the plan, and a table stored by family is read for the families asked about.
    """
    none = F.lit(0).alias("family")
    asked = queries.select("query_id", "vector", F.col("family") if family else none).where("family is not null")
    asked = durable(asked)
    kept = list(dict.fromkeys([key, *payload]))
    rows = collection.where(F.col(vector).isNotNull()).select(
        *[F.col(c).alias(f"__r{i}") for i, c in enumerate(kept)],
        F.col(vector).cast("array<double>").alias("__v"),
        F.col(family).alias("__f") if family else F.lit(0).alias("__f"),
    )
    sizes = asked.groupBy("family").agg(F.ceil(F.count("*") / QUESTION_BLOCK).alias("asking")).where("asking > 0")
    held = rows.drop("__v").join(measured_side(sizes.withColumnRenamed("family", "__f")), "__f").groupBy("__f").agg(
        F.ceil(F.count("*") / ROW_BLOCK).alias("holding"), F.first("asking").alias("asking")
    )
    # The filter lets Spark prune the folders of other families by what it broadcasts.
    blocks = durable(held).where("holding > 0")
    left = asked.join(measured_side(blocks), F.col("family") == F.col("__f")).select(
        F.col("__f").alias("f"), F.pmod(F.xxhash64("query_id"), F.col("asking")).alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("holding") - 1)).alias("b"), "query_id", F.col("vector").cast("array<double>").alias("vector"),
    )
    dealt = F.pmod(F.xxhash64("__r0", "__v"), F.col("holding")).alias("__b")
    right = rows.join(measured_side(blocks), "__f").select(
        "__f", dealt, F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1)).alias("__a"), "__v", *[f"__r{i}" for i in range(len(kept))]
    )

    def run(questions: pa.Table, members: pa.Table) -> pa.Table:
        found = []
        if questions.num_rows and members.num_rows:
            q = _unit_rows(_stack(questions["vector"]))
            ids, keys = questions["query_id"], members["__r0"].to_numpy()
            passing = members.select([f"__r{i}" for i in range(len(kept))])
            vectors = _unit_rows(_stack(members["__v"]))
            for start in range(0, len(q), QUESTION_CHUNK):
                scores = np.round(q[start : start + QUESTION_CHUNK] @ vectors.T, SCORE_DIGITS)
                picked = [_best_rows(row, keys, k) for row in scores]
                asker = np.repeat(np.arange(start, start + len(picked)), [len(p) for p in picked])
                at = np.concatenate(picked)
                part = passing.take(pa.array(at)).add_column(0, "query_id", ids.take(pa.array(asker)))
                found.append(part.append_column("score", pa.array(scores[asker - start, at])))
        return pa.concat_tables(found).rename_columns(names) if found else empty

    names = ["query_id", *kept, "score"]
    fields = [T.StructField("query_id", queries.schema["query_id"].dataType)]
    fields += [T.StructField(c, collection.schema[c].dataType) for c in kept]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    empty = to_arrow_schema(schema).empty_table()
    met = left.groupBy("f", "a", "b").cogroup(right.groupBy("__f", "__a", "__b"))
    return met.applyInArrow(run, schema)


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def search_errors(
    collection: DataFrame,
    queries: DataFrame,
    key: str,
    error: str = "error",
    family: str | None = "family",
    vector: str = "embedding",
    depth: int = 20,
    shown: int | None = None,
) -> DataFrame:
    """Best score per error among the ``depth`` nearest rows of a family, best first.

    The depth applies before the grouping, so one error may fill it.
    """
    hits = nearest(collection, queries, depth, key, vector, family, [error])
    best = hits.groupBy("query_id", error).agg(F.max("score").alias("score"))
    if shown is None:
        return best
    return top_per_group(best, "query_id", [F.desc("score"), F.asc(error)], shown)


def write_vectors(
    df: DataFrame, path: str, vector: str = "embedding", family: str = "family", mode: str = "overwrite"
) -> None:
    """Vector table: unit vectors with their payload columns, one folder per family.

    Adaptive execution merges the rows of small families and splits a large one, so
    that files are of even size.
    """
    scaled = df.withColumn(vector, F.transform(unit(vector), lambda x: x.cast("float")))
    scaled.hint("rebalance", family).write.mode(mode).partitionBy(family).parquet(path)
