"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over hashed words and word beginnings. It learns from texts confirmed as toxic and
from unlabelled texts, in which some are toxic too. With the class prior ``p`` and the loss ``l`` the risk is

    p * E_pos[l(z)] + max(0, E_unl[l(-z)] - p * E_pos[l(-z)])

whose second part estimates the risk on clean texts; when it falls below zero, which only overfitting can
cause, the step goes the other way. The prior is the share of toxic rows among all labels of the
training folds.

Labels are used only where ``crc32`` of the id as text, modulo 5, is not 0. Training takes at most
``MAX_POSITIVE`` confirmed and ``MAX_UNLABELLED`` unlabelled texts, chosen by a hash of their id; every text is scored.
Label, language, source and id are never inputs of a score.

Defined cases: a null or empty text has no words and gets the score of the intercept; a null id is not held
out and not trained on; several labels of one id count as toxic if one is; without a confirmed toxic
text every score is 0; equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.batches import slices
from faultline.llm.words import BY_LETTERS, word_hashes

FOLDS = 5
BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
MAX_POSITIVE = 2_000
MAX_UNLABELLED = 6_000
MIN_TEXTS = 3  # a feature needs as many confirmed texts,
MIN_SHARE = 0.005  # this share of them,
MIN_RATIO = 3.0  # and a share in them so many times that in unlabelled texts
MAX_FEATURES = 20_000
STEPS = 400
RATE = 0.05
DECAY = 1e-4
PUSH_BACK = 1.0


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def _buckets(texts: pa.Array) -> list[np.ndarray]:
    """Distinct feature buckets of each text."""
    counts, *hashes = word_hashes(texts, BY_LETTERS, PREFIXES)
    ends = np.cumsum(counts)
    numbers = [(h % np.uint64(BUCKETS)).astype(np.int32) for h in hashes]
    return [
        np.unique(np.concatenate([n[e - c : e] for n in numbers])) if c else np.zeros(0, np.int32)
        for c, e in zip(counts.tolist(), ends.tolist(), strict=True)
    ]


def _features(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                packed = [b.tobytes() for b in _buckets(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], ["positive", "buckets"])

    return texts.mapInArrow(run, "positive boolean, buckets binary")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


class Sparse:
    """Rows of distinct feature numbers."""

    def __init__(self, rows: list[np.ndarray], number_of: np.ndarray) -> None:
        numbered = [number_of[r] for r in rows]
        numbered = [n[n >= 0] for n in numbered]
        self.row = np.repeat(np.arange(len(rows)), [len(n) for n in numbered])
        self.column = np.concatenate(numbered) if numbered else np.zeros(0, np.int64)
        self.n = len(rows)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, slopes: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, slopes[self.row], width)


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Feature number of each bucket, -1 for the others.

    The features are the buckets that confirmed texts hold clearly more often than unlabelled ones, at most
    ``MAX_FEATURES`` of them, by count and log ratio. Words as common in both only add noise to long texts.
    """

    def share(rows: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        return np.bincount(every, minlength=BUCKETS)

    in_positive, in_unlabelled = share(positive), share(unlabelled)
    a = (in_positive + 0.5) / (len(positive) + 1)
    b = (in_unlabelled + 0.5) / (len(unlabelled) + 1)
    value = np.sqrt(in_positive) * np.log(a / b)
    enough = max(MIN_TEXTS, MIN_SHARE * len(positive))
    fitting = np.flatnonzero((in_positive >= enough) & (a >= MIN_RATIO * b))
    best = fitting[np.lexsort((fitting, -value[fitting]))][:MAX_FEATURES]
    number_of = np.full(BUCKETS, -1, np.int64)
    number_of[best] = np.arange(len(best))
    return number_of


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Weights of all buckets, the intercept last, by full-batch Adam on the non-negative risk."""
    number_of = choose_features(positive, unlabelled)
    width = int(number_of.max()) + 1
    pos, unl = Sparse(positive, number_of), Sparse(unlabelled, number_of)
    weights, intercept = np.zeros(width), -1.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        z_pos, z_unl = pos.times(weights) + intercept, unl.times(weights) + intercept
        # Sigmoid loss l(z) = sigmoid(-z); its slope is -s(z)(1 - s(z)).
        s_pos, s_unl = sigmoid(z_pos), sigmoid(z_unl)
        d_pos, d_unl = s_pos * (1 - s_pos) / pos.n, s_unl * (1 - s_unl) / max(unl.n, 1)
        clean = s_unl.mean() - prior * s_pos.mean() if unl.n else 0.0
        if clean >= 0:
            slope_pos, slope_unl = -2 * prior * d_pos, d_unl
        else:
            slope_pos, slope_unl = PUSH_BACK * prior * d_pos, -PUSH_BACK * d_unl
        gradient = np.append(
            pos.back(slope_pos, width) + unl.back(slope_unl, width) + DECAY * weights,
            slope_pos.sum() + slope_unl.sum(),
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        # The features were chosen as signs of toxicity: none may speak against it.
        weights = np.maximum(weights - move[:-1], 0)
        intercept -= move[-1]
    model = np.zeros(BUCKETS + 1)
    model[:-1][number_of >= 0] = weights[number_of[number_of >= 0]]
    model[-1] = intercept
    return model


def _fitted(prior: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``positive, buckets`` to one row with the weights of ``fit``, none without a confirmed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[bool, list[np.ndarray]] = {True: [], False: []}
        for batch in batches:
            for positive, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                groups[positive].append(np.frombuffer(packed, np.int32))
        if groups[True]:
            # The order in which rows come must not matter.
            ordered = [sorted(groups[wanted], key=lambda b: b.tobytes()) for wanted in (True, False)]
            yield pa.RecordBatch.from_arrays([pa.array([fit(*ordered, prior=prior).tobytes()], pa.binary())], ["model"])

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> np.ndarray | None:
    """The model, or None without a confirmed toxic text."""
    known = labels.where(F.col(key).isNotNull() & ~held_out(key) & F.col(toxic).isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg(F.max(toxic).alias("toxic"))
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    order = [F.xxhash64("id"), F.col("id")]
    confirmed = known.where("toxic = 1").orderBy(*order).limit(max_positive).select("id", F.lit(True).alias("positive"))
    trained = docs.where(F.col(key).isNotNull() & ~held_out(key))
    others = (
        trained.select(F.col(key).alias("id")).orderBy(*order).limit(max_unlabelled).select("id", F.lit(False).alias("positive"))
    )
    # At most max_positive + max_unlabelled rows.
    chosen = F.broadcast(confirmed.unionByName(others))
    texts = trained.select(F.col(key).alias("id"), F.col(text).alias("text")).join(chosen, "id")
    # The sets of long texts are large, so they meet in a task; the driver gets the model.
    features = _features(texts.select("positive", "text")).repartition(1)
    found = features.mapInArrow(_fitted(float(prior)), "model binary").collect()
    return np.frombuffer(found[0]["model"]).copy() if found else None


def score(text: Column, model: np.ndarray | None) -> Column:
    """Score of each text, from 0 to 1."""
    if model is None:
        return F.lit(0.0)
    used = np.flatnonzero(model[:-1])
    weights, intercept = model[used].astype(np.float64), float(model[-1])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.zeros(BUCKETS)
        table[used] = weights
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.Array.from_pandas(texts, type=pa.string())], ["text"])
            scores = [
                table[b].sum() for part in slices(batch, 0) for b in _buckets(part.column(0))
            ]
            yield pd.Series(sigmoid(np.array(scores, np.float64) + intercept))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted``."""
    model = train(docs, labels, key, text, toxic)
    scored = docs.select(F.col(key), held_out(key).alias("held_out"), score(F.col(text), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
