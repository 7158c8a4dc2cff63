"""Quality by a generalised additive model with pairwise interactions.

The log odds of a good text are a sum of lookup tables: one per feature, over bins of it, and one per chosen pair of features, over
cells of two coarser binnings. Tables are learned by cyclic boosting: round after round, every feature in turn gets one
shallow tree on the gradients that the sum of all tables leaves, shrunk by ``RATE``; as a tree on one feature only cuts its range, it
is added to the feature's table, and trees need not be kept. Then the pairs whose best four quadrants explain most of what is
left are boosted the same way. A text is scored by finding its bins and adding table entries, for many texts at once.

Features are figures of the whole text (``text_stats``). Labels are used only where ``crc32`` of the id as text, modulo 4,
is not 2, and of at most ``MAX_ROWS`` ids and ``MAX_ROWS`` distinct rows of figures, chosen by hash; label, language, source and id are never inputs
of a score. Bin borders are quantiles of the training rows.

Defined cases: a null or empty text has no words and all figures 0, and is scored as such; a null id is not held out and not trained
on; of several labels of one id the lowest counts, for all of its rows; with labels of one kind only, the score is
their smoothed share for all texts, and 0.5 without labels; equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.batches import slices
from faultline.llm.text_stats import FEATURES, text_stats
from faultline.llm.toxicity import sigmoid

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
MAX_ROWS = 20_000
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS = 200, 100
PAIRS = 6
LEAVES = 3
RATE = 0.1
RIDGE = 2.0  # added to the curvature of a leaf
MIN_CURVATURE = 1.0  # of a leaf


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def borders(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between distinct values, by quantiles."""
    cuts = np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)
    return cuts


def binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, "right")


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= MIN_CURVATURE, g * g / (h + RIDGE), -np.inf)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins; the cut stands before the place."""
    if len(g) < 2:
        return -np.inf, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step per bin of a tree over one feature, grown best leaf first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*best_cut(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts)]
        gain, at, i = max(cuts)
        if gain <= 0:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree of depth two over a grid: a cut of one axis, then one of the other on each side."""
    best, step = -np.inf, np.zeros(g.shape)
    base = g.sum() ** 2 / (h.sum() + RIDGE)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        top_g, top_h = np.cumsum(a, axis=0)[:-1], np.cumsum(b, axis=0)[:-1]
        sides = []
        for side_g, side_h in ((top_g, top_h), (a.sum(axis=0) - top_g, b.sum(axis=0) - top_h)):
            # Every row is one first cut; its columns are cut again.
            left_g, left_h = np.cumsum(side_g, axis=1)[:, :-1], np.cumsum(side_h, axis=1)[:, :-1]
            all_g, all_h = side_g.sum(axis=1, keepdims=True), side_h.sum(axis=1, keepdims=True)
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
            whole = _gain(all_g, all_h)
            gains = np.concatenate([whole, gains], axis=1)  # place 0: no second cut
            sides.append((gains.max(axis=1), gains.argmax(axis=1)))
        if not len(top_g):
            continue
        total = sides[0][0] + sides[1][0] - base
        at = int(np.argmax(total))
        if total[at] > best:
            best = float(total[at])
            step = np.zeros(a.shape)
            for rows, (_, cut) in zip((slice(0, at + 1), slice(at + 1, None)), sides, strict=True):
                for columns in (slice(0, cut[at]), slice(cut[at], None)):
                    part = b[rows, columns].sum()
                    step[rows, columns] = a[rows, columns].sum() / (part + RIDGE)
            step = step if axis == 0 else step.T
    return best, step


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def margin(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.intercept)
        for column, cuts, table in zip(features.T, self.cuts, self.tables, strict=True):
            total += table[binned(column, cuts)]
        coarse = [binned(column, cuts) for column, cuts in zip(features.T, self.pair_cuts, strict=True)]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return total


def _grid(first: np.ndarray, second: np.ndarray, shape: tuple[int, int], weights: np.ndarray) -> np.ndarray:
    return np.bincount(first * shape[1] + second, weights, shape[0] * shape[1]).reshape(shape)


def fit(features: np.ndarray, good: np.ndarray) -> Model:
    """Tables by cyclic boosting of the logistic loss; ``good`` is 0 or 1."""
    width = features.shape[1]
    share = (good.sum() + 1) / (len(good) + 2)
    cuts = [borders(column, BINS) for column in features.T]
    pair_cuts = [borders(column, PAIR_BINS) for column in features.T]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    model = Model(float(np.log(share / (1 - share))), cuts, tables, pair_cuts, [], [])
    if not 0 < good.sum() < len(good):
        return model
    bins = [binned(column, c) for column, c in zip(features.T, cuts, strict=True)]
    margin = np.full(len(good), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(margin)
        return good - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = RATE * tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            tables[j] += step
            margin += step[bins[j]]
    coarse = [binned(column, c) for column, c in zip(features.T, pair_cuts, strict=True)]
    shapes = {(i, j): (len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1) for i, j in combinations(range(width), 2)}

    def grown(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        g, h = slopes()
        first, second = coarse[pair[0]], coarse[pair[1]]
        return pair_tree(_grid(first, second, shapes[pair], g), _grid(first, second, shapes[pair], h))

    gains = sorted(((-grown(pair)[0], pair) for pair in shapes))
    model.pairs = [pair for gain, pair in gains[:PAIRS] if gain < 0]
    model.pair_tables = [np.zeros(shapes[pair]) for pair in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * grown((i, j))[1]
            table += step
            margin += step[coarse[i], coarse[j]]
    return model


def _stats(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                packed = [row.tobytes() for row in text_stats(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], ["good", "stats"])

    return texts.mapInArrow(run, "good int, stats binary")


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model | None:
    """The model, or None without a labelled text. At most ``max_rows`` ids, and as many rows, are trained on."""
    known = labels.where(F.col(key).isNotNull() & ~held_out(key) & F.col(quality).isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg(F.min(quality).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    # A labelled id may have many rows: equal figures count once, and at most ``max_rows`` rows are taken, by their hash.
    figures = _stats(texts.select("good", "text")).distinct()
    rows = figures.orderBy(F.xxhash64("stats", "good"), "stats", "good").limit(max_rows).toArrow()
    if not rows.num_rows:
        return None
    features = np.array([np.frombuffer(s.as_py(), np.float64) for s in rows.column("stats")])
    good = rows.column("good").to_numpy().astype(float)
    # The order of collected rows must not matter.
    order = np.lexsort((good, *features.T))
    return fit(features[order], good[order])


def score(text: Column, model: Model | None) -> Column:
    """Score of each text, from 0 to 1, higher for better ones."""
    if model is None:
        return F.lit(0.5)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.Array.from_pandas(texts, type=pa.string())], ["text"])
            scores = [sigmoid(model.margin(text_stats(part.column(0)))) for part in slices(batch, 0)]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text)


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per document: id, ``held_out``, ``score``, ``predicted``."""
    model = train(docs, labels, key, text, label)
    scored = docs.select(F.col(key), held_out(key).alias("held_out"), score(F.col(text), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
