"""Fuzzy matching of free-typed codes to a catalogue by token-set similarity.

A pair is scored on the sorted distinct tokens of both texts. With ``I`` the shared
tokens, ``A`` and ``B`` the rest of each side, the score is 100 when ``I`` is not
empty and ``A`` or ``B`` is, else the best of ratio(I, I+A), ratio(I, I+B) and
ratio(I+A, I+B), where ratio = 200 * LCS / (length sum).

Spark reduces both sides to distinct token texts and spreads the codes. A task holds
one slice of the catalogue, of bounded size, and finds the best entry of each code
without emitting pairs: shared tokens come from an index, the longest common
subsequence is computed only where an upper bound still exceeds the best score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalars import col
from faultline.plans.durable import durable
from faultline.plans.sizing import is_small

MAX_CATALOGUE_SLICE = 50_000


def token_text(c: str | Column) -> Column:
    """Sorted distinct tokens of the lower-cased text, signs read as blanks."""
    words = F.split(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}_]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda t: t != ""))), " ")


def lcs_lengths(text: str, others: list[str]) -> np.ndarray:
    """Longest common subsequence of one text with each of many, row by row over all at once."""
    width = max(map(len, others), default=0)
    padded = "".join(other.ljust(width, "\0") for other in others).encode("utf-32-le")
    chars = np.frombuffer(padded, dtype=np.uint32).reshape(len(others), width)
    row = np.zeros((len(others), width + 1), dtype=np.int32)
    for ch in text:
        step = row[:, :-1] + (chars == ord(ch))
        row[:, 1:] = np.maximum.accumulate(np.maximum(step, row[:, 1:]), axis=1)
    return row[:, -1]


class _Slice:
    """Index of a catalogue slice: lengths, characters and entries per token."""

    def __init__(self, texts: list[str]) -> None:
        self.tokens = [frozenset(t.split(" ")) for t in texts]
        self.texts = texts
        self.lengths = np.array([len(t) for t in texts])
        self.counts = np.array([len(t) for t in self.tokens])
        by_token: dict[str, list[int]] = defaultdict(list)
        by_char: dict[str, np.ndarray] = {}
        for i, text in enumerate(texts):
            for token in self.tokens[i]:
                by_token[token].append(i)
            for ch, n in Counter(text).items():
                by_char.setdefault(ch, np.zeros(len(texts), dtype=np.int16))[i] = n
        self.by_token = {t: np.array(rows) for t, rows in by_token.items()}
        self.by_char = by_char

    def best(self, text: str) -> tuple[int, float]:
        """First entry of the highest score, and that score."""
        own = frozenset(text.split(" "))
        size = len(self.texts)
        shared, common = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for token in own & self.by_token.keys():
            rows = self.by_token[token]
            shared[rows] += 1
            common[rows] += len(token)
        inner = np.where(shared > 0, common + shared - 1, 0)
        subset = (shared > 0) & ((shared == len(own)) | (shared == self.counts))
        if subset.any():
            return int(np.flatnonzero(subset)[0]), 100.0
        # ratio of the shared tokens to either full side
        shorter = np.minimum(self.lengths, len(text))
        scores = np.where(shared > 0, 200.0 * inner / (inner + shorter), 0.0)
        # the characters both texts hold bound the common subsequence
        held = np.zeros(size, dtype=np.int64)
        for ch, n in Counter(text).items():
            if ch in self.by_char:
                held += np.minimum(self.by_char[ch], n)
        bound = 200.0 * held / (self.lengths + len(text))
        rows = np.flatnonzero(bound >= max(scores.max(initial=0.0), 1e-9))
        rows = rows[np.argsort(-bound[rows], kind="stable")]
        top = scores.max(initial=0.0)
        for start in range(0, len(rows), 64):
            part = rows[start : start + 64]
            part = part[bound[part] >= top]
            if not len(part):
                break
            lcs = self._rest_lcs(own, part) + inner[part] + (shared[part] > 0)
            scores[part] = np.maximum(
                scores[part], 200.0 * lcs / (self.lengths[part] + len(text))
            )
            top = max(top, scores[part].max())
        first = int(np.argmax(scores))
        return first, float(scores[first])

    def _rest_lcs(self, own: frozenset[str], rows: np.ndarray) -> np.ndarray:
        """LCS of what remains of both sides once the shared tokens, which lead both, are off."""
        groups: dict[frozenset[str], list[int]] = defaultdict(list)
        for i, row in enumerate(rows):
            groups[own - self.tokens[row]].append(i)
        result = np.zeros(len(rows), dtype=np.int64)
        for rest, members in groups.items():
            others = [" ".join(sorted(self.tokens[row] - own)) for row in rows[members]]
            result[members] = lcs_lengths(" ".join(sorted(rest)), others)
        return result


def best_matches(
    codes: DataFrame,
    catalogue: DataFrame,
    code: str = "cod_articulo",
    entry: str = "CODART",
    order: str = "catalogue_pos",
    match: str = "CODART_A3",
    score: str = "Fuzzy_Score",
) -> DataFrame:
    """``(code, match, score)`` for every distinct non-null code.

    The first catalogue entry of the highest score wins; scores are rounded to whole
    numbers afterwards. An empty code, or one without any similarity, has no match
    and score 0.
    """
    # Entries with the same tokens always score alike: the first stands for all.
    entries = durable(
        catalogue.where(F.col(entry).isNotNull())
        .groupBy(token_text(entry).alias("__text"))
        .agg(
            F.min(
                F.struct(F.col(order).cast("long").alias("pos"), F.col(entry).alias("entry"))
            ).alias("__e")
        )
        .where(F.col("__text") != "")
        .select("__text", "__e.*")
    )
    slices = [entries]
    if not is_small(entries, MAX_CATALOGUE_SLICE):
        count = entries.count() // (MAX_CATALOGUE_SLICE // 2) + 1
        part = F.pmod(F.xxhash64("__text"), F.lit(count))
        slices = [entries.where(part == i) for i in range(count)]

    names = codes.where(F.col(code).isNotNull()).select(code).distinct()
    named = names.withColumn("__text", token_text(code))
    # The scoring is heavy for its few bytes: spread it over all cores, whatever its size.
    cores = codes.sparkSession.sparkContext.defaultParallelism
    texts = named.where(F.col("__text") != "").select("__text").distinct().repartition(cores)
    if len(slices) > 1:
        texts = durable(texts)  # read once per slice
    found = None
    for piece in slices:
        rows = piece.orderBy("pos").toPandas()
        if rows.empty and found is not None:
            continue
        local = _match_slice(texts, rows)
        found = local if found is None else found.unionByName(local)
    best = found.groupBy("__text").agg(
        F.max(F.struct("score", (-F.col("pos")).alias("order"), "entry")).alias("__b")
    )
    return named.join(best, "__text", "left").select(
        code,
        F.col("__b.entry").alias(match),
        F.coalesce(F.bround("__b.score"), F.lit(0.0)).cast("int").alias(score),
    )


def _match_slice(texts: DataFrame, entries: pd.DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if entries.empty:
            return
        index = _Slice(entries["__text"].tolist())
        for frame in frames:
            hits = [index.best(t) for t in frame["__text"]]
            rows = entries.iloc[[i for i, _ in hits]]
            result = pd.DataFrame(
                {
                    "__text": frame["__text"].to_numpy(),
                    "score": [s for _, s in hits],
                    "pos": rows["pos"].to_numpy(),
                    "entry": rows["entry"].to_numpy(),
                }
            )
            yield result[result["score"] > 0]

    return texts.mapInPandas(run, "__text string, score double, pos long, entry string")
