"""Language identification with character-trigram profiles, and translation work-lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.cleaning import not_in
from faultline.operators.reports import top_per_group
from faultline.plans.durable import durable
from faultline.plans.sizing import is_small

CHUNK = 1 << 20  # characters worked on at a time

# Labels of texts without a language, and the length gate.
TOO_SHORT, UNKNOWN = "Too short", "Error"
SHORTEST = 5
MAX_PROFILE_ROWS = 1_000_000
NOT_TRANSLATED = ("es", UNKNOWN, TOO_SHORT)


def _trigrams(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and trigrams of whole texts, in chunks of bounded size.

    A trigram is one integer of three code points. A long text spans several chunks,
    which overlap by two characters.
    """
    owners: list[int] = []
    parts: list[str] = []
    size = 0
    for owner, text in enumerate(texts):
        for start in range(0, len(text or "") - 2, CHUNK):
            owners.append(owner)
            parts.append(text[start : start + CHUNK + 2])
            size += len(parts[-1])
            if size >= CHUNK:
                yield _coded(owners, parts)
                owners, parts, size = [], [], 0
    if parts:
        yield _coded(owners, parts)


def _coded(owners: list[int], parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.array([len(p) for p in parts])
    ends = np.cumsum(lengths)
    starts = np.ones(len(codes), dtype=bool)
    starts[ends - 1] = starts[ends - 2] = False  # no trigram leaves its part
    grams = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[starts[:-2]]
    return np.repeat(owners, lengths)[starts], grams


def _printed(grams: np.ndarray) -> list[str]:
    codes = np.stack([grams >> 42, grams >> 21, grams], axis=1) & ((1 << 21) - 1)
    text = codes.astype(np.uint32).tobytes().decode("utf-32-le")
    return [text[i : i + 3] for i in range(0, len(text), 3)]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and trigram of each batch of ``(lang, text)``."""
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1).to_pylist()
        names, kind = np.unique(langs.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        seen: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in names]
        for owners, grams in _trigrams(texts):
            for i in range(len(names)):
                seen[i].append(np.unique(grams[kind[owners] == i], return_counts=True))
        for name, found in zip(names, seen):
            if not found:
                continue
            grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in found])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(name)] * len(grams), pa.string()), pa.array(_printed(grams), pa.string()), pa.array(counts)],
                names=["lang", "gram", "n"],
            )


def language_profile(
    df: DataFrame, text: str, lang: str, languages: Sequence[str], size: int | None = None
) -> DataFrame:
    """Trigrams of each language with log-probabilities, of each the ``size`` most frequent ones if given.

    One row per trigram, a language has one column, smoothed by one count. Trigrams are counted
    per batch before the shuffle.
    """
    counts = (
        df.where(F.col(lang).isin(*languages))
        .select(F.col(lang).alias("lang"), F.lower(text).alias("text"))
        .mapInArrow(_count_trigrams, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    kept = counts if size is None else top_per_group(counts, "lang", [F.desc("n"), F.asc("gram")], size)
    wide = kept.groupBy("gram").agg(
        *[
            F.coalesce(F.max(F.when(F.col("lang") == l, F.col("n"))), F.lit(0)).alias(l)
            for l in languages
        ]
    )
    wide = durable(wide)
    total = wide.agg(F.struct(F.count("gram").alias("__grams"), *[F.sum(l).alias(l) for l in languages])).scalar()
    summed = wide.withColumn("__total", total)
    return summed.select(
        "gram",
        *[
            F.ln((F.col(l) + 1) / (F.col(f"__total.{l}") + F.col("__total.__grams"))).alias(l)
            for l in languages
        ],
    )


def detect_language(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    profile: DataFrame,
    languages: Sequence[str],
    out: str = "language",
) -> DataFrame:
    """Most probable language per row; short texts and texts without a known trigram are labelled.

    A profile of checked rows travels to the tasks, and every text is decided where it is, without a shuffle. A larger one is
    joined by trigram with those counted inside each text, with the same result.
    """
    if not is_small(profile, MAX_PROFILE_ROWS):
        return _detect_by_join(df, keys, text, profile, languages, out)
    model = profile.toPandas()  # at most MAX_PROFILE_ROWS rows
    grams = [code for g in model["gram"] for _, ids in [_coded([0], [g])] for code in ids]
    known = np.array(grams, dtype=np.int64)
    order = np.argsort(known)
    known = known[order]
    names = sorted(languages, reverse=True)  # of equal scores the last name wins
    weights = model[names].to_numpy(dtype=np.float64)[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            hits, scores = np.zeros(len(texts)), np.zeros((len(texts), len(names)))
            for owners, ids in _trigrams(texts) if len(known) else ():
                at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
                hit = known[at] == ids
                owners, at = owners[hit], at[hit]
                hits += np.bincount(owners, minlength=len(texts))
                for i in range(len(names)):
                    scores[:, i] += np.bincount(owners, weights[at, i], minlength=len(texts))
            best = scores.argmax(axis=1)
            labels = [
                TOO_SHORT if len(t or "") < SHORTEST else names[b] if h else UNKNOWN
                for t, h, b in zip(texts, hits, best)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keys))], pa.array(labels, pa.string())],
                names=[*keys, out],
            )

    fields = [df.schema[k] for k in keys] + [T.StructField(out, T.StringType())]
    return df.select(*keys, F.lower(text).alias("__text")).mapInArrow(run, T.StructType(fields))


def _detect_by_join(
    df: DataFrame, keys: Sequence[str], text: str, profile: DataFrame, languages: Sequence[str], out: str
) -> DataFrame:
    """``detect_language`` with a profile of any size; rows are told apart by a number, as keys may repeat."""
    rows = df.select(*keys, F.lower(text).alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    rows = durable(rows)
    chars = F.split("__text", "")
    places = F.sequence(F.lit(0), F.col("__n") - 3)
    gram = F.transform(places, lambda i: F.concat(F.get("__chars", i), F.get("__chars", i + 1), F.get("__chars", i + 2)))
    cut = rows.select("__row", F.length("__text").alias("__n"), chars.alias("__chars")).where("__n > 2")
    counted = cut.select("__row", F.explode(gram).alias("gram")).groupBy("__row", "gram").agg(F.count("*").alias("n"))
    names = sorted(languages, reverse=True)  # of equal scores the last name wins
    sums = counted.join(profile, "gram").groupBy("__row").agg(*[F.sum(F.col("n") * F.col(l)).alias(f"__{l}") for l in names])
    top = F.greatest(*[F.col(f"__{l}") for l in names]) if len(names) > 1 else F.col(f"__{names[0]}")
    best = F.coalesce(*[F.when(F.col(f"__{l}") == top, F.lit(l)) for l in names])
    found = rows.join(sums.select("__row", best.alias(out)), "__row", "left")
    short = F.length(F.coalesce("__text", F.lit(""))) < SHORTEST
    return found.select(*keys, F.when(short, TOO_SHORT).otherwise(F.coalesce(out, F.lit(UNKNOWN))).alias(out))


def keep_languages(df: DataFrame, language: str, kept: Sequence[str] = ("es", "pt")) -> DataFrame:
    return df.where(F.col(language).isin(*kept))


def distinct_texts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct texts of several fields as ``(field, text)``; null counts as one text."""
    return df.unpivot([], list(fields), "field", "text").distinct()


def to_translate(worklist: DataFrame, language: str = "language") -> DataFrame:
    """Work-list rows in a language that needs translation."""
    return worklist.where(not_in(language, NOT_TRANSLATED))


def translation_budget(worklist: DataFrame, language: str = "language") -> DataFrame:
    """Texts and characters to translate per field."""
    return (
        to_translate(worklist, language)
        .groupBy("field")
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.sum(F.length("text")).alias("characters"),
        )
    )
