"""Translation in batches with an injected translator and an append-only cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Translator = Callable[[Sequence[str]], Sequence[str]]


def untranslated(worklist: DataFrame, cache: DataFrame | None, field: str) -> DataFrame:
    """Distinct non-null texts of the work-list that the cache lacks.

    Failed batches are not in the cache, so the next run offers them again.
    """
    texts = worklist.where(F.col(field).isNotNull()).select(field).distinct()
    if cache is None:
        return texts
    done = cache.where(F.col(f"{field}_translated").isNotNull()).select(field).distinct()
    return texts.join(done, field, "left_anti")


def translate_texts(
    texts: DataFrame,
    field: str,
    make_translator: Callable[[], Translator],
    batch_size: int = 10,
    partitions: int | None = None,
) -> DataFrame:
    """``(field, field_translated, error)`` for every text.

    The translator is made once per partition and called with ``batch_size``
    texts; a failing batch keeps its rows, with the error and no translation. Calls
    are slow for their few bytes, hence ``partitions`` (one per core by default)
    instead of a number by size.
    """
    target = f"{field}_translated"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        translate = make_translator()
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                batch = frame[field].iloc[start : start + batch_size].tolist()
                try:
                    done, error = list(translate(batch)), None
                    if len(done) != len(batch):
                        raise ValueError("translator changed the number of texts")
                except Exception as problem:
                    done, error = [None] * len(batch), str(problem)
                yield pd.DataFrame({field: batch, target: done, "error": error})

    partitions = partitions or texts.sparkSession.sparkContext.defaultParallelism
    return texts.select(field).repartition(partitions).mapInPandas(
        run, f"`{field}` string, `{target}` string, error string"
    )
