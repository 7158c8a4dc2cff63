"""Append-only translation cache fed by a stream of work-list rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from faultline.operators.translation import Translator, translate_texts, untranslated
from faultline.sources.files import append_cache, read_cache


def feed_cache(
    worklist: DataFrame,
    field: str,
    cache: str,
    checkpoint: str,
    make_translator: Callable[[], Translator],
    batch_size: int = 50,
) -> StreamingQuery:
    """Translate each micro-batch's unknown texts and append them to the cache.

    A repeated batch finds its texts in the cache and appends nothing, so a restart
    after a lost executor does not translate twice.
    """
    schema = f"`{field}` string, `{field}_translated` string, error string"

    def append(batch: DataFrame, _: int) -> None:
        known = read_cache(batch.sparkSession, cache, schema)
        fresh = untranslated(batch, known, field)
        append_cache(translate_texts(fresh, field, make_translator, batch_size), cache)

    return (
        worklist.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
