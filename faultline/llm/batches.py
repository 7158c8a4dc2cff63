"""Small helpers for kernels that see Arrow batches or pandas series of texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice take ``most`` bytes, or are one text.

    Kernels allocate several numbers per byte of text, so the slice bounds their memory.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def kept(key: tuple, make: Callable):
    """One value per worker process.

    Functions sent to workers may carry their module's globals along as copies that live for
    one task only, so the values are kept in a module of their own.
    """
    name = "faultline_worker_values"
    values = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in values:
        values[key] = make()
    return values[key]
