"""Broadcast only what is known, or measured, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def bounded_side(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side whose row bound follows from parameters; leave it to Spark beyond that."""
    return F.broadcast(df) if rows <= max_rows else df


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; stops reading once it has seen more, without a shuffle."""
    return len(df.select(F.lit(1)).head(max_rows + 1)) <= max_rows


def measured_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side after counting it; a larger one keeps the shuffled join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def spread(scan: DataFrame, *keys: str, splits_per_core: int = 4) -> DataFrame:
    """Share a scan of few splits evenly among all cores before work that is heavy per row.

    Few splits are often uneven, as a file is cut at its row groups only. A scan of
    many splits per core is returned as it is, without a shuffle. ``scan`` must not
    contain a shuffle of its own.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores * splits_per_core:
        return scan
    return scan.repartition(cores * splits_per_core, *keys)
