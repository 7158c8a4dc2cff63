"""Give every row the values of its group, also when a few groups hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_GROUPS = 1_000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, unique: str) -> DataFrame:
    """Left join of ``rows`` with ``groups``, one row per ``key`` with its number of rows ``size``.

    A group of more than one in ``MAX_HOT_GROUPS`` of all ``total`` rows is hot; there are fewer
    than ``MAX_HOT_GROUPS`` of them, so they are broadcast, and their rows do not meet in one task.
    The others are joined by a shuffle, in which rows of hot groups are dealt out by ``unique``, a
    column of ``rows``. ``groups`` is read twice and must be a written table or a checkpoint.
    """
    values = [c for c in groups.columns if c not in (key, size)]
    hot_size = F.col(size) * MAX_HOT_GROUPS > F.lit(total)
    hot = groups.where(hot_size).select(
        F.col(key).alias("__hot_key"), F.struct(*values).alias("__hot")
    )
    cold = groups.where(~hot_size).select(
        F.col(key).alias("__cold_key"), F.struct(*values).alias("__cold"), F.lit(0).cast("long").alias("__cold_deal")
    )
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left").withColumn(
        "__deal",
        # Zero lets a row find its group; other values only spread rows that need no group.
        F.when(F.col("__hot_key").isNull() & F.col(key).isNotNull(), F.lit(0).cast("long")).otherwise(
            F.shiftrightunsigned(F.xxhash64(unique), 1) + 1
        ),
    )
    joined = marked.join(
        cold, (F.col(key) == F.col("__cold_key")) & (F.col("__deal") == F.col("__cold_deal")), "left"
    )
    found = F.coalesce(F.col("__hot"), F.col("__cold"))
    out = joined.withColumns({v: found[v] for v in values})
    return out.drop("__hot_key", "__hot", "__cold_key", "__cold", "__cold_deal", "__deal")
