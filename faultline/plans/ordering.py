"""Exact positions and running sums over a whole table without a one-task window.

The rows are range-partitioned by the requested order, so a hot group spreads
over many partitions. Each partition runs its own window, and the sums of the
partitions before it (at most one row per partition) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.plans.durable import durable

_PART = "__range_part"
_OFFSET = "__range_offset"


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    value: Column,
    out: str,
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``: the running sum of ``value`` in ``order``, restarted per ``group``.

    ``order`` must end in a unique key, group keys must not be null.
    """
    sort = [*[F.col(g) for g in group], *order]
    # The range bounds come from a sample; the checkpoint fixes one assignment
    # for both branches below, also after an executor is lost.
    ranged = durable(
        df.withColumn(out, value)
        .repartitionByRange(*sort)
        .withColumn(_PART, F.spark_partition_id())
    )
    before = (
        Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, _PART)
        .agg(F.sum(out).alias(_OFFSET))
        .withColumn(_OFFSET, F.sum(_OFFSET).over(before))
        .where(F.col(_OFFSET).isNotNull())
    )
    inside = (
        Window.partitionBy(*group, _PART)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # A range holds at most one group that began in an earlier range, hence
    # offsets has no more rows than there are partitions.
    return (
        ranged.join(F.broadcast(offsets), [*group, _PART], "left")
        .withColumn(
            out, F.sum(out).over(inside) + F.coalesce(F.col(_OFFSET), F.lit(0))
        )
        .drop(_PART, _OFFSET)
    )


def position(
    df: DataFrame, order: Sequence[Column], out: str = "position", group: Sequence[str] = ()
) -> DataFrame:
    """Add the zero-based position of each row in ``order``, per ``group`` if given."""
    numbered = running_total(df, order, F.lit(1).cast("long"), out, group)
    return numbered.withColumn(out, F.col(out) - 1)
