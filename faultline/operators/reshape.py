"""Unions with drift reports, slot unpivot and pivot, cluster columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.cleaning import tagged
from faultline.plans.ordering import position


def union_tagged(tables: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union tables with differing columns, each row tagged with its source."""
    parts = [tagged(df, tag, name) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drift_report(tables: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Per source and column: whether the source has the column, and its non-null values."""
    union = union_tagged(tables, tag)
    columns = [c for c in union.columns if c != tag]
    counts = union.groupBy(tag).agg(*[F.count(c).alias(c) for c in columns])
    owned = F.create_map(
        *chain.from_iterable(
            (F.lit(name), F.array(*[F.lit(c) for c in df.columns])) for name, df in tables.items()
        )
    )
    return counts.unpivot(tag, columns, "column", "non_null").withColumn(
        "present", F.array_contains(owned[F.col(tag)], F.col("column"))
    )


def unpivot_slots(df: DataFrame, ids: Sequence[str], slots: Sequence[str]) -> DataFrame:
    """Wide slot columns to ``(variable, value)`` rows; empty slots are dropped.

    Written as an inlined array, which keeps the partitioning of ``df`` where
    ``unpivot`` loses it, so that a later pivot by the same id needs no shuffle.
    """
    cells = F.array(*[F.struct(F.lit(s).alias("variable"), F.col(s).alias("value")) for s in slots])
    return df.select(*ids, F.inline(cells)).where(F.col("value").isNotNull())


def slot_of(variable: str, slots: Mapping[str, tuple[int, str]]) -> tuple[Column, Column]:
    """Slot number and role of a column name; an unknown name has null and ``unknown``."""
    name = F.col(variable)
    number, role = F.lit(None).cast("int"), F.lit("unknown")
    for column, (n, r) in slots.items():
        number = F.when(name == column, F.lit(n)).otherwise(number)
        role = F.when(name == column, F.lit(r)).otherwise(role)
    return number, role


def duplicate_cells(df: DataFrame, keys: Sequence[str], variable: str) -> DataFrame:
    """Cells that a pivot on ``variable`` would fill more than once."""
    return (
        df.groupBy(*keys, variable)
        .agg(F.count(F.lit(1)).alias("cells"))
        .where(F.col("cells") > 1)
    )


def pivot_slots(
    df: DataFrame, keys: Sequence[str], variable: str, names: Sequence[str], value: str = "value"
) -> DataFrame:
    """``(keys, variable, value)`` rows back to one column per known variable.

    Two rows for one cell are an error; ``duplicate_cells`` lists them.
    """

    def cell(name: str) -> Column:
        own = F.col(variable) == name
        several = F.count(F.when(own, F.lit(1))) > 1
        found = F.max(F.when(own, F.col(value)))
        return F.when(several, F.raise_error(F.lit(f"several values of {name}"))).otherwise(found).alias(name)

    return df.groupBy(*keys).agg(*[cell(name) for name in names])


def cluster_columns(
    df: DataFrame, cluster: str, member: str, clusters: Sequence[int]
) -> DataFrame:
    """Members of the listed clusters side by side as ``Cluster_<k>``, in member order.

    Positions come from range partitions, so one large cluster spreads over many.
    """
    listed = df.where(F.col(cluster).isin(*clusters)).select(cluster, member)
    placed = position(listed, [F.col(member)], "position", [cluster])
    wide = placed.groupBy("position").pivot(cluster, list(clusters)).agg(F.max(member))
    return wide.withColumnsRenamed({str(k): f"Cluster_{k}" for k in clusters})
