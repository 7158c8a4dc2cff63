"""Counts, sums, shares, Pareto tables, profiles and other reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.cleaning import all_present
from faultline.plans.ordering import running_total


def count_by(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    """Rows per key, most frequent first; null keys are left out."""
    counts = df.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), *keys)


def present_by(df: DataFrame, key: str, column: str, out: str = "count") -> DataFrame:
    """Non-null values of ``column`` per key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(column).alias(out))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum per key; a group of nulls sums to 0, null keys are left out."""
    return (
        df.where(all_present(keys))
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))
    )


def max_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(out)).orderBy(F.desc(out), key)


def monthly_sum(df: DataFrame, date: str, value: str) -> DataFrame:
    dated = df.withColumns({"Year": F.year(date), "Month": F.month(date)})
    return sum_by(dated, ("Year", "Month"), value, value)


def without_last_period(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the latest, incomplete period."""
    last = df.agg(F.max(F.struct(*keys))).scalar()
    return df.where(F.struct(*keys) < last)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(count(column).alias("distinct"))


def with_group_size(
    df: DataFrame, key: str, out: str = "group_size", bounded: bool = False
) -> DataFrame:
    """Size of its group on every row, null for a null key.

    Counts are combined before the shuffle and joined back, so a hot key is
    counted in parts and adaptive execution may split it in the join. ``bounded``
    says that groups have a small natural limit, as the slots of a ticket; then a
    window does it and keeps an existing partitioning by the key.
    """
    if bounded:
        size = F.count(F.lit(1)).over(Window.partitionBy(key))
        return df.withColumn(out, F.when(F.col(key).isNotNull(), size))
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return df.join(sizes, key, "left")


def single_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once; null keys are left out.

    One combined aggregation: for a key with one row, the maximum of a column is
    its value, and hot keys shrink to one row before the shuffle.
    """
    return (
        df.where(all_present(keys))
        .groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"), *[F.max(c).alias(c) for c in df.columns])
        .where(F.col("__n") == 1)
        .select(*df.columns)
    )


def with_share(df: DataFrame, value: str, out: str = "share", scale: float = 1.0) -> DataFrame:
    """Share of the column total, which is aggregated apart as a scalar."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.try_divide(F.col(value) * F.lit(scale), total))


def pareto(
    counts: DataFrame,
    value: str,
    key: str,
    top: int | None = None,
    total: DataFrame | None = None,
    scale: float = 100.0,
) -> DataFrame:
    """Share and running share in descending order of ``value``.

    ``top`` keeps the first rows only. ``total`` is a one-value table for the
    denominator; by default the sum over all ``counts``.
    """
    order = [F.desc(value), F.asc(key)]
    if top is None:
        summed = running_total(counts, order, F.col(value), "cumsum")
    else:
        first = counts.orderBy(*order).limit(top)
        rows = Window.partitionBy(F.lit(0)).orderBy(*order)
        summed = first.withColumn(
            "cumsum",
            F.sum(value).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    if total is None:
        # with all rows kept, their checkpointed form already holds the sum
        total = (summed if top is None else counts).agg(F.sum(value))
    denominator = total.scalar()
    return summed.withColumns(
        {
            "share": F.try_divide(F.col(value) * F.lit(scale), denominator),
            "cum_share": F.try_divide(F.col("cumsum") * F.lit(scale), denominator),
        }
    )


def top_rows(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(value), F.asc(key)).limit(k)


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, out: str = "rank"
) -> DataFrame:
    """First ``n`` rows per group. Spark limits each partition before the shuffle."""
    ranks = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(out, ranks).where(F.col(out) <= n)


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` rows by a hash of the seed and all values, so the same ones for any layout of ``df``."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *values))).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, non-null and null values."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(c).alias(c) for c in df.columns],
    )
    return counts.unpivot("__rows", df.columns, "column", "non_null").select(
        "column",
        F.col("__rows").alias("rows"),
        "non_null",
        (F.col("__rows") - F.col("non_null")).alias("nulls"),
    )


def funnel(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows passing each rule, in one scan, with the share of all rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )
    return counts.unpivot("__rows", list(rules), "rule", "rows").select(
        "rule",
        "rows",
        F.try_divide(F.col("rows") * 100.0, F.col("__rows")).alias("percent"),
    )


def profile(df: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Describe every column: count, distinct, most frequent value, and numeric figures.

    All figures come from one histogram ``(column, value, n)``, which is combined
    before its shuffle. Quantiles interpolate linearly between exact ranks; these
    are found through running counts over range partitions, so no task sees a
    whole column.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("string").alias("value"),
                F.col(c).cast("double").alias("number")
                if c in numeric
                else F.lit(None).cast("double").alias("number"),
            )
            for c in df.columns
        ]
    )
    histogram = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value", "number")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_total(
        histogram, [F.col("number"), F.col("value")], F.col("n"), "upto", ["column"]
    )
    totals = ranked.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max_by("value", F.struct("n", F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
        F.try_divide(F.sum(F.col("number") * F.col("n")), F.sum("n")).alias("mean"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    narrow = F.broadcast(totals.select("column", "count", "mean"))  # one row per column
    placed = ranked.where(F.col("number").isNotNull()).join(narrow, "column")

    def at(rank: Column) -> Column:
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(hit, F.col("number")))

    figures = [
        F.sqrt(
            F.try_divide(
                F.sum(F.pow(F.col("number") - F.col("mean"), 2) * F.col("n")),
                F.first("count") - 1,
            )
        ).alias("std")
    ]
    for q in quantiles:
        rank = (F.col("count") - 1) * F.lit(float(q))
        low = at(F.floor(rank))
        part = F.first(rank - F.floor(rank))
        figures.append((low + (at(F.ceil(rank)) - low) * part).alias(f"q{round(q * 100)}"))
    spread = placed.groupBy("column").agg(*figures)
    return totals.join(F.broadcast(spread), "column", "left")  # one row per column
