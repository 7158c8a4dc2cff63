"""Classification report against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair of label and prediction, rows without either left out."""
    return (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def evaluation_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    Rows are reduced to the confusion table first. A class that is only predicted or
    only labelled is listed; a division by zero gives 0.
    """
    pairs = confusion(df, label, prediction)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("string").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    counts = sides.groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]
    )

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    rates = counts.select(
        "class",
        "support",
        "hits",
        share(F.col("hits"), F.col("predicted")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(F.col("hits") * 2.0, F.col("predicted") + F.col("support")).alias("f1"),
    )
    measures = ("precision", "recall", "f1")
    totals = rates.agg(
        F.sum("support").alias("support"),
        share(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
    )
    summary = totals.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    "support",
                    *[F.col("accuracy").alias(m) for m in measures],
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        "support",
                        *[F.col(f"{kind}_{m}").alias(m) for m in measures],
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return rates.select("class", "support", *measures).unionByName(summary)


def mean_scores(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Mean of repeated scores of the same pair, for encoders that vary between calls."""
    return df.groupBy(*keys).agg(F.avg(score).alias(score))
