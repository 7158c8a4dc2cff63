"""Composed ticket pipelines: integration, analysis set, classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalars import joined_text
from faultline.operators import cleaning as C
from faultline.operators import joins as J
from faultline.operators.similarity import classify
from faultline.plans.sizing import measured_side

TEXT_FIELDS = ("desc_problema", "descripcion", "problema")


def integrate_tickets(
    tickets: DataFrame,
    pieces: DataFrame,
    states: DataFrame,
    types: DataFrame,
    before: str | None = None,
) -> DataFrame:
    """Warranty tickets with pieces, state and type.

    The filter reads ticket columns only, so it is applied to the scan and not
    after the joins.
    """
    chosen = C.warranty_tickets(tickets, before=before)
    return J.join_status(J.join_pieces(chosen, pieces), states, types)


def translated_tickets(
    tickets: DataFrame, translations: Mapping[str, DataFrame], fields: Sequence[str] = TEXT_FIELDS
) -> DataFrame:
    """Add translated fields and fill missing texts with the empty text."""
    result = J.with_translations(tickets, {f: translations[f] for f in fields})
    return C.fill_text(result)


def analysis_set(
    tickets: DataFrame,
    articles: DataFrame,
    threshold: float = 85,
    fields: Sequence[str] = TEXT_FIELDS,
    extra_families: Sequence[str] = (),
) -> DataFrame:
    """Tickets with a sure article of a meaningful family and a text of some length.

    Score and text rules run on the tickets before the article join.
    """
    texts = tickets.withColumn("text_to_analyse", joined_text(*[f"{f}_translated" for f in fields]))
    usable = C.scored(texts, "Fuzzy_Score", threshold).where(C.long_enough("text_to_analyse"))
    enriched = J.enrich_articles(usable, articles)
    kept = C.exclude_families(enriched, "DESCCAR3", extra_families)
    return kept.withColumn("DESCCAR2", F.coalesce("DESCCAR2", F.lit("")))


def most_likely_errors(
    tickets: DataFrame, catalogue: DataFrame, key: str, compat: bool = False
) -> DataFrame:
    """Best catalogue error of each ticket vector, with the text that it has in the ticket's family.

    Only ``compat`` can choose an error of another family; it has the first of its texts.
    """
    best = classify(tickets, catalogue, key, keep=["CAR3", "CAR2"], compat=compat)
    texts = catalogue.groupBy(F.col("ID_ERROR").alias("__id"), F.col("CODCAR3").alias("__family")).agg(F.min("MOTIVO").alias("__own"))
    first = catalogue.groupBy(F.col("ID_ERROR").alias("__any")).agg(F.min("MOTIVO").alias("__first"))
    same = (F.col("ID_ERROR") == F.col("__id")) & (F.col("CAR3") == F.col("__family"))
    named = best.join(measured_side(texts), same, "left").join(measured_side(first), F.col("ID_ERROR") == F.col("__any"), "left")
    motive = F.when(F.col("__id").isNotNull(), F.col("__own")).otherwise(F.col("__first")).alias("MOTIVO")
    return named.select(*best.columns, motive)
