"""Corpus of tickets, questions, product documents and catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalars import joined_text
from faultline.functions.text import html_text, sentences
from faultline.operators.reshape import union_tagged


def ticket_texts(tickets: DataFrame, doc_id: str, *fields: str) -> DataFrame:
    """Analysis text of each ticket."""
    return tickets.select(
        F.col(doc_id).alias("doc_id"), joined_text(*fields).alias("text_to_analyse")
    )


def html_texts(pages: DataFrame, doc_id: str, html: str) -> DataFrame:
    """Text of each HTML row."""
    return pages.select(
        F.col(doc_id).alias("doc_id"), html_text(F.col(html)).alias("text_to_analyse")
    )


def sentence_rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per sentence with its zero-based position."""
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode(sentences(text)).alias("position", "text_to_analyse"),
    )


def build_corpus(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union of ``(doc_id, text_to_analyse)`` tables, tagged with their source."""
    parts = {
        name: df.select(F.col("doc_id").cast("string").alias("doc_id"), "text_to_analyse")
        for name, df in sources.items()
    }
    return union_tagged(parts, "source")
