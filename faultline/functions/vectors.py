"""Expressions on ``array`` vectors. Elements are widened to double before use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.scalars import col


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(
        F.aggregate(
            col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
        )
    )


def unit(a: str | Column) -> Column:
    """Vector of length one; a zero vector stays zero."""

    def scaled(length: Column) -> Column:
        return F.transform(
            col(a), lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0))
        )

    # The length is bound by an outer lambda, else it is computed once per element.
    return F.get(F.transform(F.array(norm(a)), scaled), F.lit(0))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; 0 when one vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def parse_vector(c: str | Column) -> Column:
    """``"[0.1 0.2]"`` to an array of floats; an unreadable element is null."""
    inner = F.btrim(F.regexp_replace(col(c), r"[\[\]]", " "), F.lit(" \t\n\r"))
    parts = F.filter(F.split(inner, r"\s+"), lambda t: t != "")
    return F.transform(parts, lambda t: t.try_cast("float"))


def vector_columns(c: str | Column, width: int, prefix: str = "vector_") -> list[Column]:
    """One column per element of a vector of known width."""
    return [F.get(col(c), F.lit(i)).alias(f"{prefix}{i}") for i in range(width)]


def stacked(a: str | Column, b: str | Column) -> Column:
    """Concatenate two embeddings of a document, null unless both exist."""
    return F.concat(col(a), col(b))
