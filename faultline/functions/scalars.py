"""Typing, null-marker and key expressions. All are safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value in typed columns, and the
# additional ones a CSV reader treats as missing.
NULL_MARKERS = ("nan", "NaT", "None", "<NA>")
CSV_NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Formats tried in turn when a text is read as a timestamp.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
)

# A decimal number; a plain cast would also take a suffix, as in the code "12D".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_markers(c: str | Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    """Null for a text that only marks a missing value."""
    c = col(c)
    return F.when(~c.isin(*markers), c)


def _number(text: Column) -> Column:
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    return F.coalesce(finite, F.when(text.rlike(INFINITE), text.try_cast("double")))


def to_integer(c: str | Column) -> Column:
    """Text to long; decimals with a zero fraction count as whole, all else is null."""
    text = col(c).cast("string")
    number = _number(text)
    whole = F.when(number == F.floor(number), text.try_cast("decimal(38,6)").try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)


def to_float(c: str | Column) -> Column:
    """Text to double; a text that is not a number is null."""
    return _number(col(c).cast("string"))


def to_float_comma(c: str | Column) -> Column:
    """Text with a decimal comma to double."""
    return _number(F.replace(col(c).cast("string"), F.lit(","), F.lit(".")))


def to_timestamp(c: str | Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    text = col(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def to_text(c: str | Column, from_number: bool = False) -> Column:
    """Text without null markers; a number read as float loses its ``.0`` first."""
    text = to_integer(c).cast("string") if from_number else col(c).cast("string")
    return without_markers(text)


def strip(c: str | Column) -> Column:
    """Strip blanks, tabs and line ends."""
    return F.btrim(col(c), F.lit(" \t\n\r"))


def dash_to_zero(c: str | Column) -> Column:
    """Catalogue code with ``-`` for "any", as an integer where ``-`` is 0."""
    return to_integer(F.replace(col(c), F.lit("-"), F.lit("0")))


def first_digits(c: str | Column, length: int = 8) -> Column:
    """First run of ``length`` digits, null when there is none."""
    return F.nullif(F.regexp_extract(col(c), rf"(\d{{{length}}})", 1), F.lit(""))


def key_text(c: str | Column) -> Column:
    """Canonical text of a numeric key: ``12``, ``12.0`` and ``"12"`` agree."""
    return to_integer(c).cast("string")


def id_text(c: str | Column) -> Column:
    """Canonical text of a dotted id such as ``3.80``: no trailing zeros."""
    number = col(c).cast("string").try_cast("decimal(38,10)").cast("string")
    return F.regexp_replace(number, r"\.?0+$", "")


def last_part(c: str | Column, separator: str = "_") -> Column:
    return F.substring_index(col(c), separator, -1)


def joined_text(*columns: str | Column, separator: str = " ") -> Column:
    """Join fields with a separator; null fields stay as empty parts."""
    return F.concat_ws(separator, *[F.coalesce(col(c), F.lit("")) for c in columns])


def year_month(c: str | Column) -> tuple[Column, Column]:
    c = col(c)
    return F.year(c).alias("Year"), F.month(c).alias("Month")
