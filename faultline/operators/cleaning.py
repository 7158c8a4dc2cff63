"""Typing by a dtype map, fills, business filters and exclusion rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions import scalars as S

# Article families whose pieces say nothing about a defect. Lines
# named after a product are passed by the caller through ``extra``.
MEANINGLESS_FAMILIES = (
    "DOCUMENTACION", "EXPOSITORES", "TOBERAS", "MP_CONSUMIBLES", "OBS_CENTRALIZADO",
    "MP_ELECTRONICA", "MP_TERMINADOS/SEMI", "MP_MECANICOS", "OBS_REJILLA MOTORIZADA",
    "OBS_COMUNES", "OBS_DISTRIBUIDO", "OBS_DIFUSOR SIN REGULACIÓN", "OBS_OTROS",
    "MP_SERVICIOS", "MP_I+D", "OBS_REJILLA SIN REGULACIÓN", "OBS_PANTALLAS GRAFICAS",
    "Soporte técnico", "PUESTA EN MARCHA", "MP_DIFUSION", "OBS_ALARMAS TÉCNICAS",
    "MP_CHAPAS", "MP_CABLE", "OBS_CABLE", "MP_MOTORES", "MERCHANDISING",
    "OBS_COMUNICACIONES", "OBS_DIFUSOR MOTORIZADO", "OBS_CAJA DE MEZCLA",
)
SPECIAL_FAMILIES = ("REEMPLAZOS", "PACKS")
BOILERPLATE = "NO FUNCIONA"

_DTYPES: dict[str, Callable[[Column, bool], Column]] = {
    "int": lambda c, _: S.to_integer(c),
    "float": lambda c, _: S.to_float(c),
    "float_especial": lambda c, _: S.to_float_comma(c),
    "datetime64": lambda c, _: S.to_timestamp(c),
    "str": S.to_text,
}


def _typed(field: T.StructField, dtype: str) -> Column:
    is_float = isinstance(field.dataType, (T.FloatType, T.DoubleType))
    rule = _DTYPES.get(dtype)
    return rule(F.col(field.name), is_float) if rule else F.col(field.name).try_cast(dtype)


def convert_types(df: DataFrame, dtypes: Mapping[str, str]) -> DataFrame:
    """Give columns the types of ``{column: dtype}``; an unreadable value is null.

    Unknown dtype names are taken as Spark type names. Columns missing from the
    table are ignored, columns missing from the map stay as they are.
    """
    return df.select(
        *[
            _typed(f, dtypes[f.name]).alias(f.name) if f.name in dtypes else F.col(f.name)
            for f in df.schema
        ]
    )


def reject_counts(df: DataFrame, dtypes: Mapping[str, str]) -> DataFrame:
    """One row per mapped column: values present, and values lost by the conversion."""
    fields = [f for f in df.schema if f.name in dtypes]
    counts = df.agg(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.count(F.col(f.name)).alias("present"),
                F.count_if(
                    S.without_markers(F.col(f.name).cast("string"), S.CSV_NULL_MARKERS).isNotNull()
                    & _typed(f, dtypes[f.name]).isNull()
                ).alias("rejected"),
            ).alias(f"c{i}")
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(fields))])))


def clean_markers(df: DataFrame, markers: Sequence[str] = S.CSV_NULL_MARKERS) -> DataFrame:
    """Null markers to null in every string column."""
    return df.select(
        *[
            S.without_markers(f.name, markers).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def tagged(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    """Fill nulls of ``column`` from ``other``."""
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other)))


def fill_text(df: DataFrame, value: str = "", columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of string columns only."""
    return df.fillna(value, subset=list(columns) if columns is not None else None)


def warranty_tickets(
    df: DataFrame,
    kind: str = "tipo",
    state: str = "estado",
    modified: str | None = "modification_date",
    before: str | None = None,
    kinds: Sequence[int] = (1,),
    states: Sequence[int] = (2, 6),
) -> DataFrame:
    """Tickets of a type and state, changed before a date; a null date is left out."""
    rule = F.col(kind).isin(*kinds) & F.col(state).isin(*states)
    if before is not None:
        rule = rule & (F.col(modified) < F.lit(before).cast("timestamp_ntz"))
    return df.where(rule)


def not_in(c: str | Column, values: Sequence[str | None]) -> Column:
    """``NOT IN`` that keeps null rows unless null is one of the values."""
    c = S.col(c)
    listed = [v for v in values if v is not None]
    hit = F.coalesce(c.isin(*listed), F.lit(False))
    return ~(hit | c.isNull()) if None in values else ~hit


def exclude_families(
    df: DataFrame, family: str, extra: Sequence[str] = (), special: bool = True
) -> DataFrame:
    """Drop pieces of meaningless, empty and (by default) special families."""
    dropped = (*MEANINGLESS_FAMILIES, *extra, None, "", *(SPECIAL_FAMILIES if special else ()))
    return df.where(not_in(family, dropped))


def long_enough(c: str | Column, shortest: int = 25, boilerplate: str = BOILERPLATE) -> Column:
    """More than ``shortest`` characters, also after removing a boilerplate phrase."""
    c = S.col(c)
    return (F.length(c) > shortest) & (
        F.length(F.replace(c, F.lit(boilerplate), F.lit(""))) > shortest
    )


def scored(df: DataFrame, score: str, threshold: float = 85) -> DataFrame:
    return df.where(F.col(score) >= threshold)


def any_present(columns: Sequence[str]) -> Column:
    return F.coalesce(*columns).isNotNull()


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def without_header_rows(df: DataFrame, column: str) -> DataFrame:
    """Drop rows that repeat the header text; null rows stay."""
    return df.where(not_in(column, [column]))


def by_key(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def split_by_date(df: DataFrame, date: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cut`` and rows from ``cut`` on; a null date is in neither."""
    at = F.lit(cut).cast("timestamp_ntz")
    return df.where(F.col(date) < at), df.where(F.col(date) >= at)


def in_series(df: DataFrame, series: str, codes: Sequence[str]) -> DataFrame:
    """Documents of a set of series codes, compared after stripping."""
    return df.where(S.strip(series).isin(*codes))
