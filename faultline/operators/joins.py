"""Ticket, dimension, translation and catalogue joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import scalars as S
from faultline.plans.sizing import measured_side


def suffixed(left: DataFrame, right: DataFrame, suffix: str) -> DataFrame:
    """Rename the right columns that also exist on the left."""
    taken = set(left.columns)
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in taken})


def left_lookup(
    left: DataFrame,
    dimension: DataFrame,
    left_key: str,
    right_key: str,
    suffix: str,
    null_safe: bool = False,
) -> DataFrame:
    """Left join to a dimension. Left names stay, colliding right names get ``suffix``."""
    right = suffixed(left, dimension, suffix)
    key = right_key + suffix if right_key in left.columns else right_key
    rule = left[left_key].eqNullSafe(right[key]) if null_safe else left[left_key] == right[key]
    return left.join(measured_side(right), rule, "left")


def join_pieces(
    tickets: DataFrame,
    pieces: DataFrame,
    ticket_key: str = "codigo",
    piece_key: str = "codigo_incidencia",
    suffix: str = "_pieza",
) -> DataFrame:
    """Tickets with their pieces, 1:n, tickets without pieces kept.

    Written as matched rows plus the tickets no piece names. In a left outer
    join Spark can only split a hot key on the ticket side; in an inner join
    adaptive execution also splits the many pieces of one hot ticket. The second
    part joins distinct keys only.
    """
    right = suffixed(tickets, pieces, suffix)
    key = piece_key + suffix if piece_key in tickets.columns else piece_key
    matched = tickets.join(right, tickets[ticket_key] == right[key], "inner")
    named = pieces.select(F.col(piece_key).alias("__named")).distinct()
    alone = tickets.join(named, tickets[ticket_key] == named["__named"], "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def join_status(
    tickets: DataFrame,
    states: DataFrame,
    types: DataFrame,
    state: str = "estado",
    kind: str = "tipo",
    key: str = "id",
) -> DataFrame:
    """Look up state and type of each ticket."""
    with_state = left_lookup(tickets, states, state, key, "_estado")
    return left_lookup(with_state, types, kind, key, "_tipo")


def role_lookups(
    articles: DataFrame,
    characteristics: DataFrame,
    roles: Sequence[int] = (1, 2, 3, 4),
    kind: str = "A",
) -> DataFrame:
    """Describe code columns ``CAR<i>`` through one dimension, filtered per role.

    A code that occurs twice in its role gives two rows.
    """
    result = articles
    for i in roles:
        role = characteristics.where(
            (F.col("NUMCAR") == i) & (F.col("TIPCAR") == kind)
        ).select(F.col("CODCAR").alias("__code"), F.col("DESCCAR").alias(f"DESCCAR{i}"))
        result = result.join(
            measured_side(role), F.col(f"CAR{i}") == F.col("__code"), "left"
        ).drop("__code")
    return result


def _fingerprint(text: str | Column) -> list[Column]:
    """128 bits of a text as two numbers, null for a null text. Texts of one fingerprint are still compared."""
    text = S.col(text)
    return [F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text)) for seed in (0, 1)]


def translation_map(translations: DataFrame, field: str) -> DataFrame:
    """One translation per text: repeated headers dropped, the first in text order kept.

    Rows are grouped by fingerprint, so no text is a sort key; the few distinct translations of a text are compared
    inside its group.
    """
    target = f"{field}_translated"
    known = translations.where(~F.coalesce(F.col(target) == target, F.lit(False)) & F.col(field).isNotNull())
    first, second = _fingerprint(field)
    pair = F.struct(F.col(field).alias("text"), F.col(target).alias("target"))
    groups = known.groupBy(first.alias("__k"), second.alias("__l")).agg(F.collect_set(pair).alias("__pairs"))
    # One group holds one text, but for a collision: then each of its texts has a row of its own.
    texts = F.array_distinct(F.col("__pairs.text"))
    split = groups.select("__k", "__l", "__pairs", F.explode(texts).alias(field))
    own = F.filter("__pairs", lambda p: p["text"] == F.col(field))
    return split.select("__k", "__l", field, F.array_min(F.transform(own, lambda p: p["target"])).alias(target))


def with_translation(df: DataFrame, translations: DataFrame, field: str) -> DataFrame:
    """Add ``<field>_translated``: the translation if known, else the text itself."""
    joined = _translated(df, translations, field)
    target = f"{field}_translated"
    return joined.withColumn(target, F.coalesce(F.col(target), F.col(field)))


def _translated(df: DataFrame, translations: DataFrame, field: str) -> DataFrame:
    """``df`` with the translation known for its text: joined by fingerprint, the text compared for the rest."""
    first, second = _fingerprint(field)
    mapped = translation_map(translations, field).withColumnsRenamed({"__k": "__m", "__l": "__n", field: "__text"})
    keyed = df.withColumn("__k", first).withColumn("__l", second)
    # As a range the comparison stays a condition; an equality would become one more sort key.
    alike = F.col(field).between(F.col("__text"), F.col("__text"))
    same = (F.col("__k") == F.col("__m")) & (F.col("__l") == F.col("__n")) & alike
    return keyed.join(mapped, same, "left").drop("__k", "__l", "__m", "__n", "__text")


def with_translations(
    df: DataFrame, translations: dict[str, DataFrame]
) -> DataFrame:
    """Apply one translation table per field."""
    for field, table in translations.items():
        df = with_translation(df, table, field)
    return df


def worklist_translation(
    df: DataFrame, worklist: DataFrame, translations: DataFrame, field: str
) -> DataFrame:
    """Two-step variant: complete the work-list first, then map the facts through it."""
    completed = with_translation(worklist.select(field).distinct(), translations, field)
    return _translated(df, completed, field)


def with_cached_match(
    df: DataFrame,
    cache: DataFrame,
    code: str = "cod_articulo",
    match: str = "CODART_A3",
    default: str = "0",
) -> DataFrame:
    """Join earlier fuzzy matches; a code without one gets ``default``."""
    return df.join(cache.dropDuplicates(), code, "left").fillna({match: default})


def enrich_articles(
    df: DataFrame, articles: DataFrame, match: str = "CODART_A3", key: str = "CODART"
) -> DataFrame:
    """Article attributes of the matched code."""
    return df.join(measured_side(articles), F.col(match) == F.col(key), "left")


def lines_with_headers(
    lines: DataFrame,
    headers: DataFrame,
    document: str,
    company: str | None = "Country",
    suffix: str = "_y",
) -> DataFrame:
    """Document lines with their header.

    Ids are unique per company only, so the company is part of the key;
    ``company=None`` joins on the id alone.
    """
    keys = [document] if company is None else [company, document]
    right = headers.withColumnsRenamed(
        {c: c + suffix for c in headers.columns if c in lines.columns and c not in keys}
    )
    return lines.join(right, keys, "left")


def join_labels(
    tickets: DataFrame, labels: DataFrame, key: str, label_text: str
) -> DataFrame:
    """Left join labels through the first 8-digit run found in a free text."""
    keyed = labels.withColumn("__key", S.first_digits(label_text))
    return tickets.join(keyed, S.key_text(key) == S.key_text("__key"), "left").drop("__key")


def monthly_outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, suffixes: tuple[str, str]
) -> DataFrame:
    """Full outer join of two periodic series."""
    return left.withColumnRenamed(value, value + suffixes[0]).join(
        right.withColumnRenamed(value, value + suffixes[1]), list(keys), "full_outer"
    )


def applicable(
    family: str | Column, system: str | Column, cat_family: str | Column, cat_system: str | Column
) -> Column:
    """Catalogue row applies: same family, and system 0 (any) or the same system."""
    family, system, cat_family, cat_system = map(S.col, (family, system, cat_family, cat_system))
    return (family == cat_family) & ((cat_system == 0) | (system == cat_system))


def missing_ids(catalogue: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Catalogue ids, as canonical text, that the error list lacks."""
    left = catalogue.select(S.id_text(key).alias(key)).distinct()
    right = known.select(S.id_text(key).alias(key)).distinct()
    return left.join(right, key, "left_anti")
