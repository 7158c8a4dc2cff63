"""Integration, typing, cleaning and code matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import scalars as S
from faultline.operators import cleaning as C
from faultline.operators import joins as J
from faultline.operators import reports as R
from faultline.operators import reshape as U
from faultline.operators.fuzzy_join import matches_from
from faultline.operators.matching import best_matches
from faultline.plans import tickets as P
from faultline.plans.durable import durable
from workload.tables import CUT, STATES, TICKETS_SQL, TYPES, dimension, pieces, table, tickets


def ticket_piece_join(spark: SparkSession, d: str) -> DataFrame:
    return P.integrate_tickets(
        tickets(spark, d),
        pieces(spark, d),
        dimension(spark, STATES),
        dimension(spark, TYPES),
        before=CUT,
    )


TICKET_PIECE_JOIN = f"""
WITH {TICKETS_SQL}
SELECT t.*, p.codigo_incidencia, p.id_pieza, p.cod_articulo, p.modification_date_pieza,
       s.id_estado, s.titulo_es, y.id_tipo, y.titulo_es_tipo
FROM tickets t
LEFT JOIN pieces p ON t.codigo = p.codigo_incidencia
LEFT JOIN states s ON t.estado = s.id_estado
LEFT JOIN types y ON t.tipo = y.id_tipo
WHERE t.tipo = 1 AND t.estado IN (2, 6) AND t.modification_date < TIMESTAMP '{CUT}'
"""


def ticket_status(spark: SparkSession, d: str) -> DataFrame:
    joined = J.join_status(tickets(spark, d), dimension(spark, STATES), dimension(spark, TYPES))
    return R.count_by(joined, "titulo_es", "titulo_es_tipo", out="tickets")


TICKET_STATUS = f"""
WITH {TICKETS_SQL}
SELECT titulo_es, titulo_es_tipo, count(*) AS tickets
FROM tickets t LEFT JOIN states s ON t.estado = s.id_estado
LEFT JOIN types y ON t.tipo = y.id_tipo
WHERE titulo_es IS NOT NULL AND titulo_es_tipo IS NOT NULL
GROUP BY ALL
"""


def role_playing_dims(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    articles = part.select(
        F.col("p_partkey").alias("CODART"),
        F.col("p_brand").alias("CAR1"),
        F.col("p_type").alias("CAR2"),
        F.col("p_size").cast("string").alias("CAR3"),
        F.col("p_name").alias("CAR4"),
    )
    roles = {1: "p_brand", 2: "p_type", 3: "p_size", 4: "p_name"}
    entry = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("NUMCAR"), F.col(c).cast("string").alias("CODCAR"))
                for i, c in roles.items()
            ]
        )
    )
    codes = durable(part.select(entry).distinct())  # joined once per role
    characteristics = codes.select(
        "NUMCAR",
        "CODCAR",
        F.when(F.col("CODCAR").isin("PROMO", "7"), "B").otherwise("A").alias("TIPCAR"),
        F.concat(F.lit("desc "), F.lower("CODCAR")).alias("DESCCAR"),
    )
    return J.role_lookups(articles, characteristics)


def _role(i: int, code: str) -> str:
    return (
        f"CASE WHEN {code} NOT IN ('PROMO', '7') THEN 'desc ' || lower({code}) END AS DESCCAR{i}"
    )


ROLE_PLAYING_DIMS = f"""
WITH a AS (SELECT p_partkey AS CODART, p_brand AS CAR1, p_type AS CAR2,
                  CAST(p_size AS VARCHAR) AS CAR3, p_name AS CAR4 FROM part)
SELECT *, {_role(1, "CAR1")}, {_role(2, "CAR2")}, {_role(3, "CAR3")}, {_role(4, "CAR4")} FROM a
"""

DIRTY = {
    "whole": "int",
    "ratio": "float",
    "comma": "float_especial",
    "changed": "datetime64",
    "label": "str",
    "code": "str",
    "quantity": "smallint",
}


def _dirty(spark: SparkSession, d: str) -> DataFrame:
    """Texts with the markers and defects a CSV export brings."""
    nation = F.col("c_nationkey")
    bad = (
        F.when(nation == 0, F.lit("nan"))
        .when(nation == 1, F.lit("<NA>"))
        .when(nation == 2, F.lit("abc"))
        .when(nation == 3, F.lit(""))
    )
    return table(spark, d, "customer").select(
        "c_custkey",
        F.coalesce(
            bad,
            F.when(nation == 4, F.concat(F.col("c_custkey").cast("string"), F.lit(".5"))),
            F.when(nation == 5, F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))),
            F.col("c_custkey").cast("string"),
        ).alias("whole"),
        F.coalesce(bad, F.col("c_acctbal").cast("string")).alias("ratio"),
        F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(",")).alias("comma"),
        F.coalesce(
            bad, F.concat(F.lit("2024-01-"), F.lpad(nation.cast("string"), 2, "0"))
        ).alias("changed"),
        F.coalesce(bad, F.col("c_mktsegment")).alias("label"),
        F.when(nation != 6, nation.cast("double")).alias("code"),
        F.col("c_custkey").cast("string").alias("quantity"),
    )


_DIRTY_SQL = """
bad AS (SELECT *, CASE c_nationkey WHEN 0 THEN 'nan' WHEN 1 THEN '<NA>' WHEN 2 THEN 'abc'
                  WHEN 3 THEN '' END AS bad FROM customer),
dirty AS (
  SELECT c_custkey,
    coalesce(bad, CASE c_nationkey WHEN 4 THEN c_custkey || '.5' WHEN 5 THEN c_custkey || '.0'
             ELSE CAST(c_custkey AS VARCHAR) END) AS whole,
    coalesce(bad, CAST(c_acctbal AS VARCHAR)) AS ratio,
    replace(CAST(c_acctbal AS VARCHAR), '.', ',') AS comma,
    coalesce(bad, '2024-01-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS changed,
    coalesce(bad, c_mktsegment) AS label,
    CASE WHEN c_nationkey <> 6 THEN CAST(c_nationkey AS DOUBLE) END AS code,
    CAST(c_custkey AS VARCHAR) AS quantity
  FROM bad),
typed AS (
  SELECT c_custkey,
    CASE WHEN isfinite(TRY_CAST(whole AS DOUBLE))
          AND TRY_CAST(whole AS DOUBLE) = floor(TRY_CAST(whole AS DOUBLE))
         THEN TRY_CAST(TRY_CAST(whole AS DOUBLE) AS BIGINT) END AS whole,
    CASE WHEN NOT isnan(TRY_CAST(ratio AS DOUBLE)) THEN TRY_CAST(ratio AS DOUBLE) END AS ratio,
    TRY_CAST(replace(comma, ',', '.') AS DOUBLE) AS comma,
    TRY_CAST(changed AS TIMESTAMP) AS changed,
    CASE WHEN label NOT IN ('nan', 'NaT', 'None', '<NA>') THEN label END AS label,
    CAST(CAST(code AS BIGINT) AS VARCHAR) AS code,
    TRY_CAST(quantity AS SMALLINT) AS quantity
  FROM dirty)
"""


def coerce_types(spark: SparkSession, d: str) -> DataFrame:
    typed = C.convert_types(_dirty(spark, d), DIRTY)
    return typed.withColumn("changed", F.col("changed").cast("timestamp_ntz"))


COERCE_TYPES = f"WITH {_DIRTY_SQL} SELECT * FROM typed"


def coercion_rejects(spark: SparkSession, d: str) -> DataFrame:
    return C.reject_counts(_dirty(spark, d), DIRTY)


COERCION_REJECTS = f"""
WITH {_DIRTY_SQL},
pairs AS (
  {" UNION ALL ".join(
      f"SELECT '{c}' AS col, CAST(d.{c} AS VARCHAR) AS raw, CAST(t.{c} AS VARCHAR) AS done "
      "FROM dirty d JOIN typed t USING (c_custkey)" for c in DIRTY)})
SELECT col AS "column", count(raw) AS present,
       count(*) FILTER (raw NOT IN ('', 'nan', '<NA>') AND done IS NULL) AS rejected
FROM pairs GROUP BY col
"""


def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    code = F.concat_ws("_", "p_brand", "p_type", "p_size")
    return part.select(
        "p_partkey",
        S.joined_text("p_name", F.when(F.col("p_size") > 10, F.col("p_type")), "p_brand").alias("text"),
        F.lower("p_brand").alias("brand"),
        S.dash_to_zero(F.when(F.col("p_size") > 25, F.lit("-")).otherwise(F.col("p_size").cast("string"))).alias("system"),
        F.length(S.strip(F.concat(F.lit("\t "), "p_name", F.lit(" \n")))).cast("int").alias("name_length"),
        S.last_part(code).alias("last_part"),
        S.to_float(S.last_part(code)).alias("label_number"),
        S.to_float("p_type").alias("no_number"),
        S.key_text(F.col("p_size").cast("double")).alias("key"),
        S.first_digits(F.concat("p_name", F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("-1"))).alias("digits"),
        S.first_digits("p_brand").alias("no_digits"),
        F.concat("p_type", F.lit(" "), F.when(F.col("p_size") > 5, F.col("p_brand"))).alias("reason"),
        S.id_text(F.concat(F.col("p_size").cast("string"), F.lit(".80"))).alias("id_text"),
    )


SCALAR_FUNCTIONS = """
SELECT p_partkey,
  p_name || ' ' || CASE WHEN p_size > 10 THEN p_type ELSE '' END || ' ' || p_brand AS text,
  lower(p_brand) AS brand,
  CAST(CASE WHEN p_size > 25 THEN 0 ELSE p_size END AS BIGINT) AS system,
  CAST(length(p_name) AS INTEGER) AS name_length,
  CAST(p_size AS VARCHAR) AS last_part,
  CAST(p_size AS DOUBLE) AS label_number,
  CAST(NULL AS DOUBLE) AS no_number,
  CAST(p_size AS VARCHAR) AS key,
  lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS digits,
  CAST(NULL AS VARCHAR) AS no_digits,
  CASE WHEN p_size > 5 THEN p_type || ' ' || p_brand END AS reason,
  p_size || '.8' AS id_text
FROM part
"""


def translation_fallback(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    translations = documents.where(F.col("lang").isin("fr", "de")).select(
        "text",
        F.when(F.col("source") == "src0", F.lit("text_translated"))
        .otherwise(F.concat(F.lit("es: "), "text"))
        .alias("text_translated"),
    )
    result = J.with_translation(documents.select("doc_id", "text"), translations, "text")
    return result.select(
        "doc_id",
        (F.col("text") == F.col("text_translated")).alias("kept"),
        F.md5("text_translated").alias("translated_md5"),
    )


TRANSLATION_FALLBACK = """
WITH m AS (
  SELECT text, min('es: ' || text) AS done FROM documents
  WHERE lang IN ('fr', 'de') AND source <> 'src0' GROUP BY text)
SELECT d.doc_id, m.done IS NULL AS kept, md5(coalesce(m.done, d.text)) AS translated_md5
FROM documents d LEFT JOIN m USING (text)
"""


def translation_worklist(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    foreign = documents.where(C.not_in("lang", ["es", "Error", "Too short"]))
    cache = documents.where(F.col("lang") == "fr").select(
        "text", F.concat(F.lit("es: "), "text").alias("text_translated")
    )
    result = J.worklist_translation(documents.select("doc_id", "text"), foreign, cache, "text")
    return result.select("doc_id", F.md5("text_translated").alias("translated_md5"))


TRANSLATION_WORKLIST = """
WITH w AS (SELECT DISTINCT text FROM documents WHERE lang <> 'es'),
     c AS (SELECT DISTINCT text, 'es: ' || text AS done FROM documents WHERE lang = 'fr')
SELECT d.doc_id, md5(CASE WHEN w.text IS NOT NULL THEN coalesce(c.done, w.text) END) AS translated_md5
FROM documents d LEFT JOIN w ON d.text = w.text LEFT JOIN c ON w.text = c.text
"""


def best_match_cached(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    articles = part.select(
        F.col("p_partkey").cast("string").alias("CODART"), F.col("p_type").alias("DESCCAR3")
    )
    known = part.where(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("cod_articulo"),
        F.col("p_partkey").cast("string").alias("CODART_A3"),
        (F.col("p_size") * 2).alias("Fuzzy_Score"),
    )
    cache = known.unionByName(known)
    matched = J.with_cached_match(pieces(spark, d), cache)
    sure = C.scored(J.enrich_articles(matched, articles), "Fuzzy_Score", 85)
    unsure = matched.where(F.col("Fuzzy_Score").isNull())
    return (
        R.count_by(sure, "DESCCAR3", out="pieces")
        .unionByName(R.count_by(unsure, "CODART_A3", out="pieces").withColumnRenamed("CODART_A3", "DESCCAR3"))
    )


BEST_MATCH_CACHED = """
WITH m AS (
  SELECT CASE WHEN p_size > 10 THEN p_type ELSE '0' END AS DESCCAR3,
         CASE WHEN p_size > 10 THEN p_size * 2 END AS score
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
SELECT DESCCAR3, count(*) AS pieces FROM m WHERE score >= 85 OR score IS NULL GROUP BY DESCCAR3
"""


def clean_dataset(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    articles = part.select(
        F.col("p_partkey").alias("CODART"),
        F.when(F.col("p_type") == "PROMO", "PACKS")
        .when(F.col("p_type") == "SMALL", "TOBERAS")
        .when(F.col("p_type") == "LARGE", "")
        .when(F.col("p_type") != "MEDIUM", F.col("p_type"))
        .alias("DESCCAR3"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("DESCCAR2"),
        F.col("p_name").alias("article_name"),
    )
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("CODART_A3"),
        (F.col("l_quantity") * 2).cast("int").alias("Fuzzy_Score"),
        F.when(F.col("l_returnflag") == "R", "NO FUNCIONA NO FUNCIONA")
        .otherwise("no enciende")
        .alias("desc_problema_translated"),
        F.concat(F.lit("linea "), F.col("l_linestatus")).alias("descripcion_translated"),
        F.when(F.col("l_discount") > 0.05, F.lit("ruido al arrancar")).alias("problema_translated"),
    )
    return P.analysis_set(lines, articles).select(
        "l_orderkey", "l_linenumber", "CODART", "Fuzzy_Score", "DESCCAR3", "DESCCAR2", "text_to_analyse"
    )


CLEAN_DATASET = """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * 2 AS INTEGER) AS Fuzzy_Score,
    CASE WHEN l_returnflag = 'R' THEN 'NO FUNCIONA NO FUNCIONA' ELSE 'no enciende' END || ' linea '
    || l_linestatus || ' ' || CASE WHEN l_discount > 0.05 THEN 'ruido al arrancar' ELSE '' END
      AS text_to_analyse
  FROM lineitem)
SELECT l_orderkey, l_linenumber, p_partkey AS CODART, Fuzzy_Score, p_type AS DESCCAR3,
       CASE WHEN p_size > 5 THEN p_brand ELSE '' END AS DESCCAR2, text_to_analyse
FROM t JOIN part ON l_partkey = p_partkey
WHERE p_type NOT IN ('PROMO', 'SMALL', 'LARGE', 'MEDIUM') AND length(text_to_analyse) > 25
  AND length(replace(text_to_analyse, 'NO FUNCIONA', '')) > 25 AND Fuzzy_Score >= 85
"""

COMPANIES = {
    "1-URGENT": "CLIENT",
    "2-HIGH": "BASE",
    "3-MEDIUM": "FECHA",
    "4-NOT SPECIFIED": "CLIENT",
    "5-LOW": "BASE",
}


def _companies(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """One delivery-note table per company, each without one column."""
    orders = table(spark, d, "orders")
    return {
        name: orders.where(F.col("o_orderpriority") == name)
        .select(
            F.col("o_orderkey").alias("IDALBV"),
            F.concat(F.lit(" "), "o_orderstatus", F.lit("\t")).alias("SERIE"),
            F.col("o_orderdate").alias("FECHA"),
            F.col("o_totalprice").alias("BASE"),
            F.col("o_custkey").alias("CLIENT"),
        )
        .drop(missing)
        for name, missing in COMPANIES.items()
    }


def company_union(spark: SparkSession, d: str) -> DataFrame:
    union = U.union_tagged(_companies(spark, d), "Country")
    kept = C.in_series(union, "SERIE", ["F", "O"])
    return kept.withColumn("SERIE", S.strip("SERIE")).select("*", *S.year_month("FECHA"))


def _unless(column: str, name: str) -> str:
    gone = ", ".join(f"'{k}'" for k, v in COMPANIES.items() if v == name)
    return f"CASE WHEN o_orderpriority NOT IN ({gone}) THEN {column} END"


COMPANY_UNION = f"""
WITH u AS (
  SELECT o_orderpriority AS Country, o_orderkey AS IDALBV, o_orderstatus AS SERIE,
         {_unless("o_orderdate", "FECHA")} AS FECHA, {_unless("o_totalprice", "BASE")} AS BASE,
         {_unless("o_custkey", "CLIENT")} AS CLIENT
  FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT *, CAST(year(FECHA) AS INTEGER) AS "Year", CAST(month(FECHA) AS INTEGER) AS "Month" FROM u
"""


def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    return U.drift_report(_companies(spark, d), "Country")


SCHEMA_DRIFT = " UNION ALL ".join(
    f"""SELECT o_orderpriority AS Country, '{c}' AS "column",
    {"count(*)" if c in ("IDALBV", "SERIE") else f'count({_unless("1", c)})'} AS non_null,
    bool_and({"true" if c in ("IDALBV", "SERIE") else f"{_unless('1', c)} IS NOT NULL"}) AS present
    FROM orders GROUP BY o_orderpriority"""
    for c in ("IDALBV", "SERIE", "FECHA", "BASE", "CLIENT")
)


def singleton_order_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels from documents with exactly one line, joined through a number in a text."""
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("IDPEDV"), F.col("l_returnflag").alias("ERROR_POSTVENTA")
    )
    headers = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("IDPEDV"),
        F.concat(
            F.lit("SAV "), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit(" / "), "o_orderstatus"
        ).alias("NUMDOC"),
    )
    single = R.single_rows(lines, ["IDPEDV"])
    labels = J.lines_with_headers(single, headers, "IDPEDV", company=None)
    known = tickets(spark, d).select("codigo")
    return J.join_labels(known, labels, "codigo", "NUMDOC").where(
        F.col("ERROR_POSTVENTA").isNotNull()
    ).select("codigo", "NUMDOC", "ERROR_POSTVENTA")


SINGLETON_ORDER_LABELS = """
WITH one AS (SELECT l_orderkey, min(l_returnflag) AS flag FROM lineitem
             GROUP BY l_orderkey HAVING count(*) = 1)
SELECT o_orderkey AS codigo,
       'SAV ' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || ' / ' || o_orderstatus AS NUMDOC,
       flag AS ERROR_POSTVENTA
FROM orders JOIN one ON o_orderkey = l_orderkey WHERE flag IS NOT NULL
"""


def group_size(spark: SparkSession, d: str) -> DataFrame:
    sized = R.with_group_size(pieces(spark, d), "codigo_incidencia", "total_piezas")
    return sized.select("codigo_incidencia", "id", "cod_articulo", "total_piezas")


GROUP_SIZE = """
SELECT l_orderkey AS codigo_incidencia, l_linenumber AS id, l_partkey AS cod_articulo,
       count(*) OVER (PARTITION BY l_orderkey) AS total_piezas
FROM lineitem
"""


def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    train, test = C.split_by_date(tickets(spark, d), "modification_date", CUT)
    return U.union_tagged({"train": train, "test": test}, "side").select("codigo", "side")


TEMPORAL_SPLIT = f"""
SELECT o_orderkey AS codigo,
       CASE WHEN o_orderdate < TIMESTAMP '{CUT}' THEN 'train' ELSE 'test' END AS side
FROM orders WHERE o_orderdate IS NOT NULL
"""


def catalogue_gaps(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ID_ERROR"))
    ordering = table(spark, d, "orders").select(F.col("o_custkey").cast("double").cast("string").alias("ID_ERROR"))
    return J.missing_ids(customers, ordering, "ID_ERROR")


CATALOGUE_GAPS = """
SELECT CAST(c_custkey AS VARCHAR) AS ID_ERROR FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
"""


def _typed_parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Article texts typed with defects, and the catalogue of article texts."""
    part = table(spark, d, "part").withColumn(
        "full_name", F.concat_ws(" ", "p_brand", "p_type", "p_name")
    )
    catalogue = part.groupBy(F.col("full_name").alias("CODART")).agg(
        F.min("p_partkey").alias("catalogue_pos")
    )
    size = F.col("p_size")
    typed = (
        F.when(size < 10, F.upper(F.replace("full_name", F.lit(" "), F.lit("-"))))
        .when(size < 20, F.concat(F.substring("full_name", 1, 2), F.substring("full_name", 4, 1000)))
        .when(size < 30, F.concat_ws(" ", "p_name", "p_brand", "p_type"))
        .when(size < 40, F.concat("full_name", F.lit("s")))
        .otherwise(F.concat_ws(" ", "p_type", F.reverse("p_name")))
    )
    return part.select(typed.alias("cod_articulo")), catalogue


def fuzzy_best_match(spark: SparkSession, d: str) -> DataFrame:
    """The best entry of every typed text, however low its score."""
    return best_matches(*_typed_parts(spark, d))


def fuzzy_match_join(spark: SparkSession, d: str) -> DataFrame:
    """The best entry of the typed texts that reach the score asked of a sure article."""
    return matches_from(*_typed_parts(spark, d), threshold=85)


# Every pair of texts is scored. The subsequence of a pair whose common characters could do is found bit by bit: in v, the
# zeros left after all characters of one text are its length.
FUZZY_MATCH_JOIN = r"""
WITH parts AS (SELECT *, p_brand || ' ' || p_type || ' ' || p_name AS full_name FROM part),
typed AS (
  SELECT DISTINCT CASE WHEN p_size < 10 THEN upper(replace(full_name, ' ', '-'))
    WHEN p_size < 20 THEN substr(full_name, 1, 2) || substr(full_name, 4)
    WHEN p_size < 30 THEN p_name || ' ' || p_brand || ' ' || p_type
    WHEN p_size < 40 THEN full_name || 's'
    ELSE p_type || ' ' || reverse(p_name) END AS cod_articulo FROM parts),
cat AS (SELECT full_name AS entry, min(p_partkey) AS pos FROM parts GROUP BY ALL),
words AS (
  SELECT x, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(x), '[^\p{L}\p{N}_]+'), lambda t: t <> ''))) AS tokens
  FROM (SELECT cod_articulo AS x FROM typed UNION SELECT entry FROM cat)),
sized AS (
  SELECT x, tokens, array_to_string(tokens, ' ') AS text, length(array_to_string(tokens, ' ')) AS n,
         list_transform(string_split(' 0123456789abcdefghijklmnopqrstuvwxyz', ''),
           lambda c: length(array_to_string(tokens, ' ')) - length(replace(array_to_string(tokens, ' '), c, ''))) AS held
  FROM words),
a AS (SELECT DISTINCT tokens, text, n, held FROM typed JOIN sized ON cod_articulo = x),
e AS (SELECT tokens, text, n, held, min(pos) AS pos, arg_min(entry, pos) AS entry FROM cat JOIN sized ON entry = x GROUP BY ALL),
scored AS (
  SELECT a.text AS a, a.tokens AS ta, e.tokens AS te, a.n AS na, e.n AS ne, a.held AS ha, e.held AS he, pos, entry,
         list_sort(list_intersect(a.tokens, e.tokens)) AS shared
  FROM a JOIN e ON len(list_intersect(a.tokens, e.tokens)) > 0
    OR 200.0 * least(a.n, e.n) / (a.n + e.n) >= 84.5),
ruled AS (
  SELECT *, CASE WHEN len(shared) = 0 THEN 0.0 WHEN len(shared) IN (len(ta), len(te)) THEN 100.0
    ELSE 200.0 * length(array_to_string(shared, ' ')) / (length(array_to_string(shared, ' ')) + least(na, ne)) END AS score
  FROM scored),
near AS (
  SELECT a, pos, entry, na + ne AS total,
         string_split(array_to_string(list_concat(shared, list_filter(ta, lambda t: NOT list_contains(shared, t))), ' '), '') AS x,
         string_split(array_to_string(list_concat(shared, list_filter(te, lambda t: NOT list_contains(shared, t))), ' '), '') AS y
  FROM ruled WHERE score < 100 AND a NOT IN (SELECT a FROM ruled WHERE score = 100)
    AND 200.0 * least(na, ne) / (na + ne) >= 84.5
    AND 200.0 * list_sum(list_transform(list_zip(ha, he), lambda p: least(p[1], p[2]))) / (na + ne) >= 84.5),
subsequence AS (
  SELECT a, pos, entry, 200.0 * (len(y) - bit_count(list_reduce(
    list_prepend((1::HUGEINT << len(y)::HUGEINT) - 1, list_transform(x, lambda c: list_sum(list_transform(range(len(y)),
      lambda j: CASE WHEN y[j + 1] = c THEN 1::HUGEINT << j::HUGEINT ELSE 0::HUGEINT END))::HUGEINT)),
    lambda v, m: ((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << len(y)::HUGEINT) - 1)))) / total AS score
  FROM near),
best AS (
  SELECT a, arg_max(entry, (score, -pos)) AS entry, max(score) AS score FROM (
    SELECT a, pos, entry, score FROM ruled WHERE score >= 84.5
    UNION ALL SELECT a, pos, entry, score FROM subsequence WHERE score >= 84.5) GROUP BY a)
SELECT cod_articulo, best.entry AS CODART_A3, CAST(round_even(best.score, 0) AS INTEGER) AS Fuzzy_Score
FROM typed JOIN sized ON cod_articulo = x JOIN best ON a = text WHERE round_even(best.score, 0) >= 85
"""


QUERIES = {
    "ticket_piece_join": (ticket_piece_join, TICKET_PIECE_JOIN),
    "ticket_status": (ticket_status, TICKET_STATUS),
    "role_playing_dims": (role_playing_dims, ROLE_PLAYING_DIMS),
    "coerce_types": (coerce_types, COERCE_TYPES),
    "coercion_rejects": (coercion_rejects, COERCION_REJECTS),
    "scalar_functions": (scalar_functions, SCALAR_FUNCTIONS),
    "translation_fallback": (translation_fallback, TRANSLATION_FALLBACK),
    "translation_worklist": (translation_worklist, TRANSLATION_WORKLIST),
    "best_match_cached": (best_match_cached, BEST_MATCH_CACHED),
    "clean_dataset": (clean_dataset, CLEAN_DATASET),
    "company_union": (company_union, COMPANY_UNION),
    "schema_drift": (schema_drift, SCHEMA_DRIFT),
    "singleton_order_labels": (singleton_order_labels, SINGLETON_ORDER_LABELS),
    "group_size": (group_size, GROUP_SIZE),
    "temporal_split": (temporal_split, TEMPORAL_SPLIT),
    "catalogue_gaps": (catalogue_gaps, CATALOGUE_GAPS),
    "fuzzy_best_match": (fuzzy_best_match, None),
    "fuzzy_match_join": (fuzzy_match_join, FUZZY_MATCH_JOIN),
}
