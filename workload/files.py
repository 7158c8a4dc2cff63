"""Tables written to files and read back: CSV dialects, caches, versions, the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import similarity as M
from faultline.operators.cleaning import by_key
from faultline.operators.translation import translate_texts, untranslated
from faultline.plans.durable import shared_path
from faultline.sources import files as S
from faultline.sources.split_csv import read_split_csv
from faultline.sources.extract import TableSpec, extract_tables
from workload import texts as X
from workload.tables import table
from workload.vectors import _CATALOGUE_SQL, _six, prototypes


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents through two CSV dialects, typed on the way back."""
    documents = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    plain, signs = shared_path(spark, "csv"), shared_path(spark, "csv")
    S.write_csv(documents, plain, S.COMMA_QUOTED)
    S.write_csv(S.read_text_csv(spark, plain), signs, S.NOT_SIGN)
    types = {"doc_id": "int", "n_chars": "int", "text": "str", "lang": "str"}
    back = S.read_typed_csv(spark, signs, types, S.NOT_SIGN)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "n_chars")


CSV_ROUND_TRIP = "SELECT doc_id, md5(text) AS text_md5, lang, n_chars FROM documents"


def split_csv(spark: SparkSession, d: str) -> DataFrame:
    """Documents with line breaks in quoted fields, read back by several tasks a file."""
    path = shared_path(spark, "csv")
    documents = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    # Two splits of the scan make a file, as one of them may fit into one range when it is read back.
    files = max(1, documents.rdd.getNumPartitions() // 2)
    S.write_csv(documents.coalesce(files), path, S.COMMA_QUOTED)
    back = read_split_csv(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", F.col("n_chars").cast("long").alias("n_chars"))


SPLIT_CSV = "SELECT doc_id, md5(text) AS text_md5, lang, CAST(n_chars AS BIGINT) AS n_chars FROM documents"


def catalogue_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue file whose header says other names, found by its suffix, scanned by position, one entry looked up."""
    path = shared_path(spark, "catalogue")
    label = F.col("label")
    entries = table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n")).select(
        label.alias("a"), (label % 3).alias("b"), (label % 2).alias("c"), F.concat(F.lit("familia "), label.cast("string")).alias("d"),
        F.concat(F.lit("motivo; "), label.cast("string")).alias("e"), F.col("n").cast("string").alias("f"),
    )
    S.write_csv(entries, path, S.SEMICOLON)
    files = S.find_files(spark, path, ".csv")
    catalogue = S.read_catalogue(spark, path).where(F.col("ID_ERROR").isNotNull())
    chosen = by_key(catalogue, "ID_ERROR", "3")
    return chosen.select("*", F.lit(files.where("length > 0").count() > 0).alias("found"))


CATALOGUE_ROUND_TRIP = """
SELECT CAST(label AS VARCHAR) AS ID_ERROR, CAST(label % 3 AS VARCHAR) AS CODCAR3, CAST(label % 2 AS VARCHAR) AS CODCAR2,
       'familia ' || label AS DESCFAM, 'motivo; ' || label AS MOTIVO, CAST(count(*) AS VARCHAR) AS DESCRIPCION, true AS found
FROM embeddings WHERE label = 3 GROUP BY label
"""


def cached_translations(spark: SparkSession, d: str) -> DataFrame:
    """Two runs against an append-only cache; the second finds nothing left of the first."""
    path = shared_path(spark, "cache")
    schema = "text string, text_translated string, error string"
    documents = table(spark, d, "documents").select("lang", "text")
    for languages in (("fr",), ("fr", "de")):
        work = documents.where(F.col("lang").isin(*languages))
        fresh = untranslated(work, S.read_cache(spark, path, schema), "text")
        S.append_cache(translate_texts(fresh, "text", X._shouting, 50), path)
    cache = S.read_cache(spark, path, schema)
    return cache.select(F.md5("text").alias("text_md5"), F.md5("text_translated").alias("translated_md5"))


CACHED_TRANSLATIONS = """
SELECT DISTINCT md5(text) AS text_md5, md5('es: ' || text) AS translated_md5
FROM documents WHERE lang IN ('fr', 'de') AND text IS NOT NULL
"""


def versioned_corpus(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of a corpus in one folder; one is read."""
    path = shared_path(spark, "corpus")
    documents = table(spark, d, "documents").select("doc_id", "lang")
    S.write_version(documents.where(F.col("lang") == "es"), path, "2024-05-09")
    S.write_version(documents, path, "2024-06-01")
    return S.read_version(spark, path, "2024-05-09").select("doc_id", "lang")


VERSIONED_CORPUS = "SELECT doc_id, lang FROM documents WHERE lang = 'es'"


def extract_report(spark: SparkSession, d: str) -> DataFrame:
    """Extraction of four tables, of which one lacks a configured column."""
    specs = [
        TableSpec("orders", ["o_orderkey", "o_custkey"], shared_path(spark, "orders")),
        TableSpec("lineitem", ["l_orderkey", "l_partkey"], shared_path(spark, "lineitem")),
        TableSpec("nation", ["n_nationkey", "n_absent"], shared_path(spark, "nation")),
        TableSpec("customer", ["c_custkey", "c_name"], shared_path(spark, "customer")),
    ]
    report = extract_tables(spark, specs, lambda spec: table(spark, d, spec.name))
    return report.select("table", "rows", "ok")


EXTRACT_REPORT = """
SELECT 'orders' AS "table", count(*) AS "rows", true AS ok FROM orders
UNION ALL SELECT 'lineitem', count(*), true FROM lineitem
UNION ALL SELECT 'nation', NULL, false
UNION ALL SELECT 'customer', count(*), true FROM customer
"""


def vector_table_search(spark: SparkSession, d: str) -> DataFrame:
    """Search in a stored vector table; only the families asked for are read."""
    path = shared_path(spark, "vectors")
    collection = table(spark, d, "embeddings").select(
        "vec_id", "embedding", F.col("label").alias("error"), (F.col("label") % 3).alias("family")
    )
    M.write_vectors(collection, path)
    asked = prototypes(spark, d).where(F.col("CODCAR3") == 1).select(
        F.col("label").alias("query_id"), F.col("CODCAR3").alias("family"), "vector"
    )
    hits = M.nearest(spark.read.parquet(path), asked, 20, "vec_id", "embedding", "family", ["error"])
    return _six(hits).select("query_id", "rank", "vec_id", "error", "score")


# Stored vectors are unit vectors of single precision.
VECTOR_TABLE_SEARCH = f"""
WITH {_CATALOGUE_SQL},
stored AS (
  SELECT vec_id, label, CAR3, list_transform(vector, lambda x: CAST(x / sqrt(list_dot_product(vector, vector)) AS FLOAT))::DOUBLE[] AS v
  FROM tickets),
s AS (SELECT c.label AS query_id, vec_id, t.label AS error, round(list_cosine_similarity(t.v, c.vector), 9) AS score
      FROM stored t JOIN catalogue c ON t.CAR3 = c.CODCAR3 WHERE c.CODCAR3 = 1),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, error, round(score, 6) AS score FROM r WHERE rank <= 20
"""

QUERIES = {
    "csv_round_trip": (csv_round_trip, CSV_ROUND_TRIP),
    "split_csv": (split_csv, SPLIT_CSV),
    "catalogue_round_trip": (catalogue_round_trip, CATALOGUE_ROUND_TRIP),
    "cached_translations": (cached_translations, CACHED_TRANSLATIONS),
    "versioned_corpus": (versioned_corpus, VERSIONED_CORPUS),
    "extract_report": (extract_report, EXTRACT_REPORT),
    "vector_table_search": (vector_table_search, VECTOR_TABLE_SEARCH),
}
