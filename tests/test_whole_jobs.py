"""Queries that must read their whole tables, on rows of their own."""

import duckdb
import pytest

import __spark_entry__ as driver
from tests.compare import difference

WORDS = {
    "de": "der hund und die katze schlafen nicht auf dem alten tisch",
    "en": "the dog and the cat do not sleep on that old table",
    "es": "el perro y la gata no duermen sobre aquella mesa vieja",
    "fr": "le chien et le chat ne dorment pas sur cette vieille table",
}


def database(folder, *tables):
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return connection


@pytest.fixture
def documents(spark, tmp_path):
    rows = [(i, text if i < 4 else " ".join(reversed(text.split())), lang, "src0") for i, (lang, text) in enumerate([*WORDS.items()] * 2)]
    rows += [(8, "hi", "en", "src1"), (9, None, "es", "src1"), (10, "la gata vieja no duerme", None, "src2"), (11, "la mesa vieja", "xx", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_catalogue_gaps_reads_orders_of_every_status(spark, tmp_path):
    customers = [(1,), (2,), (3,), (4,), (4,)]
    orders = [(1, "O"), (2, "P"), (3, "F"), (None, "P"), (9, "O")]
    spark.createDataFrame(customers, "c_custkey long").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_custkey long, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = driver.queries()["catalogue_gaps"](spark, str(tmp_path))
    assert [r["ID_ERROR"] for r in found.collect()] == ["4"]
    wanted = database(tmp_path, "customer", "orders").execute(driver.oracle_sql()["catalogue_gaps"]).fetchall()
    assert {r[0] for r in wanted} == {"4"}


def test_language_of_every_document(spark, documents):
    found = driver.queries()["language_id"](spark, documents)
    labels = {r["doc_id"]: r["language"] for r in found.collect()}
    assert labels == dict(enumerate([*WORDS] * 2)) | {8: "Too short", 9: "Too short", 10: "es", 11: "es"}
    assert difference(found, database(documents, "documents"), driver.oracle_sql()["language_id"]) is None


def test_corpus_keeps_languages_of_every_document(spark, documents):
    found = driver.queries()["corpus_languages"](spark, documents)
    assert sorted(r["doc_id"] for r in found.collect()) == [2, 6, 10, 11]
    assert difference(found, database(documents, "documents"), driver.oracle_sql()["corpus_languages"]) is None
