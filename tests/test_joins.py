from pyspark.sql import functions as F

from faultline.operators import joins as J


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_pieces(spark):
    tickets = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), (None, 4)], "codigo string, id int")
    pieces = spark.createDataFrame(
        [("A", 10), ("B", 20), ("B", 21), ("B", 22), ("X", 30), (None, 40)], "codigo_incidencia string, id int"
    )
    joined = J.join_pieces(tickets, pieces)
    assert joined.columns == ["codigo", "id", "codigo_incidencia", "id_pieza"]
    assert rows(joined, "codigo", "id", "id_pieza") == sorted(
        [("A", 1, 10), ("B", 2, 20), ("B", 2, 21), ("B", 2, 22), ("C", 3, None), (None, 4, None)], key=str
    )


def test_status_suffixes(spark):
    tickets = spark.createDataFrame([(1, 2, 1), (2, 9, None)], "id int, estado int, tipo int")
    states = spark.createDataFrame([(2, "Validado")], "id int, titulo_es string")
    types = spark.createDataFrame([(1, "Garantia")], "id int, titulo_es string")
    joined = J.join_status(tickets, states, types)
    assert joined.columns == ["id", "estado", "tipo", "id_estado", "titulo_es", "id_tipo", "titulo_es_tipo"]
    assert rows(joined, "id", "titulo_es", "titulo_es_tipo") == [(1, "Validado", "Garantia"), (2, None, None)]


def test_null_safe_lookup(spark):
    left = spark.createDataFrame([(None,), ("a",)], "k string")
    right = spark.createDataFrame([(None, 1), ("a", 2)], "key string, v int")
    assert rows(J.left_lookup(left, right, "k", "key", "_r"), "k", "v") == [("a", 2), (None, None)]
    assert rows(J.left_lookup(left, right, "k", "key", "_r", null_safe=True), "k", "v") == [("a", 2), (None, 1)]


def test_role_lookups(spark):
    articles = spark.createDataFrame(
        [("x", "1", "1", None, "5")], "CODART string, CAR1 string, CAR2 string, CAR3 string, CAR4 string"
    )
    dims = spark.createDataFrame(
        [(1, "A", "1", "one"), (2, "B", "1", "wrong kind"), (4, "A", "5", "five"), (4, "A", "5", "cinq")],
        "NUMCAR int, TIPCAR string, CODCAR string, DESCCAR string",
    )
    found = J.role_lookups(articles, dims)
    assert rows(found, "DESCCAR1", "DESCCAR2", "DESCCAR3", "DESCCAR4") == [
        ("one", None, None, "cinq"), ("one", None, None, "five")
    ]


def test_texts_of_one_fingerprint_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(J, "_fingerprint", lambda text: [F.when(J.S.col(text).isNotNull(), F.lit(n).cast("long")) for n in (1, 2)])
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (5, "a")], "i int, t string")
    cache = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("b", "z"), ("t", "t_translated"), (None, "n"), ("c", None)], "t string, t_translated string"
    )
    found = {r["i"]: r["t_translated"] for r in J.with_translation(df, cache, "t").collect()}
    assert found == {1: "x", 2: "z", 3: None, 4: "c", 5: "x"}


def test_no_text_is_sorted_or_grouped_by_itself(spark):
    df = spark.createDataFrame([(1, "a")], "i int, t string")
    cache = spark.createDataFrame([("a", "y")], "t string, t_translated string")
    plan = J.with_translation(df, cache, "t")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert not [line for line in plan.splitlines() if " Sort [" in line and ("Sort [t#" in line or "text" in line)]


def test_translations(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "hola"), (3, None), (4, "bye")], "i int, t string")
    cache = spark.createDataFrame(
        [("hello", "hola"), ("hello", "hola2"), ("t", "t_translated"), ("bye", None), (None, "nada")],
        "t string, t_translated string",
    )
    assert rows(J.with_translation(df, cache, "t"), "i", "t_translated") == [
        (1, "hola"), (2, "hola"), (3, None), (4, "bye")
    ]
    worklist = spark.createDataFrame([("hello",), ("bye",)], "t string")
    assert rows(J.worklist_translation(df, worklist, cache, "t"), "i", "t_translated") == [
        (1, "hola"), (2, None), (3, None), (4, "bye")
    ]


def test_cached_match(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "cod_articulo string")
    cache = spark.createDataFrame(
        [("a", "A", 90), ("a", "A", 90)], "cod_articulo string, CODART_A3 string, Fuzzy_Score int"
    )
    assert rows(J.with_cached_match(df, cache), "cod_articulo", "CODART_A3", "Fuzzy_Score") == [
        ("a", "A", 90), ("b", "0", None), (None, "0", None)
    ]


def test_lines_with_headers(spark):
    lines = spark.createDataFrame([("ES", 1, "l1"), ("FR", 1, "l2"), ("ES", 2, "l3")], "Country string, IDPEDV int, E string")
    heads = spark.createDataFrame([("ES", 1, "h1"), ("FR", 1, "h2")], "Country string, IDPEDV int, E string")
    assert rows(J.lines_with_headers(lines, heads, "IDPEDV"), "E", "E_y") == [("l1", "h1"), ("l2", "h2"), ("l3", None)]
    by_id = J.lines_with_headers(lines, heads, "IDPEDV", company=None)
    assert by_id.count() == 5


def test_monthly_outer(spark):
    a = spark.createDataFrame([(2024, 1, 5.0)], "Year int, Month int, BASE double")
    b = spark.createDataFrame([(2024, 2, 7.0)], "Year int, Month int, BASE double")
    joined = J.monthly_outer(a, b, ["Year", "Month"], "BASE", ("_sales", "_after_sales"))
    assert rows(joined, "Month", "BASE_sales", "BASE_after_sales") == [(1, 5.0, None), (2, None, 7.0)]


def test_missing_ids(spark):
    catalogue = spark.createDataFrame([("3.80",), ("3.85",), ("3.85",)], "ID string")
    known = spark.createDataFrame([("3.8",), ("3.88",)], "ID string")
    assert rows(J.missing_ids(catalogue, known, "ID"), "ID") == [("3.85",)]


def test_labels_by_number(spark):
    tickets = spark.createDataFrame([(12345678,), (5,)], "codigo long")
    labels = spark.createDataFrame([("SAV 12345678", "E1"), ("none", "E2")], "NUMDOC string, E string")
    assert rows(J.join_labels(tickets, labels, "codigo", "NUMDOC"), "codigo", "E") == [(12345678, "E1"), (5, None)]


def test_hot_ticket_is_whole(spark):
    tickets = spark.range(5).select(F.col("id").alias("codigo"))
    pieces = spark.range(3000).select(
        F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 4).cast("long").alias("codigo_incidencia"),
        F.col("id").alias("piece"),
    )
    joined = J.join_pieces(tickets, pieces)
    assert joined.count() == 3001 and joined.select("piece").distinct().count() == 3001
