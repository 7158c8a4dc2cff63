import pytest
from pyspark.sql import functions as F

from faultline.sources import files as S
from faultline.sources.extract import TableSpec, extract_tables
from faultline.sources.jdbc import Database, parse_dates, projected
from faultline.streaming.translation_feed import feed_cache


def test_jdbc_options():
    server = Database("sqlserver", "h", "db", "u", "secret", instance="one")
    assert server.url == "jdbc:sqlserver://h:1433;databaseName=db;instanceName=one"
    assert "secret" not in repr(server)
    assert Database("mysql", "h", "db", "u", "p", 3307).url == "jdbc:mysql://h:3307/db"
    assert Database("oracle", "h", "svc", "u", "p").url == "jdbc:oracle:thin:@h:1521/svc"
    assert Database("clickhouse", "h", "", "u", "p").url.startswith("jdbc:clickhouse://h:8443/")
    options = server.options(query="SELECT 1", split=("id", 0, 100, 4))
    assert options["dbtable"] == "(SELECT 1) q" and options["numPartitions"] == "4" and "query" not in options
    assert server.options(table="t")["dbtable"] == "t" and server.options(query="q")["query"] == "q"
    with pytest.raises(ValueError):
        server.options()
    with pytest.raises(ValueError):
        Database("mysql", "h", "", "u", "p")
    with pytest.raises(ValueError):
        Database("other", "h", "db", "u", "p")


def test_projection_contract(spark):
    df = spark.createDataFrame([(1, "2024-01-01", None)], "a int, d string, e string")
    assert projected(df, ["d"], F.col("a") == 1).columns == ["d"]
    with pytest.raises(ValueError, match="zz"):
        projected(df, ["a", "zz"])
    assert parse_dates(df, ["d", "e"]).first()["d"].year == 2024
    assert parse_dates(df, {"d": "yyyy-MM-dd"}).first()["d"].month == 1


def test_extract_isolates_failures(spark, tmp_path):
    def load(spec):
        if spec.name == "bad":
            raise RuntimeError("unreachable")
        return spark.range(5).select("id", F.lit("x").alias("v"))

    specs = [
        TableSpec("good", ["id"], str(tmp_path / "good")),
        TableSpec("bad", ["id"], str(tmp_path / "bad")),
        TableSpec("narrow", ["zz"], str(tmp_path / "narrow")),
    ]
    report = {r["table"]: r for r in extract_tables(spark, specs, load).collect()}
    assert report["good"]["ok"] and report["good"]["rows"] == 5 and report["good"]["seconds"] >= 0
    assert not report["bad"]["ok"] and "unreachable" in report["bad"]["error"]
    assert "zz" in report["narrow"]["error"]
    assert spark.read.parquet(str(tmp_path / "good")).columns == ["id"]


def test_not_sign_csv_with_bom(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(
        '﻿t¬t_translated\n"a\nb"¬"say ""x"""\nt¬t_translated\nNA¬z\n'.encode()
    )
    table = S.read_translation_csv(spark, str(path), "t")
    assert table.columns == ["t", "t_translated"]
    assert [tuple(r) for r in table.collect()] == [("a\nb", 'say "x"'), (None, "z")]


def test_semicolon_csv(spark, tmp_path):
    faq = tmp_path / "faq.csv"
    faq.write_text('"<b>x</b>"\nplain\n', encoding="utf-8")
    dialect = S.CsvDialect(separator=";", header=False)
    assert [r[0] for r in S.read_text_csv(spark, str(faq), dialect, ["text_to_analyse"]).collect()] == ["<b>x</b>", "plain"]
    catalogue = tmp_path / "c.csv"
    catalogue.write_text("﻿A;B;C;D;E;F\n3.80;10;-;FAM;Motivo;\n", encoding="utf-8")
    row = S.read_catalogue(spark, str(catalogue)).first().asDict()
    assert row == {"ID_ERROR": "3.80", "CODCAR3": "10", "CODCAR2": "-", "DESCFAM": "FAM", "MOTIVO": "Motivo", "DESCRIPCION": None}


@pytest.mark.parametrize("dialect", [S.COMMA, S.COMMA_QUOTED, S.SEMICOLON, S.NOT_SIGN])
def test_csv_round_trip(spark, tmp_path, dialect):
    rows = [("a,b;c", 'quo"te'), ("line\nbreak", "ñ"), (None, "x"), (" blanks ", "\\ \t"), ("a\r\nb", "c\rd")]
    path = str(tmp_path / "deep" / "out")
    S.write_csv(spark.createDataFrame(rows, "k string, v string"), path, dialect)
    assert sorted(map(tuple, S.read_text_csv(spark, path, dialect).collect()), key=str) == sorted(rows, key=str)


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,peso,when\n1.0,2.5,2024-01-01\nx,,<NA>\n", encoding="utf-8")
    rows = S.read_typed_csv(spark, str(path), {"id": "int", "peso": "float", "when": "datetime64"}).collect()
    assert rows[0]["id"] == 1 and rows[0]["peso"] == 2.5 and rows[0]["when"].year == 2024
    assert tuple(rows[1]) == (None, None, None)


def test_cache_and_versions(spark, tmp_path):
    cache = str(tmp_path / "cache")
    schema = "t string, t_translated string"
    assert S.read_cache(spark, cache, schema).count() == 0
    S.append_cache(spark.createDataFrame([("a", "b")], schema), cache)
    S.append_cache(spark.createDataFrame([("c", "d")], schema), cache)
    assert S.read_cache(spark, cache, schema).count() == 2
    out = str(tmp_path / "corpus")
    S.write_version(spark.range(2), out, "2024-05-09")
    S.write_version(spark.range(3), out, "2024-06-01")
    S.write_version(spark.range(4), out, "2024-06-01")
    assert S.read_version(spark, out, "2024-05-09").count() == 2
    assert S.read_version(spark, out, "2024-06-01").count() == 4


def test_find_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for name in ("x.pdf", "a/y.pdf", "a/b/z.PDF", "a/b/w.txt"):
        (tmp_path / name).write_text("x")
    found = S.find_files(spark, str(tmp_path), ".pdf").collect()
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in found) == ["x.pdf", "y.pdf"]


def test_feed_translates_each_text_once(spark, tmp_path):
    inbox, cache = tmp_path / "in", str(tmp_path / "cache")
    inbox.mkdir()

    def make():
        return lambda texts: [t.upper() for t in texts]

    def feed(rows):
        spark.createDataFrame([(t,) for t in rows], "t string").coalesce(1).write.mode("append").parquet(str(inbox))
        stream = spark.readStream.schema("t string").parquet(str(inbox))
        feed_cache(stream, "t", cache, str(tmp_path / "state"), make).awaitTermination(120)

    feed(["a", "b", "a", None])
    feed(["b", "c"])
    rows = S.read_cache(spark, cache, "t string, t_translated string, error string").collect()
    assert sorted((r["t"], r["t_translated"]) for r in rows) == [("a", "A"), ("b", "B"), ("c", "C")]


def test_not_sign_files_begin_with_a_mark(spark, tmp_path):
    path = str(tmp_path / "signs")
    S.write_csv(spark.createDataFrame([("1", "a¬b"), ("2", None)], "k string, v string"), path, S.NOT_SIGN)
    parts = [p.read_bytes() for p in (tmp_path / "signs").glob("*.csv")]
    assert parts and all(p.startswith(b"\xef\xbb\xbfk\xc2\xacv\n") for p in parts if p)
    back = S.read_text_csv(spark, path, S.NOT_SIGN)
    assert back.columns == ["k", "v"] and sorted(map(tuple, back.collect())) == [("1", "a¬b"), ("2", None)]
