"""The split reader against Spark's reader of whole files, on files that ranges cut anywhere."""

import random

import pytest

from faultline.sources import files as S
from faultline.sources.split_csv import csv_records, read_split_csv
from workload import files


@pytest.fixture
def small_ranges(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256MB")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def whole(spark, path, dialect=S.COMMA):
    return sorted(map(tuple, spark.read.options(**dialect.read_options()).csv(path).collect()), key=str)


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("sign", [",", "¬"])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_ranges, size, sign):
    rng = random.Random(size)
    for name in "abc":
        fields = ["plain", "", '"with ""quotes"" and\nbreaks"', f'"a{sign}b"', '"\n\n"', '"long ' + "x\n" * 60 + '"', "ñ¿", '""', " s "]
        # The other reader turns these into line feeds in files whose lines end so.
        fields += ['"\r\n"'] if name != "b" else []
        lines = [sign.join(["id", "text", "more"])]
        lines += [sign.join([str(i), *rng.choices(fields, k=2)]) for i in range(40)]
        ends = {"a": "\n", "b": "\r\n", "c": "\n"}[name]
        text = ends.join(lines) + (ends if name != "c" else "")
        (tmp_path / f"{name}.csv").write_bytes((b"\xef\xbb\xbf" if name == "b" else b"") + text.encode())
    dialect = S.CsvDialect(separator=sign)
    wanted = whole(spark, str(tmp_path), dialect)
    small_ranges(size)
    found = read_split_csv(spark, str(tmp_path), sign)
    assert found.columns == ["id", "text", "more"]
    assert sorted(map(tuple, found.collect()), key=str) == wanted and len(wanted) == 120


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "x.csv").write_text("k,v\n" + "".join(f'{i},"line\n{i}"\n' for i in range(500)))
    small_ranges(1000)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert csv_records(spark, str(tmp_path)).where("first").count() == 1
    rows = {r["k"]: r["v"] for r in read_split_csv(spark, str(tmp_path)).collect()}
    assert rows == {str(i): f"line\n{i}" for i in range(500)}


def test_without_header_and_empty_files(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n\n2,z')
    (tmp_path / "b.csv").write_text("")
    small_ranges(3)
    found = read_split_csv(spark, str(tmp_path), header=False, columns=["a", "b"])
    assert sorted(map(tuple, found.collect())) == [("1", "x\ny"), ("2", "z")]
    assert read_split_csv(spark, str(tmp_path / "b.csv")).collect() == []


def test_query_writes_and_reads_by_several_tasks(spark, tmp_path, small_ranges, monkeypatch):
    rows = [(i, f'line "{i}"\n' * 20, "es", 20 * i) for i in range(400)] + [(None, None, None, None), (7, "", "de", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    path = f"{tmp_path}/csv"
    monkeypatch.setattr(files, "shared_path", lambda *_: path)
    small_ranges(2_000)
    found = files.split_csv(spark, str(tmp_path))
    written = spark.read.format("binaryFile").load(path).where("length > 0").count()
    assert written > 3 and spark.read.text(path).rdd.getNumPartitions() >= 2 * written
    wanted = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("doc_id", "md5(text) AS text_md5", "lang", "n_chars")
    # An empty text and none are one and the same in these files.
    assert sorted(found.where("text_md5 is not null").collect()) == sorted(wanted.where("text != ''").collect())
    assert found.count() == len(rows)
