from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from faultline.functions import scalars as S
from faultline.operators import cleaning as C


def one(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression("v")).collect()]


def test_integers(spark):
    values = ["12.0", "1,5", "1.5", "abc", "", "<NA>", "NaT", "None", None, " 7 ", "9007199254740993", "inf", "1e3"]
    assert one(spark, values, S.to_integer) == [
        12, None, None, None, None, None, None, None, None, 7, 9007199254740993, None, 1000
    ]


def test_floats(spark):
    assert one(spark, ["1.5", "1,5", "x", None], S.to_float) == [1.5, None, None, None]
    assert one(spark, ["1,5", "1.5", "x", None], S.to_float_comma) == [1.5, 1.5, None, None]


def test_numbers_like_pandas(spark):
    texts = [
        "1d", "1f", "12D", "5.F", "0x1p3", "0x10", "inf", "-Infinity", "nan", "NaN", " 1 ", "1e5", "+3",
        ".5", "5.", "1,000", "1e400", "--1", "", "1 2", "1\t", "true", "1L", "12s", "9" * 25, "-0.25e-3",
    ]
    wanted = pd.to_numeric(pd.Series(texts), errors="coerce")
    found = one(spark, texts, S.to_float)
    assert [None if pd.isna(w) else float(w) for w in wanted] == found


def test_timestamps(spark):
    values = ["2024-05-09 10:11:12", "2024-05-09", "2024-05-09T01:02:03", "2024-13-40", "soon", None]
    found = one(spark, values, S.to_timestamp)
    assert found == [datetime(2024, 5, 9, 10, 11, 12), datetime(2024, 5, 9), datetime(2024, 5, 9, 1, 2, 3), None, None, None]


def test_texts(spark):
    assert one(spark, ["a", "nan", "NaT", "None", "<NA>", "", None], S.to_text) == [
        "a", None, None, None, None, "", None
    ]
    assert one(spark, [12.0, None, float("nan")], lambda c: S.to_text(c, True), "double") == ["12", None, None]


def test_keys(spark):
    assert one(spark, ["a 12345678 b", "1234567", "123456789", None, ""], S.first_digits) == [
        "12345678", None, "12345678", None, None
    ]
    assert one(spark, ["12.0", "12", "x"], S.key_text) == ["12", "12", None]
    assert one(spark, ["3.80", "3.8", "3.00", "10", "x"], S.id_text) == ["3.8", "3.8", "3", "10", None]
    assert one(spark, ["-", "262", "x"], S.dash_to_zero) == [0, 262, None]
    assert one(spark, ["score_max_3.8", "none"], S.last_part) == ["3.8", "none"]
    assert one(spark, [" \tFA \n", None], S.strip) == ["FA", None]


def test_joined_text_keeps_empty_parts(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in df.select(S.joined_text("x", "y", "z")).collect()] == ["a  c", "  "]


def test_convert_types_and_rejects(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01", "x", 1.0), ("1.5", "bad", "nan", None), ("", None, None, 3.0)],
        "n string, d string, t string, f double",
    )
    types = {"n": "int", "d": "datetime64", "t": "str", "f": "str", "absent": "int"}
    rows = C.convert_types(df, types).collect()
    assert [r["n"] for r in rows] == [1, None, None]
    assert [r["f"] for r in rows] == ["1", None, "3"]
    assert [r["t"] for r in rows] == ["x", None, None]
    rejects = {r["column"]: (r["present"], r["rejected"]) for r in C.reject_counts(df, types).collect()}
    assert rejects == {"n": (3, 1), "d": (2, 1), "t": (2, 0), "f": (2, 0)}


def test_warranty_filter(spark):
    rows = [
        (1, 2, "2024-05-08"), (1, 6, "2024-05-09"), (2, 2, "2024-01-01"), (1, 3, "2024-01-01"),
        (1, 6, None), (None, 2, "2024-01-01"), (1, 6, "2023-01-01"),
    ]
    df = spark.createDataFrame(rows, "tipo int, estado int, d string").withColumn(
        "modification_date", F.col("d").cast("timestamp_ntz")
    )
    assert [r["d"] for r in C.warranty_tickets(df, before="2024-05-09").collect()] == ["2024-05-08", "2023-01-01"]
    assert C.warranty_tickets(df).count() == 4


def test_exclusions(spark):
    families = ["TOBERAS", "PACKS", None, "", "TERMOSTATOS", "toberas"]
    df = spark.createDataFrame([(f,) for f in families], "f string")
    assert [r[0] for r in C.exclude_families(df, "f").collect()] == ["TERMOSTATOS", "toberas"]
    assert [r[0] for r in C.exclude_families(df, "f", special=False).collect()] == ["PACKS", "TERMOSTATOS", "toberas"]
    assert df.where(C.not_in("f", ["TOBERAS"])).count() == 5
    assert df.where(C.not_in("f", ["TOBERAS", None])).count() == 4


def test_lengths(spark):
    texts = ["x" * 25, "x" * 26, "NO FUNCIONA " * 5, "no funciona " * 5, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.where(C.long_enough("t")).select("i").collect()] == [1, 3]


def test_scores(spark):
    df = spark.createDataFrame([(84,), (85,), (None,)], "s int")
    assert [r[0] for r in C.scored(df, "s").collect()] == [85]


def test_header_rows(spark):
    df = spark.createDataFrame([("a",), ("h",), (None,)], "h string")
    assert [r[0] for r in C.without_header_rows(df, "h").collect()] == ["a", None]


def test_split(spark):
    df = spark.createDataFrame([("2024-04-15",), ("2024-04-16",), (None,)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("d")
    )
    before, after = C.split_by_date(df, "d", "2024-04-16")
    assert (before.count(), after.count()) == (1, 1)


def test_predicates_and_fills(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "a", "b")], "i int, a string, b string")
    assert [r[0] for r in df.where(C.any_present(["a", "b"])).select("i").collect()] == [1, 3]
    assert [r[0] for r in df.where(C.all_present(["a", "b"])).select("i").collect()] == [3]
    assert [r["a"] for r in C.fill_from(df, "a", "b").collect()] == ["x", None, "a"]
    assert [r["b"] for r in C.fill_text(df).collect()] == ["x", "", "b"]
    assert [r["i"] for r in C.by_key(df, "i", 2).collect()] == [2]
    series = spark.createDataFrame([(" FA\t",), ("AB",), (None,)], "s string")
    assert C.in_series(series, "s", ["FA"]).count() == 1
