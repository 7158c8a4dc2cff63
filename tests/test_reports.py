import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import reports as R
from faultline.operators import reshape as U
from faultline.plans.ordering import position, running_total


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_running_total_and_position(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("hot"), (F.col("id") % 7).alias("v"))
    found = running_total(df, [F.desc("v"), F.asc("id")], F.col("v"), "total").toPandas()
    wanted = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
    wanted["total"] = wanted["v"].cumsum()
    merged = found.merge(wanted, on="id")
    assert len(merged) == 1000 and (merged["total_x"] == merged["total_y"]).all()
    placed = position(df, [F.asc("id")], "at", ["hot"]).toPandas().sort_values("id")
    assert (placed["at"] == placed.groupby("hot").cumcount()).all()


def test_pareto_ties_and_top(spark):
    counts = spark.createDataFrame([("b", 5), ("a", 5), ("c", 10)], "k string, n int")
    full = sorted(rows(R.pareto(counts, "n", "k"), "cumsum", "k", "cum_share"))
    assert full == [(10, "c", 50.0), (15, "a", 75.0), (20, "b", 100.0)]
    total = spark.createDataFrame([(40,)], "t int")
    top = sorted(rows(R.pareto(counts, "n", "k", top=2, total=total), "cumsum", "k", "cum_share"))
    assert top == [(10, "c", 25.0), (15, "a", 37.5)]
    assert R.pareto(counts, "n", "k", top=9).count() == 3


def test_counts_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0), ("b", None)], "k string, v double")
    assert rows(R.count_by(df, "k"), "k", "count") == [("a", 2), ("b", 1)]
    assert sorted(rows(R.present_by(df, "k", "v"), "k", "count")) == [("a", 1), ("b", 0)]
    assert sorted(rows(R.sum_by(df, ["k"], "v", "s"), "k", "s")) == [("a", 1.0), ("b", 0.0)]
    assert rows(R.distinct_count(df, "k"), "distinct") == [(2,)]
    assert rows(R.distinct_count(df, "k", approximate=True), "distinct") == [(2,)]
    shares = dict(rows(R.with_share(R.count_by(df, "k"), "count"), "k", "share"))
    assert shares["a"] == pytest.approx(2 / 3)


def test_group_size_and_single_rows(spark):
    df = spark.createDataFrame([("ES", 1, "x"), ("FR", 1, "y"), ("ES", 2, "z"), ("ES", 2, "w"), ("ES", None, "n")], "c string, id int, v string")
    sized = {r["v"]: r["group_size"] for r in R.with_group_size(df, "id").collect()}
    assert sized == {"x": 2, "y": 2, "z": 2, "w": 2, "n": None}
    assert sorted(rows(R.single_rows(df, ["c", "id"]), "c", "id", "v")) == [("ES", 1, "x"), ("FR", 1, "y")]
    assert R.single_rows(df, ["id"]).count() == 0


def test_last_period(spark):
    df = spark.createDataFrame([(2023, 12, 1.0), (2024, 1, 2.0), (2024, 2, 3.0)], "Year int, Month int, v double")
    assert sorted(rows(R.without_last_period(df, ["Year", "Month"]), "Year", "Month")) == [(2023, 12), (2024, 1)]


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", 1, 9.0), ("a", 2, 9.0), ("a", 3, 8.0), ("b", 4, 1.0)], "g string, id int, s double")
    found = R.top_per_group(df, "g", [F.desc("s"), F.asc("id")], 2)
    assert sorted(rows(found, "g", "id", "rank")) == [("a", 1, 1), ("a", 2, 2), ("b", 4, 1)]
    assert rows(R.top_rows(df, "s", "id", 2), "id") == [(1,), (2,)]
    assert R.sample_rows(df, 3, 1).collect() == R.sample_rows(df, 3, 1).collect()


def test_profile_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"n": rng.integers(0, 50, 500).astype(float), "s": rng.choice(list("abc"), 500)})
    pdf.loc[::11, "n"] = None
    df = spark.createDataFrame(pdf).select(F.when(~F.isnan("n"), F.col("n")).alias("n"), "s")
    found = {r["column"]: r for r in R.profile(df).collect()}
    stats = pdf["n"].describe()
    for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
        assert found["n"][ours] == pytest.approx(stats[theirs])
    assert found["s"]["freq"] == pdf["s"].value_counts().max() and found["s"]["mean"] is None
    assert found["s"]["unique"] == 3 and found["s"]["q50"] is None


def test_null_profile_and_funnel(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert sorted(rows(R.null_profile(df), "column", "rows", "non_null", "nulls")) == [("a", 2, 2, 0), ("b", 2, 1, 1)]
    rules = {"all": F.lit(True), "b": F.col("b") == "x"}
    assert sorted(rows(R.funnel(df, rules), "rule", "rows", "percent")) == [("all", 2, 100.0), ("b", 1, 50.0)]


def test_union_and_drift(spark):
    tables = {
        "ES": spark.createDataFrame([(1, "x")], "id int, only_es string"),
        "FR": spark.createDataFrame([(1, None), (1, None)], "id int, only_fr string"),
    }
    union = U.union_tagged(tables, "Country")
    assert union.count() == 3 and set(union.columns) == {"id", "only_es", "only_fr", "Country"}
    drift = {(r["Country"], r["column"]): (r["non_null"], r["present"]) for r in U.drift_report(tables, "Country").collect()}
    assert drift[("ES", "only_es")] == (1, True)
    assert drift[("ES", "only_fr")] == (0, False)
    assert drift[("FR", "only_fr")] == (0, True)


def test_slots(spark):
    slots = {f"s{i}_{r}": (i, r) for i in (1, 2) for r in ("serial", "error")}
    wide = spark.createDataFrame([(1, "a", "e", "b", None), (2, None, None, None, None)], "id int, s1_serial string, s1_error string, s2_serial string, s2_error string")
    long = U.unpivot_slots(wide, ["id"], list(slots))
    number, role = U.slot_of("variable", slots)
    long = long.withColumns({"slot": number, "role": role})
    assert sorted(rows(long, "slot", "role", "value")) == [(1, "error", "e"), (1, "serial", "a"), (2, "serial", "b")]
    assert U.duplicate_cells(long, ["id", "slot"], "role").count() == 0
    back = U.pivot_slots(long, ["id", "slot"], "role", ["serial", "error"])
    assert sorted(rows(back, "id", "slot", "serial", "error"), key=str) == [(1, 1, "a", "e"), (1, 2, "b", None)]
    odd = spark.createDataFrame([("other",)], "variable string").select(number.alias("n"), role.alias("r"))
    assert rows(odd, "n", "r") == [(None, "unknown")]


def test_cluster_columns(spark):
    df = spark.createDataFrame([(0, "b"), (0, "a"), (1, "c"), (2, "z")], "cluster int, m string")
    wide = sorted(rows(U.cluster_columns(df, "cluster", "m", [0, 1]), "position", "Cluster_0", "Cluster_1"))
    assert wide == [(0, "a", "c"), (1, "b", None)]
