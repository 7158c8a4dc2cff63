import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from faultline.functions import vectors as N
from faultline.operators import clustering as G
from faultline.operators import evaluation as E
from faultline.operators import features as V
from faultline.operators import similarity as M


def test_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    row = df.select(N.dot("a", "b"), N.norm("a"), N.cosine("a", "b"), N.cosine("a", "z"), N.unit("a"), N.unit("z"), N.stacked("a", "b")).first()
    assert row[0] == 24 and row[1] == 5 and row[2] == pytest.approx(0.96) and row[3] == 0
    assert row[4] == [0.6, 0.8] and row[5] == [0.0, 0.0] and row[6] == [3, 4, 4, 3]
    text = spark.createDataFrame([("[0.5  -1e-2\n3]",), ("[x 1]",), (None,)], "t string")
    parsed = [r[0] for r in text.select(N.parse_vector("t")).collect()]
    assert parsed[0] == pytest.approx([0.5, -0.01, 3.0]) and parsed[1] == [None, 1.0] and parsed[2] is None
    wide = df.select(*N.vector_columns("a", 3)).first()
    assert wide.asDict() == {"vector_0": 3.0, "vector_1": 4.0, "vector_2": None}


@pytest.fixture
def catalogue(spark):
    rows = [
        ("E1", 1, 0, 0, [1.0, 0.0]), ("E2", 1, 262, 1, [0.0, 1.0]), ("E3", 2, 0, 2, [1.0, 0.0]), ("E4", 1, 0, 3, [1.0, 0.0]),
    ]
    return spark.createDataFrame(rows, "ID_ERROR string, CODCAR3 int, CODCAR2 int, catalogue_pos int, vector array<double>")


TICKETS = [
    ("t1", 1, 262, [0.1, 1.0]),   # the system's own error
    ("t2", 1, 264, [0.1, 1.0]),   # only errors of any system, tied: first in file order
    ("t3", 9, 0, [1.0, 1.0]),     # no applicable error
    ("t4", 1, 262, [-1.0, -1.0]), # all scores negative
    ("t5", 1, 0, [0.0, 0.0]),     # zero vector
    ("t6", None, None, [1.0, 0.0]),
]


@pytest.mark.parametrize("limit", [10_000, 1])
def test_classify(spark, catalogue, monkeypatch, limit):
    monkeypatch.setattr(M, "MAX_CATALOGUE_ROWS", limit)
    tickets = spark.createDataFrame(TICKETS, "id string, CAR3 int, CAR2 int, vector array<double>")
    found = {r["id"]: (r["ID_ERROR"], r["score"]) for r in M.classify(tickets, catalogue, "id").collect()}
    assert found["t1"] == ("E2", pytest.approx(1 / 1.01**0.5))
    assert found["t2"] == ("E1", pytest.approx(0.1 / 1.01**0.5))
    assert found["t3"] == found["t6"] == (None, None)
    assert found["t4"] == ("E1", pytest.approx(-(0.5**0.5)))
    assert found["t5"] == ("E1", 0.0)


@pytest.mark.parametrize("limit", [10_000, 1])
def test_classify_repeated_keys(spark, catalogue, monkeypatch, limit):
    monkeypatch.setattr(M, "MAX_CATALOGUE_ROWS", limit)
    rows = [("b", 1, 264, [1.0, 0.0]), ("b", 1, 262, [0.0, 1.0]), ("b", 1, 262, None), (None, 2, 0, [1.0, 0.0])]
    tickets = spark.createDataFrame(rows, "id string, CAR3 int, CAR2 int, vector array<double>")
    found = [tuple(r) for r in M.classify(tickets, catalogue, "id").collect()]
    assert sorted(found, key=str) == sorted([("b", "E1", 1.0), ("b", "E2", 1.0), ("b", None, None), (None, "E3", 1.0)], key=str)


@pytest.mark.parametrize("limit", [10_000, 1])
def test_classify_compat(spark, catalogue, monkeypatch, limit):
    monkeypatch.setattr(M, "MAX_CATALOGUE_ROWS", limit)
    tickets = spark.createDataFrame(TICKETS, "id string, CAR3 int, CAR2 int, vector array<double>")
    found = {r["id"]: r["ID_ERROR"] for r in M.classify(tickets, catalogue, "id", compat=True).collect()}
    assert found == {"t1": "E2", "t2": "E1", "t3": "E1", "t4": "E3", "t5": "E1", "t6": "E1"}


def test_pairs(spark, catalogue):
    tickets = spark.createDataFrame(TICKETS, "id string, CAR3 int, CAR2 int, vector array<double>")
    pairs = M.score_pairs(tickets, catalogue, "id")
    assert pairs.where("id = 't1'").count() == 3 and pairs.where("id = 't2'").count() == 2
    assert pairs.where("id = 't3'").first()["score"] is None


def test_top_per_error(spark):
    df = spark.createDataFrame([("a", "E", 0.5), ("b", "E", 0.5), ("c", "E", 0.4), ("d", None, 0.9)], "id string, ID_ERROR string, score double")
    assert sorted(r["id"] for r in M.top_per_error(df, 2, "id").collect()) == ["a", "b"]


def vectors(spark, n=400):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(n, 5))
    rows = [(i, "f%d" % (i % 3), "e%d" % (i % 4), data[i].tolist()) for i in range(n)]
    rows += [(n, "f0", "e0", [0.0] * 5), (n + 1, "f0", "e0", data[0].tolist()), (n + 2, "f0", "e0", None)]
    return data, spark.createDataFrame(rows, "id long, family string, error string, embedding array<double>")


@pytest.mark.parametrize("limit", [5_000, 3])
def test_nearest_against_numpy(spark, monkeypatch, limit):
    monkeypatch.setattr(M, "MAX_QUERY_ROWS", limit)
    monkeypatch.setattr(M, "QUESTION_BLOCK", 3)
    monkeypatch.setattr(M, "QUESTION_CHUNK", 2)
    monkeypatch.setattr(M, "ROW_BLOCK", 50)
    data, collection = vectors(spark)
    queries = [(i, f"f{i % 4}", data[i].tolist()) for i in range(8)]
    asked = spark.createDataFrame(queries, "query_id int, family string, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        near = M.nearest(collection, asked, 4, "id", "embedding", "family").collect()
        every = M.nearest(collection, asked, 3, "id", "embedding").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    table = {i: unit[i] for i in range(400)} | {400: np.zeros(5), 401: unit[0]}
    for q, family, _ in queries:
        def best(ids, k):
            return sorted(ids, key=lambda i: (-round(float(table[i] @ unit[q]), 9), i))[:k]

        inside = [i for i in table if (f"f{i % 3}" if i < 400 else "f0") == family]
        assert [r["id"] for r in sorted(near, key=lambda r: r["rank"]) if r["query_id"] == q] == best(inside, 4)
        assert [r["id"] for r in sorted(every, key=lambda r: r["rank"]) if r["query_id"] == q] == best(table, 3)


def test_search_limits_before_grouping(spark):
    rows = [(i, "f", "many", [1.0, 0.001 * i]) for i in range(25)] + [(99, "f", "rare", [0.0, 1.0]), (100, "g", "other", [1.0, 0.0])]
    collection = spark.createDataFrame(rows, "id long, family string, error string, embedding array<double>")
    asked = spark.createDataFrame([(1, "f", [1.0, 0.0]), (2, "none", [1.0, 0.0]), (3, "g", [1.0, 0.0])], "query_id int, family string, vector array<double>")
    found = {(r["query_id"], r["error"]): r["score"] for r in M.search_errors(collection, asked, "id", shown=5).collect()}
    assert found == {(1, "many"): 1.0, (3, "other"): 1.0}


def test_many_questions_read_their_families_only(spark, monkeypatch, tmp_path):
    _, collection = vectors(spark, 60)
    M.write_vectors(collection.where("embedding IS NOT NULL"), str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    asked = spark.createDataFrame([(i, "f1", [float(i), 1.0, 0.0, 0.5, 2.0]) for i in range(6)], "query_id int, family string, vector array<double>")
    few = sorted(M.nearest(stored, asked, 3, "id", "embedding", "family", ["error"]).collect())
    monkeypatch.setattr(M, "MAX_QUERY_ROWS", 2)
    found = M.nearest(stored, asked, 3, "id", "embedding", "family", ["error"])
    assert sorted(found.collect()) == few and len(few) == 18
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan


def test_vector_table(spark, tmp_path):
    _, collection = vectors(spark, 30)
    M.write_vectors(collection.where("embedding IS NOT NULL"), str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert stored.count() == 32 and stored.schema["embedding"].dataType.simpleString() == "array<float>"
    one = stored.where(F.col("family") == "f1")
    assert "PartitionFilters: [isnotnull(family" in one._jdf.queryExecution().toString()
    assert one.select(N.norm("embedding")).first()[0] == pytest.approx(1.0)


def test_evaluation(spark):
    pairs = [("a", "a")] * 3 + [("a", "b"), ("b", "b"), ("c", "a"), ("a", "d"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    found = {r["class"]: (r["support"], r["precision"], r["recall"], r["f1"]) for r in E.evaluation_report(df, "label", "prediction").collect()}
    assert found["a"] == (5, 0.75, 0.6, pytest.approx(2 * 0.75 * 0.6 / 1.35))
    assert found["b"] == (1, 0.5, 1.0, pytest.approx(2 / 3))
    assert found["c"] == (1, 0.0, 0.0, 0.0) and found["d"] == (0, 0.0, 0.0, 0.0)
    assert found["accuracy"][:2] == (7, pytest.approx(4 / 7))
    assert found["macro avg"][1] == pytest.approx(1.25 / 4)
    assert found["weighted avg"][2] == pytest.approx(4 / 7)
    means = E.mean_scores(spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, s double"), ["k"], "s")
    assert means.first()["s"] == 2.0


def blobs(spark):
    rng = np.random.default_rng(5)
    points = np.vstack([rng.normal(c, 0.1, size=(21, 3)) for c in (0, 5, 10)])
    return points, spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>")


def test_folds_are_contiguous(spark):
    df = spark.range(7).select(F.col("id"))
    folds = {r["id"]: r["fold"] for r in G.with_folds(df, "id", 2).collect()}
    assert folds == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1}
    thirds = [r["fold"] for r in G.with_folds(df, "id", 3).orderBy("id").collect()]
    assert thirds == [0, 0, 0, 1, 1, 2, 2]


def test_kmeans(spark):
    points, df = blobs(spark)
    model = G.fit_kmeans(df, "v", 3, seed=1)
    rows = G.assign(model, df, "v", ["id"]).toPandas().sort_values("id")
    centres = np.array(model.clusterCenters())
    wanted = ((points - centres[rows["cluster"]]) ** 2).sum(axis=1)
    assert np.allclose(rows["distance"], wanted) and rows["cluster"].nunique() == 3
    sparse = df.sparkSession.createDataFrame(
        [(1, Vectors.sparse(3, {1: 2.0})), (2, Vectors.sparse(3, {})), (3, Vectors.dense([1.0, 0, 2]))], ["id", "s"]
    )
    for r in G.assign(model, sparse, "s", ["id", "s"]).collect():
        assert r["distance"] == pytest.approx(((r["s"].toArray() - centres[r["cluster"]]) ** 2).sum())
    assert G.inertia(model, df, "v") == pytest.approx(wanted.sum())
    assert G.silhouette(model, df, "v").first()["silhouette"] > 0.9
    grid = G.kmeans_grid(df, "id", "v", [2, 3], seed=1)
    assert grid.count() == 4 and all(r["inertia"] >= 0 and r["train_rows"] in (31, 32) for r in grid.collect())
    assert G.best_k(grid).count() == 1
    variants = G.variant_grid({"raw": lambda: df, "unit": lambda: df.withColumn("v", N.unit("v"))}, "id", "v", [2])
    assert sorted(r["variant"] for r in variants.collect()) == ["raw", "raw", "unit", "unit"]


def test_pca(spark):
    points, df = blobs(spark)
    model = V.fit_pca(df, "v", 2)
    projected = V.project(model, df, "v", ["id"], 2).toPandas().sort_values("id")
    centred = points - points.mean(axis=0)
    _, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose((projected[["pc_0", "pc_1"]] ** 2).sum(), s[:2] ** 2)
    assert np.allclose(projected[["pc_0", "pc_1"]].mean(), 0, atol=1e-9)
    assert G.outliers(V.project(model, df, "v", ["id"], 2), "pc_0", 1e9).count() == 0


def test_texts_are_those_of_the_family(spark):
    from faultline.plans.tickets import most_likely_errors

    catalogue = spark.createDataFrame(
        [("E1", 0, 1, 0, "text of 1", [1.0, 0.0]), ("E1", 1, 2, 0, "a text of 2", [1.0, 0.0]), ("E2", 2, 2, 0, "two", [0.0, 1.0])],
        "ID_ERROR string, catalogue_pos int, CODCAR3 int, CODCAR2 int, MOTIVO string, vector array<double>",
    )
    rows = [(1, 1, 0, [1.0, 0.1]), (2, 2, 0, [1.0, 0.1]), (3, 2, 0, [0.0, 1.0]), (4, 9, 0, [1.0, 0.0]), (5, 1, 0, [-1.0, 0.0])]
    tickets = spark.createDataFrame(rows, "k int, CAR3 int, CAR2 int, vector array<double>")
    found = {r["k"]: (r["ID_ERROR"], r["MOTIVO"]) for r in most_likely_errors(tickets, catalogue, "k").collect()}
    assert found == {1: ("E1", "text of 1"), 2: ("E1", "a text of 2"), 3: ("E2", "two"), 4: (None, None), 5: ("E1", "text of 1")}
    zero = {r["k"]: (r["ID_ERROR"], r["MOTIVO"]) for r in most_likely_errors(tickets, catalogue, "k", compat=True).collect()}
    assert zero == found | {4: ("E1", "a text of 2"), 5: ("E2", "two")}
