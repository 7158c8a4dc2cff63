"""Similarity, classification, search, evaluation and clustering queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import scalars as S
from faultline.functions import vectors as N
from faultline.operators import clustering as G
from faultline.operators import evaluation as E
from faultline.operators import features as V
from faultline.operators import reshape as U
from faultline.operators import similarity as M
from faultline.plans.durable import durable
from faultline.plans.sizing import measured_side
from workload.tables import table

LABELS = 10
MAX_COLUMNS = 2_000


def _family(label: str):
    return F.col(label) % 3


def prototypes(spark: SparkSession, d: str) -> DataFrame:
    """Mean vector of each label, as an error catalogue with families and systems.

    Sums are combined per label and dimension before the shuffle.
    """
    means = (
        table(spark, d, "embeddings")
        .select("label", F.posexplode("embedding").alias("dim", "x"))
        .groupBy("label", "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    vectors = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"]).alias("vector")
    )
    label = F.col("label")
    return durable(
        vectors.select(
            "label",
            F.concat(F.lit("E"), label.cast("string")).alias("ID_ERROR"),
            _family("label").alias("CODCAR3"),
            F.when(label < 5, 0).otherwise(label % 2 + 1).alias("CODCAR2"),
            label.cast("int").alias("catalogue_pos"),
            F.concat(F.lit("motivo "), label.cast("string")).alias("MOTIVO"),
            "vector",
        )
    )


def vector_tickets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        "vec_id",
        "label",
        _family("label").alias("CAR3"),
        (F.col("vec_id") % 2 + 1).cast("int").alias("CAR2"),
        F.col("embedding").alias("vector"),
    )


_CATALOGUE_SQL = """
x AS (SELECT label, unnest(range(64)) AS dim, unnest(embedding::DOUBLE[]) AS x FROM embeddings),
m AS (SELECT label, dim, avg(x) AS x FROM x GROUP BY ALL),
catalogue AS (
  SELECT label, 'E' || label AS ID_ERROR, label % 3 AS CODCAR3,
         CASE WHEN label < 5 THEN 0 ELSE label % 2 + 1 END AS CODCAR2, label AS pos,
         'motivo ' || label AS MOTIVO, list(x ORDER BY dim) AS vector
  FROM m GROUP BY label),
tickets AS (SELECT vec_id, label, label % 3 AS CAR3, CAST(vec_id % 2 + 1 AS INTEGER) AS CAR2,
                   embedding::DOUBLE[] AS vector FROM embeddings),
pairs AS (
  SELECT t.vec_id, t.label, c.ID_ERROR, c.pos, c.MOTIVO,
         round(list_cosine_similarity(t.vector, c.vector), 9) AS score
  FROM tickets t LEFT JOIN catalogue c
    ON t.CAR3 = c.CODCAR3 AND (c.CODCAR2 = 0 OR c.CODCAR2 = t.CAR2)),
best AS (SELECT * FROM pairs
         QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, pos) = 1)
"""


def _six(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of every vector with the mean of its label."""
    means = prototypes(spark, d).select("label", F.col("vector").alias("mean"))
    joined = table(spark, d, "embeddings").join(measured_side(means), "label")
    return _six(joined.select("vec_id", "label", N.cosine("embedding", "mean").alias("score")))


COSINE_PAIRS = f"""
WITH {_CATALOGUE_SQL}
SELECT vec_id, t.label, round(list_cosine_similarity(t.vector, c.vector), 6) AS score
FROM tickets t JOIN catalogue c USING (label)
"""


def mean_label_scores(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the repeated scores of each label."""
    return E.mean_scores(cosine_pairs(spark, d), ["label"], "score").withColumn("score", F.round("score", 5))


MEAN_LABEL_SCORES = f"""
WITH {_CATALOGUE_SQL}
SELECT t.label, round(avg(round(list_cosine_similarity(t.vector, c.vector), 6)), 5) AS score
FROM tickets t JOIN catalogue c USING (label) GROUP BY t.label
"""


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return prototypes(spark, d).select(
        F.col("label").alias("query_id"), F.col("CODCAR3").alias("family"), "vector"
    )


def nearest_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest vectors of each label mean."""
    return _six(
        M.nearest(table(spark, d, "embeddings"), _questions(spark, d), 5, "vec_id", "embedding")
    )


NEAREST_VECTORS = f"""
WITH {_CATALOGUE_SQL},
s AS (SELECT c.label AS query_id, t.vec_id,
             round(list_cosine_similarity(t.vector, c.vector), 9) AS score
      FROM tickets t CROSS JOIN catalogue c),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM r WHERE rank <= 5
"""


def family_search(spark: SparkSession, d: str) -> DataFrame:
    """Best score per error among the 20 nearest of the question's family."""
    collection = table(spark, d, "embeddings").select(
        "vec_id", "embedding", F.col("label").alias("error"), _family("label").alias("family")
    )
    return _six(M.search_errors(collection, _questions(spark, d), "vec_id", shown=5))


FAMILY_SEARCH = f"""
WITH {_CATALOGUE_SQL},
s AS (SELECT c.label AS query_id, t.vec_id, t.label AS error,
             round(list_cosine_similarity(t.vector, c.vector), 9) AS score
      FROM tickets t JOIN catalogue c ON t.CAR3 = c.CODCAR3),
near AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20),
b AS (SELECT query_id, error, max(score) AS score FROM near GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, error) AS INTEGER) AS rank FROM b)
SELECT query_id, error, round(score, 6) AS score, rank FROM r WHERE rank <= 5
"""


def catalogue_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every applicable pair of ticket and error."""
    pairs = M.score_pairs(vector_tickets(spark, d), prototypes(spark, d), "vec_id")
    return _six(pairs.select("vec_id", "ID_ERROR", "score"))


CATALOGUE_SCORES = f"WITH {_CATALOGUE_SQL} SELECT vec_id, ID_ERROR, round(score, 6) AS score FROM pairs"


def classify_by_catalogue(spark: SparkSession, d: str) -> DataFrame:
    from faultline.plans.tickets import most_likely_errors

    best = most_likely_errors(vector_tickets(spark, d), prototypes(spark, d), "vec_id")
    return _six(best.select("vec_id", "ID_ERROR", "MOTIVO", "score"))


CLASSIFY_BY_CATALOGUE = f"""
WITH {_CATALOGUE_SQL} SELECT vec_id, ID_ERROR, MOTIVO, round(score, 6) AS score FROM best
"""


def classify_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    """Classification in which inapplicable errors compete with score 0."""
    flipped = vector_tickets(spark, d).withColumn("vector", F.transform("vector", lambda x: -x))
    return _six(M.classify(flipped, prototypes(spark, d), "vec_id", compat=True))


CLASSIFY_ZERO_FILLED = f"""
WITH {_CATALOGUE_SQL},
z AS (SELECT t.vec_id, c.ID_ERROR, c.pos,
        CASE WHEN t.CAR3 = c.CODCAR3 AND (c.CODCAR2 = 0 OR c.CODCAR2 = t.CAR2)
             THEN -round(list_cosine_similarity(t.vector, c.vector), 9) ELSE 0.0 END AS score
      FROM tickets t CROSS JOIN catalogue c)
SELECT vec_id, ID_ERROR, round(score, 6) AS score FROM z
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, pos) = 1
"""


def top_n_per_error(spark: SparkSession, d: str) -> DataFrame:
    best = M.classify(vector_tickets(spark, d), prototypes(spark, d), "vec_id")
    return _six(M.top_per_error(best, 10, "vec_id"))


TOP_N_PER_ERROR = f"""
WITH {_CATALOGUE_SQL},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY ID_ERROR ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM best WHERE ID_ERROR IS NOT NULL)
SELECT vec_id, ID_ERROR, round(score, 6) AS score, rank FROM r WHERE rank <= 10
"""


def evaluation_report(spark: SparkSession, d: str) -> DataFrame:
    best = M.classify(vector_tickets(spark, d), prototypes(spark, d), "vec_id", keep=["label"])
    rated = best.withColumn("label", F.concat(F.lit("E"), F.col("label").cast("string")))
    report = E.evaluation_report(rated, "label", "ID_ERROR")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


EVALUATION_REPORT = f"""
WITH {_CATALOGUE_SQL},
c AS (SELECT 'E' || label AS l, ID_ERROR AS p, count(*) AS n FROM best WHERE ID_ERROR IS NOT NULL GROUP BY ALL),
k AS (SELECT l AS cls FROM c UNION SELECT p FROM c),
s AS (SELECT cls, coalesce((SELECT sum(n) FROM c WHERE l = cls), 0) AS support,
             coalesce((SELECT sum(n) FROM c WHERE p = cls), 0) AS predicted,
             coalesce((SELECT sum(n) FROM c WHERE p = cls AND l = cls), 0) AS hits FROM k),
r AS (SELECT cls, support, hits,
             CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END AS precision,
             CASE WHEN support = 0 THEN 0.0 ELSE hits / support END AS recall,
             2.0 * hits / (predicted + support) AS f1 FROM s),
a AS (SELECT cls, support, precision, recall, f1 FROM r
      UNION ALL SELECT 'accuracy', sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
                       sum(hits) / sum(support) FROM r
      UNION ALL SELECT 'macro avg', sum(support), avg(precision), avg(recall), avg(f1) FROM r
      UNION ALL SELECT 'weighted avg', sum(support), sum(precision * support) / sum(support),
                       sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM r)
SELECT cls AS "class", CAST(support AS BIGINT) AS support, round(CAST(precision AS DOUBLE), 6) AS precision,
       round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1 AS DOUBLE), 6) AS f1 FROM a
"""


def parsed_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors printed to text and read back."""
    printed = F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), " "), F.lit("]"))
    parsed = table(spark, d, "embeddings").select("vec_id", N.parse_vector(printed).alias("v"))
    return parsed.select(
        "vec_id", F.size("v").alias("width"), F.round(N.norm("v"), 6).alias("norm"),
        F.round(F.get("v", F.lit(0)).cast("double"), 6).alias("first"),
    )


PARSED_VECTORS = """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width,
       round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm,
       round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM embeddings
"""


def vector_columns(spark: SparkSession, d: str) -> DataFrame:
    stacked = table(spark, d, "embeddings").select(
        "vec_id", N.stacked("embedding", N.unit("embedding")).cast("array<double>").alias("v")
    )
    columns = N.vector_columns("v", 128)
    return stacked.select("vec_id", *[F.round(c, 6).alias(f"vector_{i}") for i, c in enumerate(columns)])


VECTOR_COLUMNS = f"""
WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM u)
SELECT vec_id,
  {", ".join(f"round(v[{i + 1}], 6) AS vector_{i}" for i in range(64))},
  {", ".join(f"round(v[{i + 1}] / n, 6) AS vector_{i + 64}" for i in range(64))}
FROM s
"""


def kmeans_grid(spark: SparkSession, d: str) -> DataFrame:
    return G.kmeans_grid(table(spark, d, "embeddings"), "vec_id", "embedding", ks=(5, 10))


def silhouette(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return G.silhouette(G.fit_kmeans(vectors, "embedding", 10), vectors, "embedding")


def cluster_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Members of each cluster side by side; the clusters are the labels of the table, one column each."""
    vectors = table(spark, d, "embeddings")
    labels = [r[0] for r in vectors.select("label").where("label is not null").distinct().orderBy("label").take(MAX_COLUMNS + 1)]
    if len(labels) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} clusters do not fit side by side")
    return U.cluster_columns(vectors, "label", "vec_id", labels)


CLUSTER_PIVOT = f"""
WITH r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS position
           FROM embeddings)
SELECT position, {", ".join(f"max(CASE WHEN label = {k} THEN vec_id END) AS Cluster_{k}" for k in range(LABELS))}
FROM r GROUP BY position
"""


def pca3(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    model = V.fit_pca(vectors, "embedding", 3)
    return V.project(model, vectors, "embedding", ["vec_id"], 3)


def pca_outliers(spark: SparkSession, d: str) -> DataFrame:
    return G.outliers(pca3(spark, d), "pc_0", 0.1)


def ticket_labels(spark: SparkSession, d: str) -> DataFrame:
    """Documents and their label mean joined through a canonical text key."""
    names = prototypes(spark, d).select(
        F.col("label").cast("double").cast("string").alias("ID"), "MOTIVO"
    )
    left = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("ID"))
    keyed = names.select(S.key_text("ID").alias("ID"), "MOTIVO")
    return left.join(measured_side(keyed), "ID", "left").select("vec_id", "MOTIVO")


TICKET_LABELS = "SELECT vec_id, 'motivo ' || label AS MOTIVO FROM embeddings"

QUERIES = {
    "cosine_pairs": (cosine_pairs, COSINE_PAIRS),
    "mean_label_scores": (mean_label_scores, MEAN_LABEL_SCORES),
    "nearest_vectors": (nearest_vectors, NEAREST_VECTORS),
    "family_search": (family_search, FAMILY_SEARCH),
    "catalogue_scores": (catalogue_scores, CATALOGUE_SCORES),
    "classify_by_catalogue": (classify_by_catalogue, CLASSIFY_BY_CATALOGUE),
    "classify_zero_filled": (classify_zero_filled, CLASSIFY_ZERO_FILLED),
    "top_n_per_error": (top_n_per_error, TOP_N_PER_ERROR),
    "evaluation_report": (evaluation_report, EVALUATION_REPORT),
    "parsed_vectors": (parsed_vectors, PARSED_VECTORS),
    "vector_columns": (vector_columns, VECTOR_COLUMNS),
    "kmeans_grid": (kmeans_grid, None),
    "silhouette": (silhouette, None),
    "cluster_pivot": (cluster_pivot, CLUSTER_PIVOT),
    "pca3": (pca3, None),
    "pca_outliers": (pca_outliers, None),
    "ticket_labels": (ticket_labels, TICKET_LABELS),
}
