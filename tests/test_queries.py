"""Every driver query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
SLOW = {"word2vec_docs", "kmeans_grid"}


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, database, name):
    assert difference(driver.queries()[name](spark, SF), database, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(driver.queries().keys() - driver.oracle_sql().keys()))
def test_has_rows(spark, name):
    df = driver.queries()[name](spark, SF)
    assert df.columns and df.limit(1).count() == 1


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert 0 < len(rows) <= 20
    shares = [r["cum_share"] for r in sorted(rows, key=lambda r: r["cumsum"])]
    assert shares == sorted(shares) and shares[-1] <= 100


@pytest.mark.parametrize(
    "name", ["pareto_customers", "table_profile", "cluster_pivot", "nearest_vectors", "tfidf_weights"]
)
def test_independent_of_partitions(spark, name):
    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.enabled", str(partitions == 1).lower())
        return sorted(map(str, driver.queries()[name](spark, SF).collect()))

    try:
        assert rows(1) == rows(7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
