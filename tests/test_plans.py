"""Plans: what is broadcast, what is shuffled, what reaches the scan."""

from pyspark.sql import functions as F

import __spark_entry__ as driver
from faultline.operators.joins import join_pieces
from faultline.plans import sizing
from faultline.plans.durable import durable
from faultline.plans.tickets import analysis_set, integrate_tickets, translated_tickets

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_small_sides(spark):
    small, large = spark.range(3), spark.range(30)
    assert sizing.is_small(small, 3) and not sizing.is_small(large, 3)
    assert "broadcast" in sizing.measured_side(small, 3)._jdf.queryExecution().toString()
    assert "broadcast" not in sizing.measured_side(large, 3)._jdf.queryExecution().toString()
    assert "broadcast" not in sizing.bounded_side(large, 10**9)._jdf.queryExecution().toString()


def test_spread_shuffles_small_scans_only(spark):
    scan = spark.read.parquet(f"{SF}/orders.parquet")
    assert sizing.spread(scan, "o_orderkey").rdd.getNumPartitions() == 16
    assert sizing.spread(scan, splits_per_core=0) is scan


def test_durable_cuts_lineage(spark):
    df = durable(spark.range(10).withColumn("x", F.rand(1)))
    assert "Scan ExistingRDD" in plan(df) and df.count() == 10


def test_ticket_filter_reaches_the_scan(spark):
    text = plan(driver.queries()["ticket_piece_join"](spark, SF))
    assert "o_orderdate" in text and "PushedFilters" in text
    assert "LessThan(o_orderdate" in text and "CartesianProduct" not in text


def test_no_cartesian_products(spark):
    for name in ("classify_by_catalogue", "language_id", "tfidf_weights", "best_match_cached", "company_union"):
        text = plan(driver.queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_classification_is_decided_in_the_row(spark):
    text = plan(driver.queries()["classify_zero_filled"](spark, SF))
    assert "SortMergeJoin" not in text and "hashpartitioning(vec_id" not in text


def test_columns_are_pruned(spark):
    text = plan(driver.queries()["value_counts"](spark, SF))
    assert "ReadSchema: struct<lang:string>" in text


def test_pipeline(spark):
    tickets = spark.createDataFrame(
        [("A", 1, 1, 2, "2024-01-01", "el equipo no enciende nunca"), ("B", 2, 1, 6, "2024-06-01", "tarde"), ("C", 3, 2, 2, "2024-01-01", "otro")],
        "codigo string, id int, tipo int, estado int, d string, desc_problema string",
    ).withColumn("modification_date", F.col("d").cast("timestamp_ntz")).drop("d")
    pieces = spark.createDataFrame([("A", 7, "x1", "piece", None)], "codigo_incidencia string, id int, cod_articulo string, descripcion string, problema string")
    states = spark.createDataFrame([(2, "Validado"), (6, "Cerrado")], "id int, titulo_es string")
    types = spark.createDataFrame([(1, "Garantia")], "id int, titulo_es string")
    joined = integrate_tickets(tickets, pieces, states, types, before="2024-05-09")
    assert [r["codigo"] for r in joined.collect()] == ["A"]
    cache = {f: spark.createDataFrame([("piece", "pieza")], f"{f} string, {f}_translated string") for f in ("desc_problema", "descripcion", "problema")}
    texts = translated_tickets(joined, cache)
    row = texts.first()
    assert row["descripcion_translated"] == "pieza" and row["problema_translated"] == ""
    matched = texts.withColumns({"CODART_A3": F.lit("X1"), "Fuzzy_Score": F.lit(90)})
    articles = spark.createDataFrame([("X1", "TERMOSTATOS", None)], "CODART string, DESCCAR3 string, DESCCAR2 string")
    final = analysis_set(matched, articles).first()
    assert final["text_to_analyse"] == "el equipo no enciende nunca pieza " and final["DESCCAR2"] == ""


def test_hot_ticket_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tickets = spark.range(1000).select(F.col("id").alias("codigo"))
        pieces = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).alias("codigo_incidencia"),
            F.sha2(F.col("id").cast("string"), 256).alias("piece"),
        )
        joined = join_pieces(tickets, pieces)
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 60000
        rows = joined.collect()
        assert len({r["piece"] for r in rows}) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_slot_pivot_shuffles_once(spark):
    text = plan(driver.queries()["slot_pivot"](spark, SF))
    assert text.count("hashpartitioning(") == 1
