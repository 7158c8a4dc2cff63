"""Stand-ins for the ticket tables on the test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.plans.sizing import spread

CUT = "1999-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for per-row text work, shared among all cores."""
    return spread(table(spark, sf_dir, "documents").select(*columns), columns[0])


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tickets: state from the status, type from the priority."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("codigo"),
        F.col("o_custkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tipo"),
        F.when(F.col("o_orderstatus") == "F", 2)
        .when(F.col("o_orderstatus") == "O", 6)
        .otherwise(1)
        .alias("estado"),
        F.col("o_orderdate").alias("modification_date"),
    )


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticket pieces."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("codigo_incidencia"),
        F.col("l_linenumber").alias("id"),
        F.col("l_partkey").alias("cod_articulo"),
        F.col("l_shipdate").alias("modification_date"),
    )


STATES = ((1, "Abierto"), (2, "Validado"), (6, "Cerrado"))
TYPES = ((1, "Garantia"), (2, "Comercial"), (3, "Consulta"), (4, "Otro"))


def dimension(spark: SparkSession, rows: tuple) -> DataFrame:
    return spark.createDataFrame(rows, "id int, titulo_es string")


TICKETS_SQL = """
tickets AS (
  SELECT o_orderkey AS codigo, o_custkey AS id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tipo,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 6 ELSE 1 END AS estado,
         o_orderdate AS modification_date
  FROM orders),
pieces AS (
  SELECT l_orderkey AS codigo_incidencia, l_linenumber AS id_pieza,
         l_partkey AS cod_articulo, l_shipdate AS modification_date_pieza
  FROM lineitem),
states(id_estado, titulo_es) AS (VALUES (1, 'Abierto'), (2, 'Validado'), (6, 'Cerrado')),
types(id_tipo, titulo_es_tipo) AS (
  VALUES (1, 'Garantia'), (2, 'Comercial'), (3, 'Consulta'), (4, 'Otro'))
"""
