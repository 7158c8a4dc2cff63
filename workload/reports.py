"""Pareto, monthly, slot, profile and count reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import cleaning as C
from faultline.operators import joins as J
from faultline.operators import language as L
from faultline.operators import reports as R
from faultline.operators import reshape as U
from faultline.plans.durable import durable
from workload.tables import CUT, TICKETS_SQL, pieces, table, tickets


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def pareto_articles(spark: SparkSession, d: str) -> DataFrame:
    """Articles with most pieces in warranty tickets, against the pieces of all tickets."""
    joined = tickets(spark, d).join(
        pieces(spark, d).select("codigo_incidencia", "cod_articulo"),
        F.col("codigo") == F.col("codigo_incidencia"),
    )
    chosen = (F.col("tipo") == 1) & F.col("estado").isin(2, 6)
    chosen &= F.col("modification_date") < F.lit(CUT).cast("timestamp_ntz")
    # One join feeds both counts; the table by article is small against it.
    counts = durable(
        joined.where(F.col("cod_articulo").isNotNull())
        .groupBy("cod_articulo")
        .agg(F.count_if(chosen).alias("count"), F.count(F.lit(1)).alias("all_pieces"))
    )
    listed = counts.where(F.col("count") > 0).select("cod_articulo", "count")
    result = R.pareto(
        listed, "count", "cod_articulo", top=20, total=counts.agg(F.sum("all_pieces"))
    )
    return rounded(result, "share", "cum_share")


PARETO_ARTICLES = f"""
WITH {TICKETS_SQL},
j AS (SELECT cod_articulo, tipo = 1 AND estado IN (2, 6)
        AND modification_date < TIMESTAMP '{CUT}' AS chosen
      FROM tickets JOIN pieces ON codigo = codigo_incidencia WHERE cod_articulo IS NOT NULL),
c AS (SELECT cod_articulo, count(*) AS "count" FROM j WHERE chosen GROUP BY cod_articulo),
k AS (SELECT *, row_number() OVER (ORDER BY "count" DESC, cod_articulo) AS r FROM c),
s AS (SELECT *, sum("count") OVER (ORDER BY r) AS cumsum, (SELECT count(*) FROM j) AS total FROM k)
SELECT cod_articulo, "count", CAST(cumsum AS BIGINT) AS cumsum,
       round("count" * 100.0 / total, 6) AS share, round(cumsum * 100.0 / total, 6) AS cum_share
FROM s WHERE r <= 20
"""


def pareto_customers(spark: SparkSession, d: str) -> DataFrame:
    """Share and running share over all customers."""
    counts = R.count_by(table(spark, d, "orders"), "o_custkey")
    return rounded(R.pareto(counts, "count", "o_custkey"), "share", "cum_share")


PARETO_CUSTOMERS = """
WITH c AS (SELECT o_custkey, count(*) AS "count" FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1),
s AS (SELECT *, sum("count") OVER (ORDER BY "count" DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS cumsum,
             sum("count") OVER () AS total FROM c)
SELECT o_custkey, "count", CAST(cumsum AS BIGINT) AS cumsum,
       round("count" * 100.0 / total, 6) AS share, round(cumsum * 100.0 / total, 6) AS cum_share FROM s
"""


def label_distribution(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "source")
    labelled = documents.join(table(spark, d, "labels"), "doc_id", "left")
    counts = R.present_by(labelled, "source", "quality")
    return rounded(R.pareto(counts, "count", "source"), "share", "cum_share")


LABEL_DISTRIBUTION = """
WITH c AS (SELECT source, count(quality) AS "count" FROM documents LEFT JOIN labels USING (doc_id)
           WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT *, sum("count") OVER (ORDER BY "count" DESC, source ROWS UNBOUNDED PRECEDING) AS cumsum,
             sum("count") OVER () AS total FROM c)
SELECT source, "count", CAST(cumsum AS BIGINT) AS cumsum,
       round("count" * 100.0 / total, 6) AS share, round(cumsum * 100.0 / total, 6) AS cum_share FROM s
"""


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = table(spark, d, "documents"), table(spark, d, "labels")
    tested = documents.join(labels.where(F.col("toxic") == 0), "doc_id", "left_semi")
    return tested.join(labels, "doc_id").select("doc_id", "lang", "quality")


LABELLED_DOCUMENTS = """
SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)
"""


def monthly_sales_vs_after(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("SERIE"), F.col("o_orderdate").alias("FECHA"),
        F.col("o_totalprice").alias("BASE"), "o_orderpriority",
    )
    sales = R.monthly_sum(C.in_series(documents, "SERIE", ["F", "O"]), "FECHA", "BASE")
    after = R.monthly_sum(
        C.in_series(documents, "SERIE", ["P"]).where(F.col("o_orderpriority") == "1-URGENT"),
        "FECHA", "BASE",
    )
    series = J.monthly_outer(sales, after, ["Year", "Month"], "BASE", ("_sales", "_after_sales"))
    result = R.without_last_period(durable(series), ["Year", "Month"])
    return rounded(result, "BASE_sales", "BASE_after_sales", digits=2)


MONTHLY_SALES_VS_AFTER = """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS "Year",
                  CAST(month(o_orderdate) AS INTEGER) AS "Month", * FROM orders),
s AS (SELECT "Year", "Month", round(sum(o_totalprice), 2) AS BASE_sales FROM o
      WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2),
a AS (SELECT "Year", "Month", round(sum(o_totalprice), 2) AS BASE_after_sales FROM o
      WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1, 2),
j AS (SELECT * FROM s FULL JOIN a USING ("Year", "Month"))
SELECT * FROM j WHERE "Year" * 12 + "Month" < (SELECT max("Year" * 12 + "Month") FROM j)
"""


def sales_by_segment(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    sums = R.with_share(R.sum_by(orders, ["c_mktsegment"], "o_totalprice", "BASE"), "BASE")
    return rounded(rounded(sums, "BASE", digits=2), "share")


SALES_BY_SEGMENT = """
SELECT c_mktsegment, round(coalesce(sum(o_totalprice), 0), 2) AS BASE,
       round(sum(o_totalprice) / sum(sum(o_totalprice)) OVER (), 6) AS share
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
"""

SLOTS = {
    f"slot_{i}_{role}": (i, role) for i in range(1, 8) for role in ("serial_number", "error_type")
}


def _wide_slots(spark: SparkSession, d: str) -> DataFrame:
    """Line items 1 to 7 of each order as seven pairs of columns.

    One-letter flags travel as their code, so that all sums have fixed width.
    """
    values = {
        "serial_number": F.col("l_partkey"),
        "error_type": F.when(F.col("l_quantity") > 5, F.ascii("l_returnflag")),
    }
    wide = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("TicketId")).agg(
        *[
            F.max(F.when(F.col("l_linenumber") == i, values[role])).alias(name)
            for name, (i, role) in SLOTS.items()
        ]
    )
    return wide.withColumns(
        {
            name: F.chr(name) if role == "error_type" else F.col(name).cast("string")
            for name, (_, role) in SLOTS.items()
        }
    )


def _slot_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = U.unpivot_slots(_wide_slots(spark, d), ["TicketId"], list(SLOTS))
    number, role = U.slot_of("variable", SLOTS)
    return rows.withColumns({"slot": number, "role": role})


_SLOTS_SQL = """
w AS (SELECT l_orderkey AS TicketId, l_linenumber AS slot,
             CAST(max(l_partkey) AS VARCHAR) AS serial_number,
             max(CASE WHEN l_quantity > 5 THEN l_returnflag END) AS error_type
      FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7 GROUP BY 1, 2),
r AS (SELECT TicketId, slot, 'serial_number' AS role, serial_number AS value FROM w
      WHERE serial_number IS NOT NULL
      UNION ALL SELECT TicketId, slot, 'error_type', error_type FROM w WHERE error_type IS NOT NULL)
"""


def slot_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return _slot_rows(spark, d)


SLOT_UNPIVOT = f"""
WITH {_SLOTS_SQL}
SELECT TicketId, 'slot_' || slot || '_' || role AS variable, value, slot, role FROM r
"""


def slot_pivot(spark: SparkSession, d: str) -> DataFrame:
    cells = U.pivot_slots(_slot_rows(spark, d), ["TicketId", "slot"], "role", ["serial_number", "error_type"])
    return R.with_group_size(cells, "TicketId", "total_piezas", bounded=True)


SLOT_PIVOT = f"""
WITH {_SLOTS_SQL}
SELECT *, count(*) OVER (PARTITION BY TicketId) AS total_piezas FROM w
WHERE serial_number IS NOT NULL OR error_type IS NOT NULL
"""


def slot_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.count_by(_slot_rows(spark, d), "slot", "role", out="pieces")


SLOT_COUNTS = f"WITH {_SLOTS_SQL} SELECT slot, role, count(*) AS pieces FROM r GROUP BY slot, role"


def slot_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Tickets with a serial number in slot 1 but no error type in any slot."""
    errors = [name for name, (_, role) in SLOTS.items() if role == "error_type"]
    wide = _wide_slots(spark, d)
    rows = wide.where(~C.any_present(errors) & C.all_present(["slot_1_serial_number"]))
    return rows.select("TicketId", "slot_1_serial_number")


SLOT_GAPS = """
SELECT l_orderkey AS TicketId,
       CAST(max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS VARCHAR) AS slot_1_serial_number
FROM lineitem GROUP BY l_orderkey
HAVING count(CASE WHEN l_quantity > 5 AND l_linenumber BETWEEN 1 AND 7 THEN l_returnflag END) = 0
   AND count(CASE WHEN l_linenumber = 1 THEN l_partkey END) > 0
"""


def table_profile(spark: SparkSession, d: str) -> DataFrame:
    figures = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return rounded(R.profile(table(spark, d, "customer")), *figures)


def _profile_sql(column: str, numeric: bool) -> str:
    values = (
        f"round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std, "
        f"round(CAST(min({column}) AS DOUBLE), 6) AS min, "
        + "".join(
            f"round(CAST(quantile_cont(CAST({column} AS DOUBLE), {q}) AS DOUBLE), 6) AS {n}, "
            for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        )
        + f"round(CAST(max({column}) AS DOUBLE), 6) AS max"
        if numeric
        else ", ".join(
            f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "q25", "q50", "q75", "max")
        )
    )
    top = (
        f"SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM customer "
        f"WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v DESC LIMIT 1"
    )
    return (
        f"""SELECT '{column}' AS "column", count({column}) AS "count", """
        f"""count(DISTINCT {column}) AS "unique", (SELECT v FROM ({top})) AS top, """
        f"(SELECT n FROM ({top})) AS freq, {values} FROM customer"
    )


TABLE_PROFILE = " UNION ALL ".join(
    _profile_sql(c, n)
    for c, n in (
        ("c_custkey", True), ("c_name", False), ("c_nationkey", True),
        ("c_acctbal", True), ("c_mktsegment", False),
    )
)


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "lang", "text")
    return R.null_profile(documents.join(table(spark, d, "labels"), "doc_id", "left"))


NULL_PROFILE = """
WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
p AS (SELECT 'doc_id' AS c, count(doc_id) AS n, count(*) AS r FROM j
      UNION ALL SELECT 'lang', count(lang), count(*) FROM j
      UNION ALL SELECT 'text', count(text), count(*) FROM j
      UNION ALL SELECT 'quality', count(quality), count(*) FROM j
      UNION ALL SELECT 'toxic', count(toxic), count(*) FROM j)
SELECT c AS "column", r AS "rows", n AS non_null, r - n AS nulls FROM p
"""


def funnel_counts(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    family = C.not_in("lang", ["de", None, ""])
    rules = {
        "all": F.lit(True),
        "long": C.long_enough("text"),
        "family": family,
        "scored": F.col("quality") >= 1,
        "clean": C.long_enough("text") & family & (F.col("quality") >= 1),
    }
    return rounded(R.funnel(documents, rules), "percent")


FUNNEL_COUNTS = """
WITH j AS (
  SELECT length(text) > 25 AND length(replace(text, 'NO FUNCIONA', '')) > 25 AS long,
         coalesce(lang NOT IN ('de', ''), false) AS family, coalesce(quality >= 1, false) AS scored
  FROM documents LEFT JOIN labels USING (doc_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (long) AS a, count(*) FILTER (family) AS b,
             count(*) FILTER (scored) AS s, count(*) FILTER (long AND family AND scored) AS x FROM j),
r AS (SELECT 'all' AS rule, n AS "rows", n FROM c UNION ALL SELECT 'long', a, n FROM c
      UNION ALL SELECT 'family', b, n FROM c UNION ALL SELECT 'scored', s, n FROM c
      UNION ALL SELECT 'clean', x, n FROM c)
SELECT rule, "rows", round("rows" * 100.0 / n, 6) AS percent FROM r
"""


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.count_by(table(spark, d, "documents"), "lang")


VALUE_COUNTS = 'SELECT lang, count(*) AS "count" FROM documents WHERE lang IS NOT NULL GROUP BY lang'


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("source", "lang").distinct()


DISTINCT_VALUES = "SELECT DISTINCT source, lang FROM documents"


def distinct_count(spark: SparkSession, d: str) -> DataFrame:
    return R.distinct_count(table(spark, d, "documents"), "text").withColumnRenamed("distinct", "texts")


DISTINCT_COUNT = "SELECT count(DISTINCT text) AS texts FROM documents"


def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("lang", "text").dropDuplicates()


DISTINCT_ROWS = "SELECT DISTINCT lang, text FROM documents"


def score_maximum(spark: SparkSession, d: str) -> DataFrame:
    return R.max_by_key(table(spark, d, "events"), "event_type", "value", "best")


SCORE_MAXIMUM = "SELECT event_type, max(value) AS best FROM events GROUP BY event_type"


def top_orders(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.top_rows(orders, "o_totalprice", "o_orderkey", 50)


TOP_ORDERS = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
"""


def sampled_tickets(spark: SparkSession, d: str) -> DataFrame:
    return R.sample_rows(tickets(spark, d), 100, seed=7)


def translation_budget(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("lang", "text", "source")
    texts = documents.unpivot("lang", ["text", "source"], "field", "text").distinct()
    language = F.when(F.length("text") < L.SHORTEST, L.TOO_SHORT).otherwise(F.col("lang"))
    return L.translation_budget(texts.withColumn("language", language))


TRANSLATION_BUDGET = """
WITH t AS (SELECT DISTINCT 'text' AS field, lang, text FROM documents
           UNION ALL SELECT DISTINCT 'source', lang, source FROM documents)
SELECT field, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS characters FROM t
WHERE length(text) >= 5 AND lang NOT IN ('es', 'Error', 'Too short') GROUP BY field
"""

QUERIES = {
    "pareto_articles": (pareto_articles, PARETO_ARTICLES),
    "pareto_customers": (pareto_customers, PARETO_CUSTOMERS),
    "label_distribution": (label_distribution, LABEL_DISTRIBUTION),
    "labelled_documents": (labelled_documents, LABELLED_DOCUMENTS),
    "monthly_sales_vs_after": (monthly_sales_vs_after, MONTHLY_SALES_VS_AFTER),
    "sales_by_segment": (sales_by_segment, SALES_BY_SEGMENT),
    "slot_unpivot": (slot_unpivot, SLOT_UNPIVOT),
    "slot_pivot": (slot_pivot, SLOT_PIVOT),
    "slot_counts": (slot_counts, SLOT_COUNTS),
    "slot_gaps": (slot_gaps, SLOT_GAPS),
    "table_profile": (table_profile, TABLE_PROFILE),
    "null_profile": (null_profile, NULL_PROFILE),
    "funnel_counts": (funnel_counts, FUNNEL_COUNTS),
    "value_counts": (value_counts, VALUE_COUNTS),
    "distinct_values": (distinct_values, DISTINCT_VALUES),
    "distinct_count": (distinct_count, DISTINCT_COUNT),
    "distinct_rows": (distinct_rows, DISTINCT_ROWS),
    "score_maximum": (score_maximum, SCORE_MAXIMUM),
    "top_orders": (top_orders, TOP_ORDERS),
    "sampled_tickets": (
        sampled_tickets,
        f"""WITH {TICKETS_SQL} SELECT * FROM tickets
        ORDER BY md5(concat_ws('|', '7', coalesce(codigo::VARCHAR, ''), coalesce(id::VARCHAR, ''),
          coalesce(tipo::VARCHAR, ''), coalesce(estado::VARCHAR, ''), coalesce(modification_date::VARCHAR, ''))) LIMIT 100""",
    ),
    "translation_budget": (translation_budget, TRANSLATION_BUDGET),
}
