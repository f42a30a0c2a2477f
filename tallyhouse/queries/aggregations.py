"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.grouping import fold_columns, group_values, mean_of_matched
from tallyhouse.operators.sets import distinct_rows, drop_duplicates, text_digest
from tallyhouse.plans.transactions import card_means
from tallyhouse.queries.registry import WITH_T, query, table, transactions
from tallyhouse.sinks.catalog import publish_view

FOLD_MODULUS = 1_000_003
ORDERS_PER_PIECE = 10_000


@query("SELECT count(*) AS n FROM orders")
def agg_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"))


@query(WITH_T + "SELECT ciudad, count(ciudad) AS n FROM t GROUP BY ciudad")
def agg_count_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).groupBy("ciudad").agg(F.count("ciudad").alias("n"))


@query("SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY p_brand, p_size")
def agg_count_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


@query("SELECT round(avg(p_size), 4) AS mean_size FROM part")
def agg_avg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").agg(F.round(F.avg("p_size"), 4).alias("mean_size"))


@query("SELECT min(p_size) AS smallest, max(p_size) AS largest FROM part")
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").agg(F.min("p_size").alias("smallest"), F.max("p_size").alias("largest"))


@query("SELECT max(p_size) AS largest FROM part")
def agg_sql_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = publish_view(table(spark, sf_dir, "part"), "part_sizes")
    return spark.sql(f"SELECT max(p_size) AS largest FROM {view}")


@query(WITH_T + "SELECT tarjetaCredito, round(avg(importe), 2) AS mean_importe FROM t GROUP BY tarjetaCredito")
def agg_mean_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_means(transactions(spark, sf_dir), digits=2)


@query("""
SELECT c_custkey, round(avg(o_totalprice), 6) AS mean_total
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
""")
def agg_avg_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return mean_of_matched(orders, table(spark, sf_dir, "customer"), "c_custkey", "o_totalprice", "mean_total", 6)


@query("""
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY l_returnflag
""")
def agg_sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


@query("SELECT CAST(sum(p_size) AS BIGINT) AS total FROM part")
def agg_sum_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").agg(F.sum("p_size").alias("total"))


@query(f"""
SELECT p_brand, list_reduce(list(CAST(p_size AS BIGINT)), lambda a, b: (a * b) % {FOLD_MODULUS}) AS product
FROM part GROUP BY p_brand
""")
def agg_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_brand", F.col("p_size").cast("long").alias("product"))
    return fold_columns(sizes, ["p_brand"], "product", lambda a, b: a * b % FOLD_MODULUS)


@query(f"""
WITH ranked AS (
  SELECT o_orderpriority, o_orderkey,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS place FROM orders
)
SELECT o_orderpriority, CAST(place // {ORDERS_PER_PIECE} AS BIGINT) AS piece,
       array_to_string(list_sort(list(o_orderkey)), ',') AS orders
FROM ranked GROUP BY 1, 2
""")
def agg_group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = group_values(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderkey", length=ORDERS_PER_PIECE
    )
    return grouped.select(
        "o_orderpriority", "piece", F.array_join(F.col("grouped").cast("array<string>"), ",").alias("orders")
    )


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) FILTER (WHERE event_type = 'error') AS errors FROM events")
def agg_count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.count_if(F.col("event_type") == "error").alias("errors"))


@query("SELECT DISTINCT lang FROM documents")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "documents").select("lang"))


@query("""
SELECT doc_id, lang, n_chars FROM (
  SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
) WHERE rn = 1
""")
def agg_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", text_digest("text").alias("digest"))
    return drop_duplicates(documents, ["digest"], ["doc_id"]).drop("digest")
