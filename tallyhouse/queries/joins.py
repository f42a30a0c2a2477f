"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.joins import drop_listed, join_nested, keep_listed, pair_join
from tallyhouse.operators.sets import intersect_rows, union_bag
from tallyhouse.plans.ratings import ratings_per_item
from tallyhouse.queries.registry import WITH_T, query, table, transactions
from tallyhouse.sinks.catalog import publish_view


@query(WITH_T + "SELECT fecha, DNI, importe, descripcion, tarjetaCredito, ciudad, nombre FROM t")
def join_inner_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(
        "fecha", "DNI", "importe", "descripcion", "tarjetaCredito", "ciudad", "nombre"
    )


@query("SELECT p_partkey, p_name, l_quantity FROM part JOIN lineitem ON p_partkey = l_partkey")
def join_ratings_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    return ratings_per_item(table(spark, sf_dir, "part"), ratings, "p_partkey", "p_name", "l_quantity")


@query("SELECT s_name AS name, n_name AS department FROM supplier, nation WHERE s_nationkey = n_nationkey")
def join_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = publish_view(table(spark, sf_dir, "supplier"), "supplier_join")
    nations = publish_view(table(spark, sf_dir, "nation"), "nation_join")
    return spark.sql(
        f"SELECT s.s_name AS name, n.n_name AS department FROM {suppliers} s, {nations} n "
        "WHERE s.s_nationkey = n.n_nationkey"
    )


def _order_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("quantity"))
    return orders, items


@query("""
SELECT o_orderkey AS key, o_totalprice AS total, l_quantity AS quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_kv_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = _order_pairs(spark, sf_dir)
    return pair_join(orders, items, "key")


@query("""
SELECT o_orderkey AS key, o_totalprice AS total, l_quantity AS quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_kv_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = _order_pairs(spark, sf_dir)
    return pair_join(orders, items, "key", "left")


@query("""
SELECT documents.doc_id AS doc_id, quality, source
FROM labels RIGHT JOIN documents ON labels.doc_id = documents.doc_id
""")
def join_kv_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pair_join(labels, documents, "doc_id", "right")


@query("""
SELECT c_custkey AS id, c_name AS name, o_orderkey AS account, o_totalprice AS salary
FROM customer JOIN orders ON c_custkey = o_custkey
""")
def join_nested_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    accounts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("account"), F.col("o_totalprice").alias("salary")
    )
    return join_nested(people, accounts, "id").select("id", "name", "value.account", "value.salary")


def _watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("user_id"))


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT n_nationkey FROM nation)")
def join_broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return keep_listed(events, _watch_list(spark, sf_dir), "user_id")


@query("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT n_nationkey FROM nation)")
def join_broadcast_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return drop_listed(events, _watch_list(spark, sf_dir), "user_id")


@query("SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return union_bag(customers, suppliers)


@query("""
SELECT o_orderstatus, count(*) AS n FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY o_orderstatus
""")
def set_union_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return union_bag(orders, orders).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return intersect_rows(customers, suppliers)
