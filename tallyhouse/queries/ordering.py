"""Row numbers, sorts and top-k. Sorted results carry their rank, numbered across partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.numbering import first_per_key, largest, smallest, with_ordered_id
from tallyhouse.operators.ranges import Falling
from tallyhouse.plans.transactions import city_counts
from tallyhouse.queries.registry import CITY, WITH_T, query, table, transactions


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def win_surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return with_ordered_id(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
) WHERE rn = 1
""")
def win_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(WITH_T + """
, counts AS (SELECT ciudad, count(*) AS NumTransacciones FROM t GROUP BY ciudad)
SELECT ciudad, NumTransacciones, row_number() OVER (ORDER BY NumTransacciones DESC, ciudad) AS rank FROM counts
""")
def srt_desc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordered_id(
        city_counts(transactions(spark, sf_dir)), [Falling("NumTransacciones"), "ciudad"], name="rank"
    )


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY user_id DESC, event_id) AS rank FROM events")
def srt_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return with_ordered_id(events, [Falling("user_id"), "event_id"], name="rank")


@query("""
SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_size * p_retailprice DESC, p_partkey) AS rank FROM part
""")
def srt_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    ranked = with_ordered_id(parts, [Falling(F.col("p_size") * F.col("p_retailprice")), "p_partkey"], name="rank")
    return ranked.drop("p_size", "p_retailprice")


@query(WITH_T + f"""
SELECT tid, DNI, importe, row_number() OVER (ORDER BY DNI, tid) AS rank FROM t WHERE ciudad = '{CITY}'
""")
def srt_city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).where(F.col("ciudad") == CITY).select("tid", "DNI", "importe")
    return with_ordered_id(rows, ["DNI", "tid"], name="rank")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_size, p_name, p_partkey) AS rank FROM part")
def srt_two_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_size", "p_name", "p_partkey")
    return with_ordered_id(parts, ["p_size", "p_name", "p_partkey"], name="rank").select("p_partkey", "rank")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5")
def top_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 5, "o_totalprice", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def top_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallest(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 5, "o_totalprice", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def top_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallest(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 10, "o_orderkey")


@query("SELECT p_partkey, p_name, p_size AS edad FROM part ORDER BY p_partkey LIMIT 1")
def top_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").withColumnRenamed("p_size", "edad")
    return smallest(parts, 1, "p_partkey")
