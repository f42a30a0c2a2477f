"""Query registration and the transaction view of the test tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.categories import category_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register the decorated function under its name, with its SQL twin."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# How the market segments of the test tables stand for spending groups.
SEGMENT_GROUPS = {
    "seguros": ["BUILDING"],
    "ocio": ["AUTOMOBILE", "FURNITURE"],
    "alquiler": ["MACHINERY"],
}
AS_OF = datetime.date(2001, 8, 1)
HIGH_TOTAL = 300000
CITY = "NATION_3"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers and nations, as transactions with id ``tid``.

    Customers meet the small nation table first, so the orders are joined only
    once; adaptive execution splits a customer that holds many of them.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tid"),
        F.col("o_custkey").alias("DNI"),
        F.col("o_totalprice").alias("importe"),
        F.col("o_orderpriority").alias("tarjetaCredito"),
        F.col("o_orderdate").cast("date").alias("fecha"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("DNI"),
        F.col("c_name").alias("nombre"),
        F.col("c_mktsegment").alias("descripcion"),
        F.col("c_nationkey").alias("nation"),
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("ciudad")
    )
    located = customers.join(nations, "nation").drop("nation")
    return orders.join(located, "DNI").withColumn("categoria", category_of("descripcion", SEGMENT_GROUPS))


# The same view in SQL, to be put before a SELECT.
WITH_T = """
WITH t AS (
  SELECT o_orderkey AS tid, o_custkey AS DNI, o_totalprice AS importe,
         o_orderpriority AS tarjetaCredito, CAST(o_orderdate AS DATE) AS fecha,
         c_name AS nombre, c_mktsegment AS descripcion, n_name AS ciudad,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'seguros' WHEN 'AUTOMOBILE' THEN 'ocio'
              WHEN 'FURNITURE' THEN 'ocio' WHEN 'MACHINERY' THEN 'alquiler' ELSE 'otro' END AS categoria
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)
"""

# Lines of whole documents in SQL; the last empty line of a text is none.
WITH_LINES = r"""
WITH cut AS (
  SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS parts FROM documents
), kept AS (
  SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS parts FROM cut
), lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS value FROM kept
)
"""

# Blank-separated words of those lines, without trailing empty parts.
WITH_WORDS = WITH_LINES + """
, words AS (
  SELECT unnest(string_split(rtrim(value, ' '), ' ')) AS word
  FROM lines WHERE value = '' OR rtrim(value, ' ') <> ''
)
"""
