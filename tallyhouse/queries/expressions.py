"""Text, cast, date, calculator, category and registered functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.categories import category_of, with_category
from tallyhouse.functions.dates import date_of_parts, date_parts, strict_date_of_parts
from tallyhouse.functions.numbers import calculate, try_parse, whole_number_or
from tallyhouse.functions.registered import register_functions
from tallyhouse.functions.text import before_blank, drop_first, drop_last, split_trimmed, trim_controls
from tallyhouse.queries.registry import AS_OF, SEGMENT_GROUPS, WITH_T, query, table, transactions
from tallyhouse.sinks.catalog import publish_view


def _of_name(spark: SparkSession, sf_dir: str, expression: Column) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", expression.alias("result"))


@query("SELECT p_partkey, replace(p_name, ' ', '|') AS result FROM part")
def str_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.col("p_name"), F.lit("   "))
    return _of_name(spark, sf_dir, F.array_join(split_trimmed(padded, " "), "|"))


@query("SELECT p_partkey, p_name AS result FROM part")
def str_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_name(spark, sf_dir, trim_controls(F.concat(F.lit("\t "), F.col("p_name"), F.lit(" \r\n"))))


@query("SELECT p_partkey, substr(p_name, 2) AS result FROM part")
def str_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_name(spark, sf_dir, drop_first("p_name"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS result FROM part")
def str_before_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_name(spark, sf_dir, before_blank("p_name"))


@query("SELECT p_partkey, substr(p_name, 1, length(p_name) - 1) AS result FROM part")
def str_drop_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_name(spark, sf_dir, drop_last("p_name"))


@query("SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS result FROM part")
def str_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_name(spark, sf_dir, F.length("p_name"))


@query("SELECT p_partkey, replace(p_name, ' ', '') AS result FROM part")
def str_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    bracketed = F.concat(F.lit("["), F.col("p_name"))
    return _of_name(spark, sf_dir, F.replace(F.replace(bracketed, F.lit("[")), F.lit(" ")))


def _numbers_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` of each event as text; every 10th blank, every 7th not a number."""
    k = F.get_json_object("props", "$.k")
    number = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        k.alias("good_text"),
        F.when(number % 10 == 0, "").when(number % 7 == 0, F.concat(F.lit("x"), k)).otherwise(k).alias("text"),
    )


K_TEXT = """
WITH texts AS (
  SELECT event_id, json_extract_string(props, '$.k') AS good_text,
         CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 7 = 0 THEN 'x' || json_extract_string(props, '$.k')
              ELSE json_extract_string(props, '$.k') END AS text
  FROM events
)
"""


@query(K_TEXT + "SELECT event_id, CAST(good_text AS INTEGER) AS k FROM texts")
def cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers_as_text(spark, sf_dir).select("event_id", F.col("good_text").cast("int").alias("k"))


@query(K_TEXT + "SELECT event_id, TRY_CAST(text AS INTEGER) AS k FROM texts")
def cast_try(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers_as_text(spark, sf_dir).select("event_id", try_parse("text", T.IntegerType()).alias("k"))


@query(K_TEXT + "SELECT event_id, coalesce(TRY_CAST(text AS INTEGER), 25) AS k FROM texts")
def cast_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers_as_text(spark, sf_dir).select("event_id", whole_number_or("text", 25).alias("k"))


def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of order dates given as ``d/M/yy H:mm`` text, the month moved on by up to two (13 and 14 occur)."""
    day = F.col("o_orderdate")
    text = F.concat(
        F.dayofmonth(day), F.lit("/"), F.month(day) + F.col("o_orderkey") % 3, F.lit("/"),
        F.lpad((F.year(day) % 100).cast("string"), 2, "0"), F.lit(" 6:17"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", date_parts(text).alias("parts"))


@query("""
SELECT o_orderkey, CAST(make_date(year(o_orderdate), 1, 1)
                        + to_months(CAST(month(o_orderdate) - 1 + o_orderkey % 3 AS INTEGER))
                        + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) AS DATE) AS date
FROM orders
""")
def date_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_parts(spark, sf_dir).select("o_orderkey", date_of_parts("parts", pivot_year=46).alias("date"))


@query("""
SELECT o_orderkey, TRY_CAST(year(o_orderdate) || '-' || (month(o_orderdate) + o_orderkey % 3) || '-' || day(o_orderdate)
                            AS DATE) AS date
FROM orders
""")
def date_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_parts(spark, sf_dir).select("o_orderkey", strict_date_of_parts("parts", pivot_year=46).alias("date"))


@query("SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS days FROM orders")
def date_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.datediff(F.lit(AS_OF), F.col("o_orderdate").cast("date")).cast("long").alias("days")
    )


@query("""
WITH worked AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS a, l_tax AS b, l_linenumber % 5 AS op FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN op = 3 AND b = 0 THEN NULL
            ELSE round(CASE op WHEN 0 THEN a + b WHEN 1 THEN a - b WHEN 2 THEN a * b WHEN 3 THEN a / b ELSE 0.0 END, 6)
       END AS result,
       op = 3 AND b = 0 AS infinite
FROM worked
""")
def math_calc(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(name) for name in ("SUMA", "resta", "Multiplicacion", "division", "raiz")])
    operation = F.get(names, F.col("l_linenumber") % 5)
    result = calculate("l_extendedprice", "l_tax", operation)
    infinite = F.abs(result) == float("inf")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(~infinite, F.round(result, 6)).alias("result"), infinite.alias("infinite"),
    )


@query(WITH_T + "SELECT tid, categoria FROM t")
def cat_lookup_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select("tid", category_of("descripcion", SEGMENT_GROUPS).alias("categoria"))


@query(WITH_T + "SELECT tid, categoria FROM t")
def cat_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).drop("categoria")
    return with_category(rows, groups=SEGMENT_GROUPS).select("tid", "categoria")


@query("SELECT p_partkey, p_name AS cleaned FROM part")
def udf_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    view = publish_view(table(spark, sf_dir, "part"), "part_names")
    return spark.sql(f"SELECT p_partkey, clean(concat(p_name, ']')) AS cleaned FROM {view}")


@query("SELECT p_name, length(p_name) AS name_length FROM part")
def udf_strlen(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    view = publish_view(table(spark, sf_dir, "part"), "part_names")
    return spark.sql(f"SELECT p_name, strLen(p_name) AS name_length FROM {view}")
