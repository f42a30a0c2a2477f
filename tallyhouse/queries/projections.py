"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.dates import is_recent
from tallyhouse.functions.text import field_at, label, split_trimmed
from tallyhouse.plans.text import kept_words, text_lines
from tallyhouse.queries.registry import AS_OF, CITY, HIGH_TOTAL, WITH_T, WITH_WORDS, query, table, transactions
from tallyhouse.sources.transactions import UNKNOWN_COUNTRY

STOP_WORDS = ("that", "with")


@query("SELECT c_custkey, c_name FROM customer")
def prj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query("SELECT * FROM customer")
def prj_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("*")


@query("SELECT p_name, p_size + 1 AS size_plus_one FROM part")
def prj_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_name", (F.col("p_size") + 1).alias("size_plus_one"))


@query("SELECT p_partkey, p_size * 2 AS doubled FROM part")
def prj_map_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 2).alias("doubled"))


@query("SELECT p_partkey, p_name, p_size AS edad FROM part")
def prj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").withColumnRenamed("p_size", "edad")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part")
def prj_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").drop("p_size")


def _located_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").select(
        "c_custkey",
        F.struct(
            (F.col("c_acctbal") / 1000).alias("latitud"),
            F.col("c_nationkey").cast("double").alias("longitud"),
            F.col("n_name").alias("ciudad"),
            F.lit(UNKNOWN_COUNTRY).alias("pais"),
        ).alias("geolocalizacion"),
    )


@query("""
SELECT c_custkey, round(c_acctbal / 1000, 3) AS latitud, CAST(c_nationkey AS DOUBLE) AS longitud,
       n_name AS ciudad, 'N/A' AS pais
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def prj_struct_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located_customers(spark, sf_dir).select("c_custkey", "geolocalizacion.*").withColumn(
        "latitud", F.round("latitud", 3)
    )


@query("SELECT c_custkey, n_name AS ciudad FROM customer JOIN nation ON c_nationkey = n_nationkey")
def prj_nested_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located_customers(spark, sf_dir).select("c_custkey", F.col("geolocalizacion.ciudad").alias("ciudad"))


@query("SELECT p_partkey, 'Name: ' || p_name AS label FROM part")
def prj_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", label("Name: ", "p_name").alias("label")
    )


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def prj_flatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(split_trimmed("p_name")).alias("word"))


@query("""
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS parts, string_split(p_name, ' ')[1] AS first_part
FROM part
""")
def prj_map_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split_trimmed("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.size(parts).alias("parts"), F.get(parts, 0).alias("first_part")
    )


@query("SELECT p_partkey, p_type AS third, CAST(NULL AS VARCHAR) AS ninth FROM part")
def prj_field_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", "p_name", "p_brand", "p_type").alias("line"))
    return lines.select("p_partkey", field_at("line", 2).alias("third"), field_at("line", 8).alias("ninth"))


@query("SELECT p_partkey, upper(p_name) AS name_upper FROM part")
def arr_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(F.transform(split_trimmed("p_name"), F.upper), " ").alias("name_upper")
    )


@query(WITH_T + f"SELECT tid, importe FROM t WHERE importe > {HIGH_TOTAL}")
def flt_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where(F.col("importe") > HIGH_TOTAL).select("tid", "importe")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 21")
def flt_sql_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_size > 21").select("p_partkey", "p_name", "p_size")


@query(WITH_T + f"SELECT tid, ciudad FROM t WHERE ciudad = '{CITY}'")
def flt_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where(F.col("ciudad") == CITY).select("tid", "ciudad")


@query("SELECT p_name, p_size FROM part WHERE p_size >= 13 AND p_size <= 19 AND p_name LIKE 'h%'")
def flt_range_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(
        F.col("p_size").between(13, 19) & F.col("p_name").like("h%")
    ).select("p_name", "p_size")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def flt_mod(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_custkey")


@query(WITH_T + "SELECT tid, descripcion FROM t WHERE descripcion IN ('AUTOMOBILE', 'FURNITURE')")
def flt_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where(F.col("descripcion").isin("AUTOMOBILE", "FURNITURE")).select(
        "tid", "descripcion"
    )


@query(WITH_WORDS + "SELECT count(*) AS n FROM words WHERE length(word) > 3 AND word NOT IN ('that', 'with')")
def flt_len_notin(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text_lines(table(spark, sf_dir, "documents"))
    return kept_words(lines, STOP_WORDS).agg(F.count(F.lit(1)).alias("n"))


@query(WITH_T + "SELECT tid, fecha FROM t WHERE date_diff('day', fecha, DATE '2001-08-01') < 30")
def flt_recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where(is_recent("fecha", AS_OF)).select("tid", "fecha")
