"""The named jobs on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.dates import epoch_seconds
from tallyhouse.plans import incidents, text
from tallyhouse.plans.fraud import suspicious_multi_city, suspicious_same_city, window_counts
from tallyhouse.plans.ratings import mean_rating
from tallyhouse.plans.transactions import (
    card_means,
    category_rows,
    city_counts,
    city_rows,
    high_payments,
    recent_rows,
)
from tallyhouse.queries.expressions import K_TEXT, _numbers_as_text
from tallyhouse.queries.projections import STOP_WORDS
from tallyhouse.queries.registry import AS_OF, CITY, HIGH_TOTAL, WITH_T, WITH_WORDS, query, table, transactions


def _windows_sql(size: int, slide: int) -> str:
    """CTE ``hits``: events repeated for every sliding window they fall in; times in seconds."""
    first = f"CAST(floor(epoch(ts) / {slide}) AS BIGINT)"
    return f"""
WITH hits AS (
  SELECT ({first} - i) * {slide} AS start, user_id, event_type
  FROM events, range({size // slide}) r(i)
  WHERE ({first} - i) * {slide} + {size} > epoch(ts)
)
"""


@query(_windows_sql(120, 15) + "SELECT start, user_id, event_type, count(*) AS n FROM hits GROUP BY ALL")
def win_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = window_counts(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", name="n")
    return counts.withColumn("start", epoch_seconds("start"))


@query(WITH_T + "SELECT * FROM t")
def job_tablon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


@query(WITH_T + "SELECT ciudad, count(ciudad) AS NumTransacciones FROM t GROUP BY ciudad")
def job_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_counts(transactions(spark, sf_dir))


@query(WITH_T + f"SELECT nombre, DNI FROM t WHERE importe > {HIGH_TOTAL}")
def job_high_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_payments(transactions(spark, sf_dir), HIGH_TOTAL)


@query(WITH_T + f"SELECT * FROM t WHERE ciudad = '{CITY}'")
def job_city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_rows(transactions(spark, sf_dir), CITY)


@query(WITH_T + "SELECT * FROM t WHERE categoria = 'ocio'")
def job_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_rows(transactions(spark, sf_dir))


@query(WITH_T + "SELECT * FROM t WHERE date_diff('day', fecha, DATE '2001-08-01') < 30")
def job_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_rows(transactions(spark, sf_dir), AS_OF)


@query(WITH_T + "SELECT tarjetaCredito, round(avg(importe), 2) AS mean_importe FROM t GROUP BY tarjetaCredito")
def job_card_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_means(transactions(spark, sf_dir), digits=2)


@query(_windows_sql(21600, 3600) + """
SELECT start, user_id, event_type, count(*) AS count FROM hits GROUP BY ALL HAVING count(*) > 1
""")
def job_suspicious_same_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suspicious_same_city(
        table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "6 hours", "1 hour"
    )
    return found.withColumn("start", epoch_seconds("start"))


@query(_windows_sql(21600, 3600) + """
SELECT start, user_id, count(*) AS count FROM hits GROUP BY ALL HAVING count(DISTINCT event_type) > 1
""")
def job_suspicious_multi_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suspicious_multi_city(
        table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "6 hours", "1 hour"
    )
    return found.withColumn("start", epoch_seconds("start"))


@query("""
SELECT l_partkey AS usuarioId, round(avg(l_quantity), 2) AS mean_rating
FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY l_partkey
""")
def job_mean_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("usuarioId"))
    ratings = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("usuarioId"), F.col("l_quantity").alias("nota")
    )
    return mean_rating(users, ratings, digits=2)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.text_lines(table(spark, sf_dir, "documents"))


@query(WITH_WORDS + "SELECT word, count(*) AS n FROM words GROUP BY word")
def job_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(_lines(spark, sf_dir))


@query(WITH_WORDS + """
SELECT word, count(*) AS n FROM words WHERE length(word) > 3 AND word NOT IN ('that', 'with')
GROUP BY word ORDER BY n DESC, word LIMIT 10
""")
def job_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.top_words(_lines(spark, sf_dir), stop_list=STOP_WORDS)


@query(WITH_WORDS + """
SELECT round(avg(length(word)), 6) AS mean_length FROM words WHERE length(word) > 3 AND word NOT IN ('that', 'with')
""")
def job_mean_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = text.mean_word_length(_lines(spark, sf_dir), STOP_WORDS)
    return mean.select(F.round("mean_length", 6).alias("mean_length"))


@query("SELECT count(*) AS n FROM events")
def job_event_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.incident_total(table(spark, sf_dir, "events"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def job_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.most_frequent(table(spark, sf_dir, "events"), "event_type")


@query(K_TEXT + "SELECT round(avg(coalesce(TRY_CAST(text AS INTEGER), 25)), 6) AS mean_age FROM texts")
def job_mean_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = incidents.mean_with_default(_numbers_as_text(spark, sf_dir), "text")
    return mean.select(F.round("mean_age", 6).alias("mean_age"))
