"""The jobs from their input lines on: parsed, numbered, made wide and summed up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.numbering import with_ordered_id
from tallyhouse.plans import incidents
from tallyhouse.plans.transactions import MetricOptions, tagged_results
from tallyhouse.queries.inputs import transaction_messages
from tallyhouse.queries.registry import AS_OF, query, table
from tallyhouse.session import write_through
from tallyhouse.sources.transactions import check_transactions, raw_transactions_of

OPTIONS = MetricOptions(above=200_000, city="City 3", as_of=AS_OF)

# The messages of orders in SQL, with what a parser should make of them.
WITH_CHECKED = """
WITH checked AS (
  SELECT o_orderkey AS tid, row_number() OVER (ORDER BY o_orderkey) AS DNI,
         CASE WHEN o_orderkey % 11 = 0 THEN 'field count' WHEN o_orderkey % 13 = 0 THEN 'amount' END AS reason,
         day(o_orderdate) || '/' || month(o_orderdate) || '/' || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')
           || ' ' || (o_orderkey % 24) || ':30,P,'
           || CASE WHEN o_orderkey % 13 = 0 THEN 'none' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END
           || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE
                ',' || o_orderpriority || ',Customer ' || o_custkey || ', City ' || (o_orderkey % 7) || ' ,C' || o_custkey
                || ',u,51.5,-0.25, ' || ['Cinema', 'rent', 'home insurance', 'Groceries'][o_orderkey % 4 + 1] || ' ' END AS line,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS importe, CAST(o_orderdate AS DATE) AS fecha,
         ['Cinema', 'rent', 'home insurance', 'Groceries'][o_orderkey % 4 + 1] AS descripcion,
         ['ocio', 'alquiler', 'seguros', 'otro'][o_orderkey % 4 + 1] AS categoria,
         o_orderpriority AS tarjetaCredito, 'City ' || (o_orderkey % 7) AS ciudad,
         'Customer ' || o_custkey AS nombre, 'C' || o_custkey AS cuentaCorriente
  FROM orders
), wide AS (SELECT * EXCLUDE (tid, reason, line) FROM checked WHERE reason IS NULL)
"""
_WIDE = "fecha, DNI, importe, descripcion, categoria, tarjetaCredito, ciudad, nombre, cuentaCorriente"


@query(WITH_CHECKED + f"""
SELECT 'city_rows' AS result, {_WIDE}, NULL AS line, NULL AS reason,
       NULL::BIGINT AS NumTransacciones, NULL::DOUBLE AS mean_importe FROM wide WHERE ciudad = 'City 3'
UNION ALL BY NAME SELECT 'category_rows' AS result, {_WIDE} FROM wide WHERE categoria = 'ocio'
UNION ALL BY NAME SELECT 'recent_rows' AS result, {_WIDE} FROM wide
  WHERE date_diff('day', fecha, DATE '2001-08-01') < 30
UNION ALL BY NAME SELECT 'high_payments' AS result, nombre, DNI FROM wide WHERE importe > 200000
UNION ALL BY NAME SELECT 'city_counts' AS result, ciudad, count(*) AS NumTransacciones FROM wide GROUP BY ciudad
UNION ALL BY NAME SELECT 'card_means' AS result, tarjetaCredito, round(avg(importe), 2) AS mean_importe
  FROM wide GROUP BY tarjetaCredito
UNION ALL BY NAME SELECT 'rejects' AS result, line, reason FROM checked WHERE reason IS NOT NULL
""")
def job_chain_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to all results of the speed job: parsed once, numbered, and summed up in one pass."""
    checked = write_through(check_transactions(raw_transactions_of(transaction_messages(spark, sf_dir)), pivot_year=46))
    results = tagged_results(with_ordered_id(checked, ["tid"], "DNI"), OPTIONS)
    return results.withColumn("mean_importe", F.round("mean_importe", 2))


HEADER = "id,case,date,block,code,type,text,place,offence,arrest,domestic,age"


def _incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as incident lines under a header line: every seventh victim's age is blank, every ninth unreadable."""
    key, age = F.col("o_orderkey"), (F.col("o_orderkey") % 60 + 18).cast("string")
    shown = F.when(key % 7 == 0, "").when(key % 9 == 0, F.concat(F.lit("about "), age)).otherwise(age)
    lines = table(spark, sf_dir, "orders").select(F.concat_ws(
        ",", key, F.lit("a"), F.col("o_orderdate").cast("string"), *[F.lit("x")] * 5, "o_orderpriority", F.lit("y"),
        F.lit("n"), shown, F.lit("end"),
    ).alias("value"))
    header = spark.createDataFrame([(HEADER,)], "value string")
    return incidents.incident_fields(incidents.without_header_line(header.union(lines)))


@query("SELECT count(*) AS n FROM orders")
def job_chain_incident_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.incident_total(_incidents(spark, sf_dir))


@query("SELECT o_orderpriority AS offence, count(*) AS n FROM orders GROUP BY 1")
def job_chain_offences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.most_frequent(_incidents(spark, sf_dir))


@query("""
SELECT round(avg(CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 9 = 0 THEN 25 ELSE o_orderkey % 60 + 18 END), 6) AS mean_age
FROM orders
""")
def job_chain_mean_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = incidents.mean_with_default(_incidents(spark, sf_dir))
    return mean.select(F.round("mean_age", 6).alias("mean_age"))
