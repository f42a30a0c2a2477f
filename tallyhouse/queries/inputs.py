"""Sources, row text and catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.text import row_text
from tallyhouse.plans.text import text_lines
from tallyhouse.queries.registry import WITH_LINES, query, table
from tallyhouse.schemas import PERSON
from tallyhouse.sinks.catalog import publish_view
from tallyhouse.sources.files import as_schema, drop_header, query_files, typed_fields
from tallyhouse.sources.replay import replay_files, replay_sample
from tallyhouse.sources.transactions import accepted, check_transactions, raw_transactions_of, rejected

PART_FIELDS = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("size", T.IntegerType()),
])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def src_drop_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = {"key": "o_orderkey", "status": "o_orderstatus", "priority": "o_orderpriority"}
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    headers = spark.createDataFrame([tuple(header.values())] * 2, rows.schema)
    return drop_header(headers.union(rows), header)


@query(WITH_LINES + "SELECT doc_id, line_no, value FROM lines")
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("SELECT p_partkey AS key, p_name AS name, p_size AS size FROM part")
def src_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(F.concat_ws("::", "p_partkey", "p_name", "p_size").alias("value"))
    return typed_fields(lines, "value", PART_FIELDS, "::")


@query("SELECT p_name AS name, CAST(p_size AS BIGINT) AS age FROM part")
def src_csv_text_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(F.concat_ws(", ", "p_name", "p_size").alias("value"))
    return typed_fields(lines, "value", PERSON)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def src_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_sql_on_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_files(spark, "parquet", f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS age FROM customer")
def src_as_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "name", "c_nationkey": "age"})
    return as_schema(people, PERSON)


@query("SELECT unnest(range(1, (SELECT count(*) FROM part) + 1)) AS id")
def src_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1, table(spark, sf_dir, "part").count() + 1)


@query("""
WITH rows_of AS (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
     draws AS (SELECT i AS draw, (i * 7919) % (SELECT count(*) FROM events) AS pos FROM range(1000) r(i))
SELECT draw, event_id, user_id, event_type FROM draws JOIN rows_of USING (pos)
""")
def src_replay_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return replay_sample(events, order_by=["event_id"], position=F.col("draw") * 7919)


@query("""
WITH rows_of AS (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
     draws AS (SELECT i AS draw, (i * 104729) % (SELECT count(*) FROM events) AS pos FROM range(1000) r(i))
SELECT draw, event_id, user_id, event_type FROM draws JOIN rows_of USING (pos)
""")
def src_replay_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The events lie in their files by rising id, so that SQL can tell the places as well.
    return replay_files(
        spark, f"{sf_dir}/events.parquet", ["event_id", "user_id", "event_type"], position=F.col("draw") * 104729
    )


def transaction_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transaction messages: every 11th too short, every 13th with a bad amount."""
    orders = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    when = F.concat(
        F.dayofmonth(day), F.lit("/"), F.month(day), F.lit("/"),
        F.lpad((F.year(day) % 100).cast("string"), 2, "0"), F.lit(" "), (key % 24).cast("string"), F.lit(":30"),
    )
    amount = F.when(key % 13 == 0, "none").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    spending = F.element_at(
        F.array(*[F.lit(x) for x in ("Cinema", "rent", "home insurance", "Groceries")]), (key % 4 + 1).cast("int")
    )
    short = F.concat_ws(",", when, F.lit("P"), amount)
    full = F.concat_ws(
        ",", short, F.col("o_orderpriority"), F.concat(F.lit("Customer "), F.col("o_custkey")),
        F.concat(F.lit(" City "), key % 7, F.lit(" ")), F.concat(F.lit("C"), F.col("o_custkey")),
        F.lit("u"), F.lit("51.5"), F.lit("-0.25"), F.concat(F.lit(" "), spending, F.lit(" ")),
    )
    return orders.select(key.alias("tid"), F.when(key % 11 == 0, short).otherwise(full).alias("value"))


@query("""
SELECT o_orderkey AS tid, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS importe,
       CAST(o_orderdate AS DATE) AS fecha, o_orderkey % 24 AS hour,
       ['Cinema', 'rent', 'home insurance', 'Groceries'][o_orderkey % 4 + 1] AS descripcion,
       ['ocio', 'alquiler', 'seguros', 'otro'][o_orderkey % 4 + 1] AS categoria,
       o_orderpriority AS tarjetaCredito, 'City ' || (o_orderkey % 7) AS ciudad, 'N/A' AS pais,
       51.5::DOUBLE AS latitud, -0.25::DOUBLE AS longitud,
       'Customer ' || o_custkey AS nombre, 'C' || o_custkey AS cuentaCorriente
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
""")
def src_transaction_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accepted(check_transactions(raw_transactions_of(transaction_messages(spark, sf_dir)), pivot_year=46))
    return rows.select(
        "tid", "importe", "fecha", F.hour("momento").cast("long").alias("hour"), "descripcion", "categoria",
        "tarjetaCredito", "geolocalizacion.ciudad", "geolocalizacion.pais", "geolocalizacion.latitud",
        "geolocalizacion.longitud", "nombre", "cuentaCorriente",
    )


@query("""
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'field count' ELSE 'amount' END AS reason, count(*) AS n
FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 GROUP BY 1
""")
def src_transaction_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rejected(check_transactions(raw_transactions_of(transaction_messages(spark, sf_dir)), pivot_year=46))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey, '[' || c_custkey || ',' || c_name || ',' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') || ']'
       AS line FROM customer
""")
def snk_row_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", row_text("c_custkey", "c_name", segment).alias("line")
    )


@query("SELECT * FROM supplier")
def cat_temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = publish_view(table(spark, sf_dir, "supplier"), "supplier_rows")
    return spark.sql(f"SELECT * FROM {view}")


@query("SELECT * FROM customer")
def cat_global_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = publish_view(table(spark, sf_dir, "customer"), "customer_rows", all_sessions=True)
    return spark.newSession().sql(f"SELECT * FROM {view}")


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def sql_from_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = publish_view(table(spark, sf_dir, "orders"), "order_rows")
    return spark.sql(f"FROM {view} SELECT o_orderkey, o_orderpriority")
