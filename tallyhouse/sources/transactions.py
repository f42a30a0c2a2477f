"""Transaction lines to a typed table, with a table of rejected lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.categories import category_of
from tallyhouse.functions.dates import clock_of, date_of_parts, date_parts
from tallyhouse.functions.numbers import try_parse
from tallyhouse.functions.text import trim_controls
from tallyhouse.schemas import MALFORMED, RAW_TRANSACTION, RAW_TRANSACTION_FIELDS
from tallyhouse.sources.files import drop_header

# Fixed value: the country of every location.
UNKNOWN_COUNTRY = "N/A"


def read_raw_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Eleven text fields per line of the files under ``path``."""
    return (
        spark.read.schema(RAW_TRANSACTION)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )


def raw_transactions_of(messages: DataFrame, value: str = "value") -> DataFrame:
    """The same eleven fields from a column of message texts, batch or stream."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    columns = ", ".join(f"{field} string" for field in RAW_TRANSACTION.fieldNames())
    others = [column for column in messages.columns if column != value]
    # Taken apart by a generator: every line is read once, not once per field.
    fields = messages.select(*others, value, F.inline(F.array(F.from_csv(F.col(value), columns, options))))
    text = F.coalesce(F.col(value), F.lit(""))
    blank = F.when(F.trim(text) == "", text)
    return fields.withColumn(MALFORMED, F.coalesce(MALFORMED, blank)).drop(value)


def header_of(line: str) -> dict[str, str]:
    """Header line as the field texts that :func:`check_transactions` drops by value."""
    return dict(zip(RAW_TRANSACTION_FIELDS, line.split(",")))


def _judged(raw: DataFrame, pivot_year: int | None, strict: bool) -> DataFrame:
    """Raw rows with what their ``reason`` needs, and nothing else: numbers, date and reason."""

    def number(field: str) -> Column:
        return F.col(field).cast("double") if strict else try_parse(field, T.DoubleType())

    # Trimmed in a step of its own: the next one uses each text several times.
    trimmed = raw.select(
        "*",
        trim_controls("amount_text").alias("_amount"),
        trim_controls("latitude_text").alias("_latitude"),
        trim_controls("longitude_text").alias("_longitude"),
        date_parts("when_text").alias("_date"),
    )
    parsed = trimmed.select(
        *raw.columns,
        number("_amount").alias("importe"),
        number("_latitude").alias("_latitude"),
        number("_longitude").alias("_longitude"),
        date_of_parts("_date", pivot_year).alias("fecha"),
    )
    reason = (
        F.when(F.col(MALFORMED).isNotNull(), "field count")
        .when(F.col("importe").isNull(), "amount")
        .when(F.col("_latitude").isNull(), "latitude")
        .when(F.col("_longitude").isNull(), "longitude")
        .when(F.col("fecha").isNull(), "date")
    )
    judged = parsed.withColumn("reason", reason)
    # A filter on ``reason`` would otherwise move below the parsing and repeat it.
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def check_transactions(
    raw: DataFrame,
    header: dict[str, str] | None = None,
    pivot_year: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Typed transactions from raw fields, with ``reason`` and ``line`` set where a line is bad.

    ``header``: rows equal to it are dropped, not rejected. ``strict``: a number
    that cannot be read fails the job instead of rejecting its line. Columns
    besides the raw fields (a message time, say) are carried along.
    """
    if header:
        raw = drop_header(raw, header)
    judged = _judged(raw, pivot_year, strict)
    # Everything below is left out of a plan that does not ask for it: rejects need no
    # category or place, good rows no line.
    rebuilt = F.concat_ws(",", *[F.coalesce(F.col(field), F.lit("")) for field in RAW_TRANSACTION_FIELDS])
    carried = [column for column in raw.columns if column not in (*RAW_TRANSACTION_FIELDS, MALFORMED)]
    return judged.withColumn("descripcion", trim_controls("description")).select(
        *carried,
        "importe",
        "descripcion",
        category_of("descripcion").alias("categoria"),
        F.col("card").alias("tarjetaCredito"),
        F.struct(
            F.col("_latitude").alias("latitud"),
            F.col("_longitude").alias("longitud"),
            trim_controls("city").alias("ciudad"),
            F.lit(UNKNOWN_COUNTRY).alias("pais"),
        ).alias("geolocalizacion"),
        "fecha",
        (F.col("fecha").cast("timestamp") + clock_of("when_text")).alias("momento"),
        F.col("name").alias("nombre"),
        F.col("account").alias("cuentaCorriente"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.coalesce(MALFORMED, rebuilt)).alias("line"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    """The good rows of :func:`check_transactions`."""
    return checked.where(F.col("reason").isNull()).drop("reason", "line")


def rejected(checked: DataFrame) -> DataFrame:
    """(line, reason) of the bad ones."""
    return checked.where(F.col("reason").isNotNull()).select("line", "reason")
