"""Metrics over the wide transaction table; batch jobs and micro-batches share them."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.dates import RECENT_DAYS, is_recent

# Columns of the wide table and what the metrics look for by default.
WIDE_COLUMNS = [
    "fecha", "DNI", "importe", "descripcion", "categoria", "tarjetaCredito",
    "ciudad", "nombre", "cuentaCorriente",
]
HIGH_PAYMENT = 500
WATCHED_CITY = "London"
WATCHED_CATEGORY = "ocio"


@dataclass(frozen=True)
class MetricOptions:
    above: float = HIGH_PAYMENT
    city: str = WATCHED_CITY
    category: str = WATCHED_CATEGORY
    as_of: datetime.date | None = None
    days: int = RECENT_DAYS
    exclude_future: bool = False


def wide_from_rows(rows: DataFrame) -> DataFrame:
    """Wide table when every row already holds the transaction and its customer: no join."""
    return rows.select(
        *[F.col("geolocalizacion.ciudad").alias(name) if name == "ciudad" else F.col(name) for name in WIDE_COLUMNS]
    )


def wide_from_tables(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Wide table from transactions and customers that come from two sources, joined by id."""
    return wide_from_rows(transactions.join(customers, "DNI"))


def city_counts(wide: DataFrame) -> DataFrame:
    """Transactions per city, busiest first."""
    return (
        wide.groupBy("ciudad")
        .agg(F.count("ciudad").alias("NumTransacciones"))
        .orderBy(F.desc("NumTransacciones"), "ciudad")
    )


def high_payments(wide: DataFrame, above: float = HIGH_PAYMENT) -> DataFrame:
    """Customer of every payment above the bound, one row per payment."""
    return wide.where(F.col("importe") > above).select("nombre", "DNI")


def city_rows(wide: DataFrame, city: str = WATCHED_CITY) -> DataFrame:
    """Transactions in one city, ordered by customer; the other columns break ties, so that
    a customer with very many rows is spread over tasks."""
    ties = [c for c, kind in wide.dtypes if c != "DNI" and not kind.startswith(("map", "variant"))]
    return wide.where(F.col("ciudad") == city).orderBy("DNI", *ties)


def category_rows(wide: DataFrame, category: str = WATCHED_CATEGORY) -> DataFrame:
    return wide.where(F.col("categoria") == category)


def recent_rows(
    wide: DataFrame, as_of: datetime.date | None = None, days: int = RECENT_DAYS, exclude_future: bool = False
) -> DataFrame:
    return wide.where(is_recent("fecha", as_of, days, exclude_future))


def card_means(wide: DataFrame, name: str = "mean_importe", digits: int | None = None) -> DataFrame:
    """Mean payment per card type, highest first."""
    mean = F.avg("importe")
    if digits is not None:
        mean = F.round(mean, digits)
    return wide.groupBy("tarjetaCredito").agg(mean.alias(name)).orderBy(F.desc(name), "tarjetaCredito")


def batch_metrics(wide: DataFrame, options: MetricOptions = MetricOptions()) -> dict[str, DataFrame]:
    """The five metrics of the batch job, by name."""
    return {
        "city_counts": city_counts(wide),
        "high_payments": high_payments(wide, options.above),
        "city_rows": city_rows(wide, options.city),
        "category_rows": category_rows(wide, options.category),
        "recent_rows": recent_rows(wide, options.as_of, options.days, options.exclude_future),
    }


def speed_metrics(wide: DataFrame, options: MetricOptions = MetricOptions()) -> dict[str, DataFrame]:
    """The six metrics of a micro-batch: those of the batch job and the card means."""
    return {**batch_metrics(wide, options), "card_means": card_means(wide)}


# Columns of each result, in order; the rows of the first four are rows of the wide table.
RESULT_COLUMNS = {
    "high_payments": ["nombre", "DNI"],
    "city_rows": WIDE_COLUMNS,
    "category_rows": WIDE_COLUMNS,
    "recent_rows": WIDE_COLUMNS,
    "city_counts": ["ciudad", "NumTransacciones"],
    "card_means": ["tarjetaCredito", "mean_importe"],
    "rejects": ["line", "reason"],
}


def tagged_results(checked: DataFrame, options: MetricOptions = MetricOptions()) -> DataFrame:
    """The six metrics and the rejected lines of a checked table, from one pass over it.

    (result, columns of all results): every row is tagged with the results it has a part in,
    carrying only what they need, and one grouping by tag and carried columns makes them all.
    Rows that repeat in a result are counted there and given out as often.
    """
    good = F.col("reason").isNull()
    city = F.col("geolocalizacion.ciudad")
    source = {name: city if name == "ciudad" else F.col(name) for name in WIDE_COLUMNS}
    kinds = {name: kind for name, kind in wide_from_rows(checked).dtypes} | {"line": "string", "reason": "string"}

    def tagged(result: str, condition: Column, carried: dict[str, Column], amount: Column | None = None) -> Column:
        fields = [carried.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]
        value = (F.lit(None) if amount is None else amount).cast("double").alias("_amount")
        return F.when(condition, F.struct(F.lit(result).alias("result"), *fields, value))

    def picked(result: str) -> dict[str, Column]:
        return {name: source[name] for name in RESULT_COLUMNS[result] if name in source}

    tags = [
        tagged("high_payments", good & (F.col("importe") > options.above), picked("high_payments")),
        tagged("city_rows", good & (city == options.city), picked("city_rows")),
        tagged("category_rows", good & (F.col("categoria") == options.category), picked("category_rows")),
        tagged(
            "recent_rows",
            good & is_recent("fecha", options.as_of, options.days, options.exclude_future),
            picked("recent_rows"),
        ),
        tagged("city_counts", good, picked("city_counts")),
        tagged("card_means", good, picked("card_means"), F.col("importe")),
        tagged("rejects", ~good, {"line": F.col("line"), "reason": F.col("reason")}),
    ]
    parts = checked.select(F.explode(F.array_compact(F.array(*tags))).alias("part")).select("part.*")
    grouped = parts.groupBy("result", *kinds).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.count("ciudad").alias("_cities"),
        F.avg("_amount").alias("_mean"),
    )
    whole = F.col("result").isin("city_counts", "card_means")
    copies = F.when(whole, F.lit(1).cast("long")).otherwise(F.col("_copies"))
    return grouped.select(
        "result",
        *kinds,
        F.when(F.col("result") == "city_counts", F.col("_cities")).alias("NumTransacciones"),
        F.when(F.col("result") == "card_means", F.col("_mean")).alias("mean_importe"),
        F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("_copy"),
    ).drop("_copy")


def result_of(tagged: DataFrame, name: str) -> DataFrame:
    """One result of :func:`tagged_results`, with its columns and in its order."""
    found = tagged.where(F.col("result") == name).select(*RESULT_COLUMNS[name])
    if name == "city_counts":
        return found.orderBy(F.desc("NumTransacciones"), "ciudad")
    if name == "card_means":
        return found.orderBy(F.desc("mean_importe"), "tarjetaCredito")
    if name == "city_rows":
        return found.orderBy("DNI", *[column for column in WIDE_COLUMNS if column != "DNI"])
    return found
