"""Fraud job: sliding-window repeats on the stream itself, with state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.plans.fraud import WINDOW_SIZE, WINDOW_SLIDE, suspicious_multi_city, suspicious_same_city
from tallyhouse.sinks.kafka import RESULT_TOPIC, encode_rows
from tallyhouse.sources.transactions import accepted, check_transactions, raw_transactions_of
from tallyhouse.streaming.control import SPEED_INTERVAL, with_trigger

# How late a transaction may come and still be counted.
ALLOWED_LATENESS = "2 minutes"


def transactions_of(messages: DataFrame, header: dict[str, str] | None = None, pivot_year: int | None = None) -> DataFrame:
    """Good transactions of a message stream, with ``momento`` and the city as ``ciudad``."""
    rows = accepted(check_transactions(raw_transactions_of(messages), header, pivot_year))
    return rows.withColumn("ciudad", rows["geolocalizacion.ciudad"])


def suspicious_stream(
    rows: DataFrame,
    person: str = "cuentaCorriente",
    city: str = "ciudad",
    time: str = "momento",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    lateness: str = ALLOWED_LATENESS,
    several_cities: bool = False,
    by_panes: bool = False,
) -> DataFrame:
    """Suspicious repeats per window.

    ``time`` is the transaction time, or an arrival time stamped at the source
    to group by when messages came in. In append mode a window is given out once
    the newest time seen is ``lateness`` past its end; state older than that is dropped.
    ``by_panes``, for append mode only, counts a message once instead of once per window,
    see :func:`tallyhouse.operators.panes.stream_window_values`.
    """
    found = suspicious_multi_city if several_cities else suspicious_same_city
    return found(rows.withWatermark(time, lateness), person, city, time, size, slide, by_panes)


def fraud_job(
    suspicious: DataFrame,
    checkpoint: str,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    topic: str = RESULT_TOPIC,
    mode: str = "append",
    interval: int | None = SPEED_INTERVAL,
) -> DataStreamWriter:
    """Writer that gives suspicious windows out; rows become text records for Kafka."""
    records = encode_rows(suspicious, topic) if sink_format == "kafka" else suspicious
    writer = (
        records.writeStream.outputMode(mode)
        .format(sink_format)
        .options(**(sink_options or {}))
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval)
