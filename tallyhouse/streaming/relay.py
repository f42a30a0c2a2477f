"""Small stream jobs: pass messages on, sum every micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.streaming.control import CONSTANT_INTERVAL, RELAY_INTERVAL, with_trigger


def relay_job(
    messages: DataFrame,
    checkpoint: str,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    interval: int | None = RELAY_INTERVAL,
) -> DataStreamWriter:
    """Writer that passes the ``value`` of every message on unchanged.

    For Kafka give ``sink_options`` the brokers and the topic; for text files the path.
    """
    writer = (
        messages.select("value")
        .writeStream.format(sink_format)
        .options(**(sink_options or {}))
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, interval)


def batch_sums(
    numbers: DataFrame,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    value: str = "value",
    interval: int | None = CONSTANT_INTERVAL,
) -> DataStreamWriter:
    """Writer that hands the sum of each micro-batch, as one row ``total``, to ``sink``."""

    def process(batch: DataFrame, number: int) -> None:
        sink(batch.agg(F.sum(value).alias("total")), number)

    writer = numbers.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return with_trigger(writer, interval)
