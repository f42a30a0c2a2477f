"""Kafka sink: rows become text values, the connector does the sending."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.functions.text import row_text
from tallyhouse.sources.streams import BROKERS

# The topics results go to.
RESULT_TOPIC = "salida"
MESSAGE_RESULT_TOPIC = "mensajesSalida"


def kafka_sink_options(brokers: str = BROKERS) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers}


def encode_rows(df: DataFrame, topic: str = RESULT_TOPIC, as_json: bool = False) -> DataFrame:
    """(topic, value) records; the value is ``[v1,v2,...]`` text or JSON, without a key."""
    value = F.to_json(F.struct(*df.columns)) if as_json else row_text(*df.columns)
    return df.select(F.lit(topic).alias("topic"), value.alias("value"))


def write_kafka(records: DataFrame, brokers: str = BROKERS) -> None:
    """Send (topic, value) records of a batch."""
    records.write.format("kafka").options(**kafka_sink_options(brokers)).save()


def stream_to_kafka(records: DataFrame, checkpoint: str, brokers: str = BROKERS) -> DataStreamWriter:
    """Writer that sends (topic, value) records of a stream."""
    return (
        records.writeStream.format("kafka")
        .options(**kafka_sink_options(brokers))
        .option("checkpointLocation", checkpoint)
    )


def topic_records(results: Mapping[str, DataFrame], topics: Mapping[str, str] | None = None) -> list[DataFrame]:
    """Records of several results, each to its own topic (by default all to one)."""
    return [encode_rows(df, (topics or {}).get(name, RESULT_TOPIC)) for name, df in results.items()]
