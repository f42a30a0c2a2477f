"""Speed job: six metrics for every micro-batch of transaction messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tallyhouse.operators.numbering import with_surrogate_id
from tallyhouse.plans.transactions import RESULT_COLUMNS, MetricOptions, result_of, tagged_results
from tallyhouse.session import write_through
from tallyhouse.sinks.files import write_files
from tallyhouse.sinks.kafka import RESULT_TOPIC, encode_rows, write_kafka
from tallyhouse.sources.streams import BROKERS
from tallyhouse.sources.transactions import check_transactions, raw_transactions_of
from tallyhouse.streaming.control import SPEED_INTERVAL, with_trigger

# Takes the result's name, the result and the micro-batch number.
ResultSink = Callable[[str, DataFrame, int], None]


def file_results(path: str, file_format: str = "parquet") -> ResultSink:
    """One folder per result and micro-batch; a repeated micro-batch replaces its own folder."""

    def write(name: str, result: DataFrame, batch: int) -> None:
        write_files(result, f"{path}/{name}/batch={batch}", file_format, mode="overwrite")

    return write


def kafka_results(topics: Mapping[str, str] | None = None, brokers: str = BROKERS) -> ResultSink:
    """Each result to its topic. A repeated micro-batch is sent again (at least once)."""

    def write(name: str, result: DataFrame, batch: int) -> None:
        write_kafka(encode_rows(result, (topics or {}).get(name, RESULT_TOPIC)), brokers)

    return write


def each_batch(
    name: str,
    sink: ResultSink,
    options: MetricOptions = MetricOptions(),
    header: dict[str, str] | None = None,
    pivot_year: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch of messages.

    The batch is read from its source once: parsed, numbered and written to the
    shared folder, where two tables take turns. All results come from one pass over that
    table, are written once, by result, and each sink reads its own folder.
    """

    def process(messages: DataFrame, batch: int) -> None:
        checked = check_transactions(raw_transactions_of(messages), header, pivot_year)
        numbered = with_surrogate_id(checked, name="DNI", table=f"{name}-{batch % 2}")
        results = write_through(tagged_results(numbered, options), f"{name}-results-{batch % 2}", by="result")
        for result in RESULT_COLUMNS:
            sink(result, result_of(results, result), batch)

    return process


def speed_job(
    messages: DataFrame,
    checkpoint: str,
    sink: ResultSink,
    name: str = "speed",
    options: MetricOptions = MetricOptions(),
    header: dict[str, str] | None = None,
    pivot_year: int | None = None,
    interval: int | None = SPEED_INTERVAL,
) -> DataStreamWriter:
    """Writer for a stream of message texts in ``value``; call ``start()`` on it.

    ``name`` must differ between queries that run at the same time.
    """
    writer = (
        messages.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each_batch(name, sink, options, header, pivot_year))
    )
    return with_trigger(writer, interval)
