"""Stream sources: Kafka topics, folders of files, paced row generators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# The default broker, topics and pacing of the speed jobs.
BROKERS = "localhost:9092"
TRANSACTION_TOPIC = "transacciones"
MESSAGE_TOPIC = "mensajes"
CONSTANT_ROWS_PER_BATCH = 2000
CONSTANT_VALUES_BELOW = 2000


@dataclass(frozen=True)
class Admission:
    """How much of a backlog a micro-batch may take, from what the job gets done in an interval.

    ``rows_per_second`` is the measured speed of the whole job (see :func:`measured_speed`),
    ``interval`` its trigger in seconds. ``headroom`` of the interval is kept free, so that a
    job that was down catches up in bounded micro-batches instead of one that holds all.
    """

    rows_per_second: float
    interval: float
    headroom: float = 0.3

    def rows(self) -> int:
        """Rows that one micro-batch may take, at least one."""
        return max(1, int(self.rows_per_second * self.interval * (1 - self.headroom)))

    def files(self, rows_per_file: float) -> int:
        return max(1, int(self.rows() / max(1.0, rows_per_file)))

    def kafka_options(self, rows_per_task: int = 100_000) -> dict[str, str]:
        """Offsets per micro-batch, and enough tasks that none takes many more than ``rows_per_task``."""
        return {
            "maxOffsetsPerTrigger": str(self.rows()),
            "minPartitions": str(max(1, -(-self.rows() // rows_per_task))),
        }


def measured_speed(query: StreamingQuery) -> float | None:
    """Rows per second that a query's recent micro-batches got done, None before the first with rows."""
    done = [progress for progress in query.recentProgress if progress.numInputRows]
    seconds = sum(progress.durationMs["triggerExecution"] for progress in done) / 1000
    return sum(progress.numInputRows for progress in done) / seconds if seconds else None


def kafka_source_options(
    topic: str, brokers: str = BROKERS, starting: str = "latest", admission: Admission | None = None
) -> dict[str, str]:
    """Reader options. Offsets live in each query's checkpoint, not in a consumer group."""
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting}
    return {**options, **(admission.kafka_options() if admission else {})}


def message_values(records: DataFrame, arrival: str | None = None) -> DataFrame:
    """The text value of each record, with its arrival time if a name for it is given."""
    columns = [F.col("value").cast("string").alias("value")]
    if arrival:
        columns.append(F.col("timestamp").alias(arrival))
    return records.select(*columns)


def kafka_stream(
    spark: SparkSession,
    topic: str,
    brokers: str = BROKERS,
    starting: str = "latest",
    arrival: str | None = None,
    admission: Admission | None = None,
) -> DataFrame:
    """Text values of a topic. Needs the Kafka connector on the class path."""
    options = kafka_source_options(topic, brokers, starting, admission)
    return message_values(spark.readStream.format("kafka").options(**options).load(), arrival)


def line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text lines of files as they appear under ``path``, as ``value``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of parquet files as they appear under ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_arrival_time(stream: DataFrame, name: str = "arrival") -> DataFrame:
    """Stamp rows with the time of the micro-batch that read them."""
    return stream.withColumn(name, F.current_timestamp())


def constant_rate_stream(
    spark: SparkSession,
    rows_per_batch: int = CONSTANT_ROWS_PER_BATCH,
    below: int = CONSTANT_VALUES_BELOW,
    partitions: int | None = None,
) -> DataFrame:
    """The same number of rows in every micro-batch, each with an integer in [0, below)."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load().select(
        F.col("timestamp"), F.pmod(F.xxhash64("value"), F.lit(below)).cast("int").alias("value")
    )


def random_integers(spark: SparkSession, rows: int, below: int = CONSTANT_VALUES_BELOW, seed: int = 42) -> DataFrame:
    """``rows`` seeded random integers in [0, below)."""
    return spark.range(rows).select(F.floor(F.rand(seed) * below).cast("int").alias("value"))
