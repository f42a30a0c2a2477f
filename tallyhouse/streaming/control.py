"""Starting and stopping queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Seconds between micro-batches of the jobs, and of a timed run.
SPEED_INTERVAL = 15
CONSTANT_INTERVAL = 2
RELAY_INTERVAL = 1
TIMED_RUN = 40


def with_trigger(writer: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """A micro-batch every ``seconds``, or everything at hand and then stop if None."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def run_for(query: StreamingQuery, seconds: float = TIMED_RUN) -> bool:
    """Wait until the query ends or the time is up, then stop it. True if it ended by itself."""
    ended = bool(query.awaitTermination(timeout=seconds))
    if not ended:
        query.stop()
    return ended


def to_console(stream: DataFrame, checkpoint: str, mode: str = "append", rows: int = 20) -> DataStreamWriter:
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )
