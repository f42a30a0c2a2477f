"""File sinks. Appending is the default; ``overwrite`` makes a job repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import row_text

FORMATS = ("csv", "csv.gzip", "json", "parquet", "avro", "orc", "text")


def write_files(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "append") -> None:
    """Write in one of :data:`FORMATS`; ``avro`` needs its package on the class path."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown file format {file_format!r}, known: {', '.join(FORMATS)}")
    if file_format == "text":
        write_text(df, path, mode)
        return
    writer = df.write.mode(mode)
    if file_format == "csv.gzip":
        file_format, writer = "csv", writer.option("compression", "gzip")
    writer.format(file_format).save(path)


def write_text(df: DataFrame, path: str, mode: str = "append", line: Column | None = None) -> None:
    """One line per row: the only column, ``line``, or the ``[v1,v2]`` form of the row."""
    if line is None:
        line = F.col(df.columns[0]).cast("string") if len(df.columns) == 1 else row_text(*df.columns)
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """Sequence file of (key, value) pairs, for readers that need that format."""
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(path)
