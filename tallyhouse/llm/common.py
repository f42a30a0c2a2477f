"""Helpers of the operators: row-wise Arrow work and words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}
# Rows turned into Python objects at a time; a batch of long texts is not held twice.
_SLICE = 512


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of ``"name type, name type"`` with the few types used here."""
    fields = [field.strip().split(" ", 1) for field in ddl.split(", ")]
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])


def map_rows(df: DataFrame, inputs: Sequence[str], compute: Callable[..., tuple], ddl: str) -> DataFrame:
    """One output row ``compute(*inputs)`` for each row; other columns are not read."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                columns = [column.to_pylist() for column in batch.slice(start, _SLICE).columns]
                rows = [compute(*values) for values in zip(*columns)]
                arrays = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.select(*inputs).mapInArrow(run, ddl)


def replace_columns(df: DataFrame, compute: Callable[[dict], dict], inputs: Sequence[str]) -> DataFrame:
    """The rows of ``df`` with the columns that ``compute`` returns put in place of the old ones.

    ``compute`` gets and returns lists by column name. Types and all other columns stay.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                piece = batch.slice(start, _SLICE)
                made = compute({name: piece.column(names.index(name)).to_pylist() for name in inputs})
                arrays = [
                    pa.array(made[name], piece.schema.field(i).type) if name in made else piece.column(i)
                    for i, name in enumerate(names)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, df.schema)


def freed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, giving free memory back to the system at the end of the task.

    Workers live on between the tasks and stages of an executor, with all they ever took.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # in the C library of Linux
        if trim:
            trim(0)

    return whole


def filter_rows(df: DataFrame, keep: Callable[..., bool], inputs: Sequence[str]) -> DataFrame:
    """The rows for which ``keep(*inputs)`` is true, with all their columns."""
    places = [df.columns.index(name) for name in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                piece = batch.slice(start, _SLICE)
                columns = [piece.column(place).to_pylist() for place in places]
                yield piece.filter(pa.array([keep(*values) for values in zip(*columns)], pa.bool_()))

    return df.mapInArrow(freed(run), df.schema)


def byte_words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, as UTF-8."""
    return text.encode().split() if text else []
