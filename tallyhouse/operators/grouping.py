"""Grouped results: means after a match, grouped values, user-given folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ranges import Ranges

# Values kept together in one grouped array at most.
PIECE_LENGTH = 100_000
# Keys held by one fold task before it hands its partial results on.
_FOLD_KEYS = 100_000
# First-level groups per key when partial results are merged.
_FOLD_FAN = 64


def mean_of_matched(
    df: DataFrame, reference: DataFrame, key: str, value: str, name: str = "mean", digits: int | None = None
) -> DataFrame:
    """Mean of ``value`` per key, for keys that ``reference`` has.

    Same rows as joining first and averaging after: repeated reference rows do
    not change a mean. Values are combined per key before any row is matched,
    so a hot key reaches the join as one row.
    """
    mean = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    means = df.groupBy(key).agg(mean.alias(name))
    return means.join(reference.select(key), key, "left_semi")


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    piece: Column | None = None,
    length: int = PIECE_LENGTH,
    name: str = "grouped",
) -> DataFrame:
    """(keys, piece, sorted array of values): each group cut into bounded arrays.

    A key's values are ranked from low to high, and piece number p holds those of rank
    ``p * length`` to ``(p + 1) * length - 1``, so pieces are the same for every layout of the
    input. Null values are left out; a null key is a key like any other. Give ``piece`` to cut
    by a column instead; it must then bound the group itself.

    Equal values of a key are counted first. Ranks come from the counts per key and value
    range, and from running counts inside each of them, so a hot key is spread over its ranges
    and a hot value is one row.
    """
    if piece is not None:
        staged = df.select(*keys, value, piece.alias("piece"))
        return staged.groupBy(*keys, "piece").agg(F.sort_array(F.collect_list(value)).alias(name))
    present = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("_key"), F.col(value).alias("_value"))
    runs = present.groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("_key")[key] for key in keys]
    ranges = Ranges(runs, [*order, "_value"])
    placed = ranges.assign(runs)
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and range that meet.
    sizes = placed.groupBy("_key", "_range").agg(F.sum("_n").alias("_rows"))
    offsets = sizes.select("_key", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    below = Window.partitionBy("_key", "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.select("*", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below")).join(
        offsets, ["_key", "_range"]
    ).select("_key", "_value", "_n", (F.col("_before") + F.col("_below")).alias("_rank"))
    # A run of equal values may reach over several pieces.
    pieces = F.sequence(F.floor(F.col("_rank") / length), F.floor((F.col("_rank") + F.col("_n") - 1) / length))
    cut = ranked.select("*", F.explode(pieces).alias("piece"))
    until = F.least(F.col("_rank") + F.col("_n"), (F.col("piece") + 1) * length)
    held = (until - F.greatest(F.col("_rank"), F.col("piece") * length)).cast("int")
    arrays = cut.groupBy("_key", "piece").agg(
        F.sort_array(F.collect_list(F.struct("_value", held.alias("_held")))).alias("_runs")
    )
    values = F.flatten(F.transform("_runs", lambda run: F.array_repeat(run["_value"], run["_held"])))
    return arrays.select(*[F.col("_key")[key].alias(key) for key in keys], "piece", values.alias(name))


def fold_by_key(df: DataFrame, keys: Sequence[str], value: str, merge: Callable) -> DataFrame:
    """Combine each key's values with ``merge``, an associative and commutative function.

    For functions Spark does not have; use ``groupBy(...).agg(...)`` otherwise.
    Every task first combines its own rows. The partial results are then shuffled
    and sorted by key, and each run of equal keys is merged as it streams by; this
    happens once per slice of a key and once per key, so that no task meets more
    than a slice of a hot key's partial results.
    Null values are left out; a null key is a key like any other.
    """
    keys = list(keys)
    columns = [*keys, "_slice", value]
    schema = T.StructType([
        *[df.schema[key] for key in keys], T.StructField("_slice", T.IntegerType()), df.schema[value]
    ])

    # Arrow values: a null key is None, which equals itself, and long keys stay whole.
    def frame(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
        arrays = [pa.array([row[i] for row in rows], kinds.field(i).type) for i in range(len(columns))]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kinds = {}, None
        for batch in batches:
            kinds = batch.schema
            for *key, item in zip(*(column.to_pylist() for column in batch.columns)):
                key = tuple(key)
                held[key] = merge(held[key], item) if key in held else item
            if len(held) >= _FOLD_KEYS:
                yield frame([(*key, total) for key, total in held.items()], kinds)
                held = {}
        if held:
            yield frame([(*key, total) for key, total in held.items()], kinds)

    def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, kinds = None, None, None
        for batch in batches:
            finished, kinds = [], batch.schema
            for *key, item in zip(*(column.to_pylist() for column in batch.columns)):
                if key == current:
                    total = merge(total, item)
                else:
                    if current is not None:
                        finished.append((*current, total))
                    current, total = key, item
            yield frame(finished, kinds)
        if current is not None:
            yield frame([(*current, total)], kinds)

    def merged(partials: DataFrame) -> DataFrame:
        by = [*keys, "_slice"]
        return partials.repartition(*by).sortWithinPartitions(*by).mapInArrow(merge_runs, schema)

    present = df.select(*keys, value).where(F.col(value).isNotNull())
    sliced = present.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(_FOLD_FAN)).cast("int"))
    per_slice = merged(sliced.select(*columns).mapInArrow(combine, schema))
    return merged(per_slice.withColumn("_slice", F.lit(0))).drop("_slice")


def fold_columns(
    df: DataFrame, keys: Sequence[str], value: str, merge: Callable[[Column, Column], Column], length: int = 1024
) -> DataFrame:
    """As :func:`fold_by_key`, with ``merge`` made of columns, so that all work stays in the JVM.

    Values travel once, as arrays of at most ``length`` neighbours, and each array is folded
    into one value. Those are folded again in slices of ``length`` pieces, and a key's slices
    last, so that a hot key is no larger array than its rows divided by the square of ``length``.
    """
    keys = list(keys)
    numbered = df.where(F.col(value).isNotNull()).select(
        *keys, value, F.floor(F.monotonically_increasing_id() / length).alias("_piece")
    )

    def folded(rows: DataFrame, by: list[str]) -> DataFrame:
        arrays = rows.groupBy(*by).agg(F.collect_list(value).alias("_values"))
        rest = F.slice("_values", F.lit(2), F.greatest(F.size("_values") - 1, F.lit(0)))
        return arrays.select(*by, F.aggregate(rest, F.col("_values")[0], merge).alias(value))

    pieces = folded(numbered, [*keys, "_piece"])
    # Neighbouring pieces of different tasks differ in their high bits; hashing deals them evenly.
    tasks = F.floor(F.col("_piece") / length)
    slices = folded(pieces.select(*keys, value, tasks.alias("_slice")), [*keys, "_slice"])
    return folded(slices, keys)


def fold(df: DataFrame, value: str, merge: Callable) -> DataFrame:
    """One row: all values combined with ``merge``, see :func:`fold_by_key`."""
    everything = df.select(F.lit(0).alias("_all"), value)
    return fold_by_key(everything, ["_all"], value, merge).drop("_all")


def counted_while_read(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters that fill as an action runs over it; one pass for both.

    Read them with ``observation.get`` after the action.
    """
    counters = Observation("counters")
    return df.observe(counters, *[F.count_if(test).alias(name) for name, test in conditions.items()]), counters
