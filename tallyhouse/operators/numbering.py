"""Row numbers without a single-task sort, and first rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike, as_column
from tallyhouse.operators.ranges import OrderKey, Ranges
from tallyhouse.session import write_through

# monotonically_increasing_id keeps the partition above this many low bits.
_POSITION_BITS = 33
# Copies of one row that are made in one go.
_COPIES = 100_000


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing, not consecutive ids; no shuffle and no extra job."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_surrogate_id(
    df: DataFrame,
    order_by: Sequence[ColumnLike] = (),
    name: str = "id",
    start: int = 1,
    table: str | None = None,
) -> DataFrame:
    """Consecutive ids ``start, start + 1, ...``, one per row.

    With ``order_by`` ids follow that order (rows that tie keep their input
    order), otherwise the partition order. The rows are range-sorted across
    partitions and written once to the shared folder, so that the partition
    sizes counted and the rows numbered are the same rows; the only table sent
    to every executor has one entry per partition. ``table`` is the written
    table's name, see :func:`tallyhouse.session.write_through`.
    """
    if order_by:
        keys = [as_column(key) for key in order_by]
        laid_out = (
            df.withColumn("_arrival", F.monotonically_increasing_id())
            .orderBy(*keys, "_arrival")
            .drop("_arrival")
        )
    else:
        laid_out = df
    written = write_through(laid_out.withColumn("_place", F.monotonically_increasing_id()), table)
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the written table.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .select(*df.columns, name)
    )


def with_ordered_id(
    df: DataFrame, order_by: Sequence[OrderKey], name: str = "id", start: int = 1, ranges: int | None = None
) -> DataFrame:
    """Consecutive ids ``start, start + 1, ...`` in the given order, without a written copy.

    Rows are dealt into value ranges, counted per range, and numbered inside their range from
    the count of the rows before it. Rows that tie in ``order_by`` are in an order that follows from
    their values, so ids do not depend on the layout and a lost executor cannot change one.
    Rows that agree in all columns and fill whole ranges are counted, and made again from the count.

    Takes two jobs, over the keys and over the ranges; ``df`` must give the same rows each
    time it is read (write a random or costly one through first).
    """
    found = Ranges(df, order_by, ranges)
    placed = found.assign(df)
    # One row per range.
    sizes = {row["_range"]: row["count"] for row in placed.groupBy("_range").count().collect()}
    offsets = [start]
    for number in range(found.count - 1):
        offsets.append(offsets[-1] + sizes.get(number, 0))
    offset = F.get(F.array(*[F.lit(value).cast("long") for value in offsets]), F.col("_range"))
    usual = 2 * sum(sizes.values()) / found.count
    repeated = [number for number in found.same if sizes.get(number, 0) > usual]
    inside = Window.partitionBy("_range").orderBy(*found.order)
    alone = placed.where(~F.col("_range").isin(repeated)) if repeated else placed
    numbered = alone.select(*df.columns, (offset + F.row_number().over(inside) - 1).alias(name))
    if not repeated:
        return numbered
    copies = placed.where(F.col("_range").isin(repeated)).groupBy("_range", *df.columns).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_range").orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    first = (offset + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_first")
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _COPIES))).alias("_chunk")
    spread = copies.select("*", first).select("*", chunks).repartition("_range", "_chunk")
    until = F.least(F.col("_n"), (F.col("_chunk") + 1) * _COPIES) - 1
    made = spread.select(*df.columns, "_first", F.explode(F.sequence(F.col("_chunk") * _COPIES, until)).alias("_copy"))
    return numbered.union(made.select(*df.columns, F.col("_first") + F.col("_copy")))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnLike], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    The row limit is applied inside every input task before the shuffle, so a
    hot key sends at most ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[as_column(key) for key in order_by]))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def largest(df: DataFrame, n: int, *values: str) -> DataFrame:
    """The ``n`` rows with the largest values: a heap per task, no full sort."""
    return df.orderBy(*[F.desc(value) for value in values]).limit(n)


def smallest(df: DataFrame, n: int, *values: ColumnLike) -> DataFrame:
    """The ``n`` rows with the smallest values: a heap per task, no full sort."""
    return df.orderBy(*[as_column(value) for value in values]).limit(n)


def descending(*values: str) -> list[Column]:
    return [F.desc(value) for value in values]
