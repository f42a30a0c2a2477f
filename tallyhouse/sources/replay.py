"""Replay: draw rows of a table with replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike
from tallyhouse.operators.numbering import with_ordered_id, with_surrogate_id
from tallyhouse.session import write_through

# Fixed value: messages per replay.
REPLAY_MESSAGES = 1000


def replay_sample(
    df: DataFrame,
    n: int = REPLAY_MESSAGES,
    seed: int = 42,
    order_by: Sequence[ColumnLike] = (),
    position: Column | None = None,
) -> DataFrame:
    """``n`` draws from the rows of ``df``, as (draw, row columns).

    Rows are numbered from 0; a draw takes the row at a seeded random position.
    ``position`` replaces the random choice: any integer expression of ``draw``,
    taken modulo the number of rows.
    """
    if order_by:
        indexed = with_ordered_id(df, order_by, name="_position", start=0)
    else:
        indexed = with_surrogate_id(df, name="_position", start=0)
    total = indexed.count()
    if not total:
        return indexed.withColumn("draw", F.lit(None).cast("long")).select("draw", *df.columns)
    return indexed.join(_draws(df.sparkSession, n, seed, position, total), "_position").select("draw", *df.columns)


def _draws(spark: SparkSession, n: int, seed: int, position: Column | None, total: int) -> DataFrame:
    """(draw, _position); from the draw's number, not from where it is made: equal on every layout."""
    drawn = F.xxhash64("draw", F.lit(seed)) if position is None else position
    chosen = F.pmod(drawn, F.lit(total)).cast("long")
    return spark.range(n).withColumnRenamed("id", "draw").withColumn("_position", chosen)


def replay_files(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    n: int = REPLAY_MESSAGES,
    seed: int = 42,
    position: Column | None = None,
) -> DataFrame:
    """As :func:`replay_sample` for parquet files, whose rows are numbered by file name and place in the file.

    Nothing is sorted, copied or moved: rows are counted per file, each draw's position is turned
    into a file and a place in it, and only files that hold a drawn row are read again, in
    the given columns. The draws depend on the files, not on how Spark cuts them into tasks.
    """
    rows = spark.read.parquet(path)
    names = list(columns or rows.columns)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    # One row per file from here on.
    sizes = rows.select(*place).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = write_through(sizes.select("_file", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    total = starts.agg(F.sum("_rows")).first()[0]
    if not total:
        return rows.select(F.lit(None).cast("long").alias("draw"), *names).limit(0)
    draws = _draws(spark, n, seed, position, total)
    # Each draw takes the last file that starts at or before its position.
    marks = starts.where("_rows > 0").select(F.col("_start").alias("_position"), F.lit(None).cast("long").alias("draw"), "_file", "_start")
    both = marks.unionByName(draws, allowMissingColumns=True)
    so_far = Window.orderBy("_position", F.col("draw").asc_nulls_first())  # files and draws only
    found = both.select(
        "draw",
        F.last("_file", ignorenulls=True).over(so_far).alias("_file"),
        (F.col("_position") - F.last("_start", ignorenulls=True).over(so_far)).alias("_row"),
    ).where(F.col("draw").isNotNull())
    located = write_through(found)
    files = [row["_file"] for row in located.select("_file").distinct().collect()]  # at most n
    wanted = rows.where(F.col("_metadata.file_path").isin(files)).select(*names, *place)
    return wanted.join(located, ["_file", "_row"]).select("draw", *names)
