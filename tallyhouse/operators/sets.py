"""Bag and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike
from tallyhouse.operators.numbering import first_per_key


def union_bag(left: DataFrame, right: DataFrame, by_name: bool = False) -> DataFrame:
    """All rows of both, repeats kept; columns matched by position or by name."""
    return left.unionByName(right) if by_name else left.union(right)


def intersect_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both, once each; nulls match nulls.

    One grouping of both sides marks where each row occurs, so rows travel once
    and repeats are folded inside the input tasks; the built-in form matches all
    rows first and removes repeats after.
    """
    sided = left.withColumn("_side", F.lit(1)).union(right.withColumn("_side", F.lit(2)))
    seen = sided.groupBy(*left.columns).agg(F.bit_or("_side").alias("_sides"))
    return seen.where(F.col("_sides") == 3).drop("_sides")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnLike]) -> DataFrame:
    """One row per key: the first in the given order, the same one in every run."""
    return first_per_key(df, keys, order_by)


def text_digest(text: str):
    """Fixed-length stand-in for a long text in groupings, so whole texts need not travel."""
    return F.sha2(F.col(text), 256)
