"""Equi-joins. Skewed sides are split at run time by adaptive execution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_listed(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the lookup list; the planner broadcasts it if its bytes are few."""
    return df.join(lookup.select(key), key, "left_semi")


def drop_listed(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the lookup list."""
    return df.join(lookup.select(key), key, "left_anti")


def pair_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of two keyed tables; repeated keys multiply, as in any inner join.

    ``how`` is ``inner``, ``left`` or ``right``; the side without a match is null.
    Adaptive execution splits a hot key on both sides of an inner join, but only on the
    preserved side of an outer one. Outer joins are therefore the inner join and the
    unmatched rows of the preserved side, found against the other side's distinct keys.
    """
    matched = left.join(right, key)
    if how == "inner":
        return matched
    kept, other = (left, right) if how == "left" else (right, left)
    alone = kept.join(other.select(key).distinct(), key, "left_anti")
    types = dict((field.name, field.dataType) for field in matched.schema)
    return matched.union(
        alone.select(*[F.col(c) if c in kept.columns else F.lit(None).cast(types[c]).alias(c) for c in matched.columns])
    )


def join_nested(left: DataFrame, right: DataFrame, key: str, name: str = "value") -> DataFrame:
    """Inner join with the right side's other columns kept together as one struct."""
    inside = [column for column in right.columns if column != key]
    packed = right.select(key, F.struct(*inside).alias(name))
    return left.join(packed, key)
