"""Value ranges of a table as literals: every job that uses them sees the same ranges.

Bounds come from a bounded sample and only decide how evenly rows are dealt; a row's range
follows from its values alone, whatever partition or job reads it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import ColumnLike, as_column

# Ranges at most, and sampled rows per range; together they bound what reaches the driver.
MOST_RANGES = 4096
_SAMPLED = 32
# Ranges per shuffle partition: they are hashed to partitions, so there must be several.
_PER_PARTITION = 4


@dataclass(frozen=True)
class Falling:
    """Order key sorted from high to low, nulls last."""

    column: ColumnLike


OrderKey = Union[ColumnLike, Falling]


def has_map(kind: T.DataType) -> bool:
    """True for types that have no hash and no order."""
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def _comparable(key: Column, kind: T.DataType) -> Column | None:
    """The key as a type that goes to the driver and back unchanged, in the same order; None if there is none."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), key)
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, T.FloatType):
        return key.cast("double")
    if isinstance(kind, T.BooleanType):
        return key.cast("int")
    simple = (T.IntegralType, T.DoubleType, T.DecimalType, T.BinaryType)
    if isinstance(kind, simple) or kind == T.StringType():
        return key
    return None


class Ranges:
    """Ranges of ``df`` in the order of ``order_by``, ties ordered by a hash of the whole row.

    Keys sort from low to high with nulls first unless :class:`Falling`. Keys of nested types
    end the bounds, not the order. ``count`` is how many ranges to aim at, by default several
    for each shuffle partition. A value so frequent that it fills whole ranges gets one of its
    own, listed in ``same``: its rows agree in all keys and in the hash.

    If the first key is of a nested type there is one range. Takes one job over the keys. Rows must be the same each time ``df`` is read.
    """

    def __init__(self, df: DataFrame, order_by: Sequence[OrderKey], count: int | None = None):
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        count = max(1, min(count or _PER_PARTITION * partitions, MOST_RANGES))
        columns = [as_column(key.column if isinstance(key, Falling) else key) for key in order_by]
        falling = [isinstance(key, Falling) for key in order_by]
        kinds = [field.dataType for field in df.select(*[c.alias(f"k{i}") for i, c in enumerate(columns)]).schema]
        hashed = [F.col(f"`{field.name}`") for field in df.schema if not has_map(field.dataType)]
        tie = F.xxhash64(*hashed)
        self.order = [c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in zip(columns, falling)] + [tie.asc()]
        self._keys = []
        for column, down, kind in [*zip(columns, falling, kinds), (tie, False, T.LongType())]:
            plain = _comparable(column, kind)
            if plain is None:
                break
            self._keys.append((plain, down))
        whole = len(self._keys) == len(columns) + 1 and len(hashed) == len(df.columns)
        self.count, self.same = 1, []
        if self._keys and count > 1:
            self._bound(df, count, whole)

    def _bound(self, df: DataFrame, count: int, whole: bool) -> None:
        keys = df.select(*[key.alias(f"k{i}") for i, (key, _) in enumerate(self._keys)])
        order = [F.desc_nulls_last(n) if down else F.asc_nulls_first(n) for n, (_, down) in zip(keys.columns, self._keys)]
        sample = keys.orderBy(F.rand()).limit(_SAMPLED * count).orderBy(*order).collect()
        picked = [tuple(sample[i * len(sample) // count]) for i in range(1, count)] if sample else []
        # A range starts at its split, or right after it where ``after`` is set.
        splits, after = [], []
        for i, bound in enumerate(picked):
            if i and repr(bound) == repr(picked[i - 1]):
                if whole and not after[-1]:
                    self.same.append(len(splits))
                    splits.append(bound)
                    after.append(True)
            else:
                splits.append(bound)
                after.append(False)
        self.count = len(splits) + 1
        self._after = after
        self._types = [field.dataType for field in keys.schema]
        self._bounds = [[split[i] for split in splits] for i in range(len(self._keys))]

    def assign(self, df: DataFrame, name: str = "_range") -> DataFrame:
        """``df`` with the number of each row's range, found by halving in the literal bounds."""
        if self.count == 1:
            return df.withColumn(name, F.lit(0))
        arrays = [
            F.array(*[F.lit(value) for value in values]).cast(T.ArrayType(kind))
            for values, kind in zip(self._bounds, self._types)
        ]
        after = F.array(*[F.lit(flag) for flag in self._after])
        own = [f"{name}_key{i}" for i in range(len(self._keys))]

        def reached(place: Column) -> Column:
            """True where the row is beyond the split at ``place``, or equal to it if that is enough."""
            result = ~F.get(after, place)
            for (_, down), column, bounds in reversed(list(zip(self._keys, map(F.col, own), arrays))):
                bound = F.get(bounds, place)
                if down:
                    beyond = F.coalesce(column < bound, F.lit(False)) | (column.isNull() & bound.isNotNull())
                else:
                    beyond = F.coalesce(column > bound, F.lit(False)) | (column.isNotNull() & bound.isNull())
                result = beyond | (column.eqNullSafe(bound) & result)
            return result

        def step(found: Column, power: Column) -> Column:
            place = found + power - 1
            return F.when((place < self.count - 1) & reached(place), place + 1).otherwise(found)

        powers = [1 << bit for bit in reversed(range((self.count - 1).bit_length()))]
        # One expression for all steps: steps as columns would multiply in a filter that moves below them.
        search = F.aggregate(F.array(*map(F.lit, powers)), F.lit(0), step)
        keyed = df.select("*", *[key.alias(n) for n, (key, _) in zip(own, self._keys)])
        return keyed.withColumn(name, search).drop(*own)
