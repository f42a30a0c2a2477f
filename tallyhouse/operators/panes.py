"""Sliding windows merged from panes.

Rows are aggregated once, into panes as long as the step between windows. A window is then
put together from the few panes it covers, and only windows that are asked for are made;
rows themselves are never copied per window.
"""

from __future__ import annotations

import datetime
import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How the values of neighbouring panes are put together.
MERGES = {
    "sum": lambda a, b: a + b,
    "min": F.least,
    "max": F.greatest,
}
_MICROS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
# Panes of one key that are worked on together, at least.
_BLOCK_PANES = 4096


def micros(duration: str) -> int:
    """Microseconds of a text such as ``"2 minutes"`` or ``"1 hour 30 seconds"``."""
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?\b", duration.lower())
    if not parts or re.sub(r"\d+\s+[a-z]+|\s", "", duration.lower()) or any(unit not in _MICROS for _, unit in parts):
        raise ValueError(f"cannot read the duration {duration!r}")
    return sum(int(number) * _MICROS[unit] for number, unit in parts)


def _since_epoch(moment: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a zoned or zone-less timestamp."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), moment)
    return F.unix_micros(moment)


def window_values(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    slide: str,
    values: Mapping[str, tuple[Column, str]],
    at_least: int = 1,
) -> DataFrame:
    """(start, keys, values) of every sliding window with at least ``at_least`` rows of the keys.

    ``values`` gives each result an aggregate over the rows of a pane and the way, of
    :data:`MERGES`, to put panes together: ``{"n": (F.count("x"), "sum")}``. Windows start
    at multiples of ``slide`` since 1970, as those of ``F.window`` do; rows without a time
    are in none.

    A key's panes are worked on in blocks that know the panes next to them, so that a busy
    key over a long time is spread over tasks.
    """
    size_us, slide_us = micros(size), micros(slide)
    if not 0 < slide_us <= size_us:
        raise ValueError(f"windows of {size} cannot start every {slide}")
    pane_us = math.gcd(size_us, slide_us)
    reach, step = size_us // pane_us - 1, slide_us // pane_us
    names = list(values)
    panes = rows.groupBy(F.window(time, f"{pane_us} microseconds").alias("_pane"), *keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[of.alias(name) for name, (of, _) in values.items()]
    )
    moment = F.col("_pane.start")
    kind = panes.select(moment).schema[0].dataType
    number = F.floor(_since_epoch(moment, kind) / pane_us).cast("long")
    numbered = panes.select(*keys, "_rows", *names, moment.alias("_moment"), number.alias("_number"))

    # Each pane stands in its own block, near an edge also in the neighbouring one.
    block = max(_BLOCK_PANES, 2 * size_us // pane_us)
    own, *beside = [F.floor((F.col("_number") + shift) / block) for shift in (0, -reach, reach)]
    within = (beside[0] == own) & (beside[1] == own)
    blocks = F.when(within, F.array(own)).otherwise(F.array_distinct(F.array(own, *beside)))
    placed = numbered.select("*", own.alias("_own"), F.explode(blocks).alias("_block"))
    along = Window.partitionBy(*keys, "_block").orderBy("_number")
    ahead = F.collect_list(F.struct("_number", "_rows", *names)).over(along.rangeBetween(0, reach))
    seen = placed.select(
        "*", F.lag("_number").over(along).alias("_before"), ahead.alias("_ahead")
    ).where(F.col("_block") == F.col("_own"))

    # Windows whose first pane with rows is this one. Their last panes run from ``_last`` on: all
    # of them hold the panes up to that, and those that end later the panes beyond one by one.
    last = F.greatest(F.col("_before") + 1 + reach, F.col("_number"))
    ended = seen.withColumn("_last", last).select(
        *keys, "_moment", "_number", "_last",
        F.filter("_ahead", lambda pane: pane["_number"] <= F.col("_last")).alias("_held"),
        F.filter("_ahead", lambda pane: pane["_number"] > F.col("_last")).alias("_beyond"),
    )

    def put_together(panes: Column, first: Column, name: str, how: str) -> Column:
        merge = MERGES[how]
        return F.aggregate(panes, first, lambda so_far, pane: merge(so_far, pane[name])).alias(name)

    merges = {"_rows": "sum"} if at_least > 1 else {}
    merges |= {name: how for name, (_, how) in values.items()}
    rest = F.slice("_held", F.lit(2), F.greatest(F.size("_held") - 1, F.lit(0)))
    runs = ended.select(
        *keys, "_moment", "_number", "_last", "_beyond",
        *[put_together(rest, F.col("_held")[0][name], name, how) for name, how in merges.items()],
        F.explode(F.sequence(F.lit(0), F.size("_beyond"))).alias("_more"),
    )
    more = F.slice("_beyond", F.lit(1), F.col("_more"))
    first_end = F.coalesce(F.get("_beyond", F.col("_more") - 1)["_number"], F.col("_last"))
    last_end = F.coalesce(F.get("_beyond", F.col("_more"))["_number"] - 1, F.col("_number") + reach)
    merged = runs.select(
        *keys, "_moment", "_number",
        *[put_together(more, F.col(name), name, how) for name, how in merges.items()],
        F.ceil((first_end - reach) / step).cast("long").alias("_from"),
        F.floor((last_end - reach) / step).cast("long").alias("_to"),
    ).where(F.col("_from") <= F.col("_to"))
    if at_least > 1:
        merged = merged.where(F.col("_rows") >= at_least)
    windows = merged.select("*", F.explode(F.sequence("_from", "_to")).alias("_step"))
    back = F.lit(datetime.timedelta(microseconds=pane_us)) * (F.col("_step") * step - F.col("_number"))
    return windows.select((F.col("_moment") + back).alias("start"), *keys, *names)


def stream_window_values(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    slide: str,
    values: Mapping[str, tuple[Column, str]],
) -> DataFrame:
    """:func:`window_values` on a stream with a watermark on ``time``, for append mode.

    The panes are one state, the windows made of closed panes the next one, so a row is
    counted once and only a pane is handed to its windows. A row later than the watermark
    allows is lost with its pane, also for windows that are still open.
    """
    merges = {"sum": F.sum, "min": F.min, "max": F.max}
    pane = f"{math.gcd(micros(size), micros(slide))} microseconds"
    panes = rows.groupBy(F.window(time, pane).alias("_pane"), *keys).agg(*[of.alias(name) for name, (of, _) in values.items()])
    windows = F.window(F.window_time("_pane"), size, slide).alias("_window")
    merged = panes.groupBy(windows, *keys).agg(*[merges[how](name).alias(name) for name, (_, how) in values.items()])
    return merged.select(F.col("_window.start").alias("start"), *keys, *values)
