"""Repeats in a sliding window, for batch tables and streams alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.panes import stream_window_values, window_values

# Window length and slide.
WINDOW_SIZE = "120 seconds"
WINDOW_SLIDE = "15 seconds"


def _windows(
    rows: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    slide: str,
    values: Mapping[str, tuple[Column, str]],
    at_least: int,
    by_panes: bool,
) -> DataFrame:
    """(start, keys, values): tables by panes, streams by Spark's windows unless panes are asked for."""
    if not rows.isStreaming:
        return window_values(rows, keys, time, size, slide, values, at_least)
    if by_panes:
        return stream_window_values(rows, keys, time, size, slide, values)
    aggregates = [of.alias(name) for name, (of, _) in values.items()]
    windows = rows.groupBy(F.window(time, size, slide), *keys).agg(*aggregates)
    return windows.select(F.col("window.start").alias("start"), *keys, *values)


def window_counts(
    rows: DataFrame,
    keys: list[str],
    time: str = "momento",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    name: str = "count",
    at_least: int = 1,
    by_panes: bool = False,
) -> DataFrame:
    """(start, keys, count) for every sliding window that holds ``at_least`` rows of the keys."""
    counts = _windows(rows, keys, time, size, slide, {name: (F.count(F.lit(1)), "sum")}, at_least, by_panes)
    return counts.where(F.col(name) >= at_least) if at_least > 1 else counts


def suspicious_same_city(
    rows: DataFrame,
    person: str = "DNI",
    city: str = "ciudad",
    time: str = "momento",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    by_panes: bool = False,
) -> DataFrame:
    """Persons with more than one transaction in the same city within a window."""
    return window_counts(rows, [person, city], time, size, slide, at_least=2, by_panes=by_panes)


def suspicious_multi_city(
    rows: DataFrame,
    person: str = "DNI",
    city: str = "ciudad",
    time: str = "momento",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    by_panes: bool = False,
) -> DataFrame:
    """Persons with transactions in more than one city within a window.

    (start, person, count) with ``count`` transactions. Only the first and last city
    name per window and person are kept: they differ exactly when there is more
    than one, so one grouping will do and a stream's state does not grow with the cities.
    """
    values = {"count": (F.count(city), "sum"), "_low": (F.min(city), "min"), "_high": (F.max(city), "max")}
    windows = _windows(rows, [person], time, size, slide, values, 2, by_panes)
    return windows.where(F.col("_low") != F.col("_high")).select("start", person, "count")
