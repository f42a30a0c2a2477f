"""Incident summaries: totals, most frequent kinds, mean with a default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike, as_column
from tallyhouse.functions.numbers import whole_number_or
from tallyhouse.functions.text import split_trimmed

# Field positions (from 0) in an incident line, and the age of a
# victim whose age is missing or unreadable.
OFFENCE_FIELD = 8
VICTIM_AGE_FIELD = 11
DEFAULT_AGE = 25


def incident_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """(offence, age_text) of comma-separated incident lines; missing fields are null."""
    fields = lines.select(split_trimmed(line, ",").alias("_fields"))  # a line is split once
    return fields.select(
        F.get("_fields", OFFENCE_FIELD).alias("offence"), F.get("_fields", VICTIM_AGE_FIELD).alias("age_text")
    )


def without_header_line(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that differ from the first one."""
    first = lines.first()
    return lines if first is None else lines.where(~F.col(line).eqNullSafe(F.lit(first[line])))


def incident_total(incidents: DataFrame) -> DataFrame:
    return incidents.agg(F.count(F.lit(1)).alias("n"))


def most_frequent(incidents: DataFrame, kind: str = "offence", n: int | None = None) -> DataFrame:
    """Incidents per kind, most frequent first, ties by kind; the first ``n`` if given."""
    ranked = incidents.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), kind)
    return ranked if n is None else ranked.limit(n)


def mean_with_default(
    incidents: DataFrame, number: ColumnLike = "age_text", default: int = DEFAULT_AGE, name: str = "mean_age"
) -> DataFrame:
    """Mean of a text column read as whole numbers, unreadable ones counted as ``default``."""
    return incidents.agg(F.avg(whole_number_or(as_column(number), default)).alias(name))
