"""Spending categories: description to group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import ColumnLike, as_column

# The spending groups, matched exactly (the spelling of
# "car insurace" is that of the data), and the group of everything else.
CATEGORY_GROUPS = {
    "seguros": ["home insurance", "car insurace", "life insurance"],
    "ocio": ["Shopping Mall", "Sports", "Cinema", "Restaurant"],
    "alquiler": ["leasing", "rent"],
}
OTHER_CATEGORY = "otro"


def category_of(
    description: ColumnLike,
    groups: dict[str, list[str]] | None = None,
    default: str = OTHER_CATEGORY,
) -> Column:
    """Category by expression, for short group lists."""
    description = as_column(description)
    chosen = F.lit(default)
    for group, members in reversed((groups or CATEGORY_GROUPS).items()):
        chosen = F.when(description.isin(members), group).otherwise(chosen)
    return chosen


def with_category(
    df: DataFrame,
    description: str = "descripcion",
    name: str = "categoria",
    groups: dict[str, list[str]] | None = None,
    default: str = OTHER_CATEGORY,
) -> DataFrame:
    """Category by a join with the lookup table, for long group lists."""
    entries = [(member, group) for group, members in (groups or CATEGORY_GROUPS).items() for member in members]
    lookup = df.sparkSession.createDataFrame(entries, f"`{description}` string, `{name}` string")
    return df.join(lookup, description, "left").withColumn(name, F.coalesce(F.col(name), F.lit(default)))
