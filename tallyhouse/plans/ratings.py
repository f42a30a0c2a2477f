"""Rating summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.operators.grouping import mean_of_matched


def mean_rating(
    users: DataFrame, ratings: DataFrame, user: str = "usuarioId", rating: str = "nota", digits: int | None = None
) -> DataFrame:
    """Mean rating of each known user that rated something."""
    return mean_of_matched(ratings, users, user, rating, "mean_rating", digits)


def ratings_per_item(
    items: DataFrame,
    ratings: DataFrame,
    item: str = "peliculaId",
    title: str = "pelicula",
    rating: str = "nota",
) -> DataFrame:
    """Every rating with the title it is about."""
    return items.select(item, title).join(ratings.select(item, rating), item)
