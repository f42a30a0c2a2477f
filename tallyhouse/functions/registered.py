"""Functions callable by name from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_functions(spark: SparkSession) -> None:
    """Register ``clean`` and ``strLen``.

    ``clean`` drops the last character, ``strLen`` counts characters. Both are SQL
    functions, which the optimizer inlines.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clean(x STRING) RETURNS STRING "
        "RETURN left(x, greatest(length(x) - 1, 0))"
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION strLen(x STRING) RETURNS BIGINT RETURN length(x)")
