"""Views and tables of the Spark catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def publish_view(df: DataFrame, name: str, all_sessions: bool = False) -> str:
    """Register a view and return the name to use in SQL.

    With ``all_sessions`` it is a global view, visible to other sessions of the application.
    """
    if all_sessions:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name


def create_table(spark: SparkSession, name: str, schema: T.StructType, file_format: str = "parquet") -> None:
    """Create the table unless it exists."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {file_format}")


def load_into_table(spark: SparkSession, name: str, path: str, separator: str = ",") -> None:
    """Append the delimited text files under ``path``, fields by position, to the table."""
    schema = spark.table(name).schema
    spark.read.schema(schema).option("sep", separator).csv(path).write.insertInto(name)
