"""File sources. Every reader takes a schema; none infers one unless asked to."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import ColumnLike, as_column
from tallyhouse.functions.numbers import try_parse
from tallyhouse.functions.text import split_trimmed, trim_controls
from tallyhouse.schemas import MALFORMED
from tallyhouse.session import write_through


def with_malformed(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that keeps a line which does not fit it."""
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = ",", header: bool = False
) -> DataFrame:
    """Typed table from delimited text; the separator may have several characters.

    A line that does not fit keeps its good fields, has nulls for the others,
    and is kept whole in the ``malformed_line`` column.
    """
    return (
        spark.read.schema(with_malformed(schema))
        .option("sep", separator)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text table from comma-separated files without a header rule."""
    return read_delimited(spark, path, T.StructType([T.StructField(name, T.StringType()) for name in columns]))


def drop_header(df: DataFrame, header: dict[str, str]) -> DataFrame:
    """Rows that differ from the header in some column, wherever the header occurs."""
    is_header = F.lit(True)
    for column, shown in header.items():
        is_header = is_header & F.col(column).eqNullSafe(F.lit(shown))
    return df.where(~is_header)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One ``value`` per text line."""
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. Without a schema the files are read once more to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


# Types that a schema of variants names and a table cannot have: no value at all, and values of several types.
_UNTABLED = re.compile(r"\b(?:VOID|VARIANT)\b(?=[,>]|\Z)")


def read_json_once(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines whose schema is found while the files are read once.

    Each line is parsed into a variant and written to the shared folder; the schema is gathered
    from the variants there (or given), and the columns are cast from them. A field whose
    values are of several types, or always null, is text. A line that is no JSON object
    has nulls and is kept whole in the ``malformed_line`` column.
    """
    parsed = read_lines(spark, path).select("value", F.try_parse_json("value").alias("_json"))
    is_object = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    held = write_through(
        parsed.where(F.trim("value") != "").select(
            F.when(is_object, F.col("_json")).alias("_json"), F.when(~is_object, F.col("value")).alias(MALFORMED)
        )
    )
    if schema is None:
        gathered = held.where(F.col("_json").isNotNull()).agg(F.schema_of_variant_agg("_json")).first()[0] or ""
        if not gathered.startswith("OBJECT<") or gathered == "OBJECT<>":
            return held.select(MALFORMED)
        kind = _UNTABLED.sub("STRING", re.sub(r"\bOBJECT<", "STRUCT<", gathered)).replace("STRUCT<>", "STRING")
        schema = T.StructType.fromDDL(kind)
    # Field by field, so that a value that does not fit a given type is null by itself.
    return held.select(*[
        F.try_variant_get("_json", _member(field.name), field.dataType.simpleString()).alias(field.name)
        for field in schema.fields
    ], MALFORMED)


def _member(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def query_files(spark: SparkSession, file_format: str, path: str) -> DataFrame:
    """All rows of files addressed directly from SQL."""
    return spark.sql(f"SELECT * FROM {file_format}.`{path}`")


def typed_fields(
    df: DataFrame, text: ColumnLike, schema: T.StructType, separator: str = ",", strict: bool = False
) -> DataFrame:
    """The fields of a delimited text column as trimmed, typed columns.

    Text that is not of the type gives null, or fails the job when ``strict``.
    """
    # Two steps, so that a line is split once and a field trimmed once.
    split = df.select(split_trimmed(as_column(text), separator).alias("_parts"))
    trimmed = split.select(*[
        trim_controls(F.get("_parts", position)).alias(f"_part{position}") for position in range(len(schema.fields))
    ])
    columns = []
    for position, field in enumerate(schema.fields):
        part = F.col(f"_part{position}")
        cast = part.cast(field.dataType) if strict else try_parse(part, field.dataType)
        columns.append(cast.alias(field.name))
    return trimmed.select(*columns)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, in its order and types."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])
