"""Schemas of the inputs and of the derived tables."""

from pyspark.sql import types as T

# Field names and types that users of the data rely on.
LOCATION = T.StructType([
    T.StructField("latitud", T.DoubleType()),
    T.StructField("longitud", T.DoubleType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("pais", T.StringType()),
])

TRANSACTION = T.StructType([
    T.StructField("DNI", T.LongType()),
    T.StructField("importe", T.DoubleType()),
    T.StructField("descripcion", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("tarjetaCredito", T.StringType()),
    T.StructField("geolocalizacion", LOCATION),
    T.StructField("fecha", T.DateType()),
])

CUSTOMER = T.StructType([
    T.StructField("DNI", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("cuentaCorriente", T.StringType()),
])

USER = T.StructType([
    T.StructField("usuarioId", T.IntegerType()),
    T.StructField("genero", T.StringType()),
    T.StructField("edad", T.IntegerType()),
    T.StructField("ocupacion", T.StringType()),
    T.StructField("codigopostal", T.StringType()),
])

RATING = T.StructType([
    T.StructField("usuarioId", T.IntegerType()),
    T.StructField("peliculaId", T.IntegerType()),
    T.StructField("nota", T.IntegerType()),
    T.StructField("tm", T.LongType()),
])

MOVIE = T.StructType([
    T.StructField("peliculaId", T.IntegerType()),
    T.StructField("pelicula", T.StringType()),
    T.StructField("genero", T.StringType()),
])

PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.LongType()),
])

PERSON_WITH_DEPARTMENT = T.StructType([*PERSON.fields, T.StructField("idDpto", T.LongType())])

DEPARTMENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

# A transaction as it arrives: eleven text fields by position, two of them unused.
RAW_TRANSACTION_FIELDS = [
    "when_text", "unused_1", "amount_text", "card", "name", "city",
    "account", "unused_7", "latitude_text", "longitude_text", "description",
]
MALFORMED = "malformed_line"
RAW_TRANSACTION = T.StructType(
    [T.StructField(field, T.StringType()) for field in [*RAW_TRANSACTION_FIELDS, MALFORMED]]
)
