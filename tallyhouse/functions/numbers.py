"""Number parsing and the four-operation calculator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import ColumnLike, as_column

# Operation names, compared without case.
ADD, SUBTRACT, MULTIPLY, DIVIDE = "suma", "resta", "multiplicacion", "division"


# What a text must look like before a cast to the type is tried: reading text
# that cannot be cast costs an exception per row, a pattern does not.
_BLANKS = "[\\x00-\\x20]*"
_WHOLE = f"^{_BLANKS}[+-]?[0-9]+{_BLANKS}\\z"
_FRACTIONAL = f"^{_BLANKS}[+-]?(?:[0-9.][0-9.eE+-]*|[nN][aA][nN]|[iI][nN][fF][a-zA-Z]*){_BLANKS}\\z"
_LOOKS = {
    T.ByteType: _WHOLE,
    T.ShortType: _WHOLE,
    T.IntegerType: _WHOLE,
    T.LongType: _WHOLE,
    T.FloatType: _FRACTIONAL,
    T.DoubleType: _FRACTIONAL,
    T.DecimalType: _FRACTIONAL,
}


def try_parse(text: ColumnLike, data_type: T.DataType) -> Column:
    """The text as a value of the type, null where it is none."""
    text = as_column(text)
    looks = _LOOKS.get(type(data_type))
    if looks is None:
        return text.try_cast(data_type)
    return F.when(text.rlike(looks), text).try_cast(data_type)


def whole_number_or(text: ColumnLike, default: int) -> Column:
    """Integer from plain digits with an optional sign; anything else gives ``default``."""
    text = as_column(text)
    digits = F.when(text.rlike("^[+-]?[0-9]+\\z"), text)
    return F.coalesce(digits.try_cast("int"), F.lit(default))


def calculate(left: ColumnLike, right: ColumnLike, operation: ColumnLike) -> Column:
    """Result of the named operation, 0.0 for an unknown name.

    Dividing by zero gives an infinity with the sign of ``left``, or NaN for 0/0.
    """
    left, right = as_column(left).cast("double"), as_column(right).cast("double")
    name = F.lower(as_column(operation))
    by_zero = (
        F.when(left.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(left) | (left == 0), F.lit(float("nan")))
        .when(left > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return (
        F.when(name == ADD, left + right)
        .when(name == SUBTRACT, left - right)
        .when(name == MULTIPLY, left * right)
        .when(name == DIVIDE, F.when(right == 0, by_zero).otherwise(F.try_divide(left, right)))
        .otherwise(F.lit(0.0))
    )
