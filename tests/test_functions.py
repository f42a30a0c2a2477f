"""Column expressions on hand-worked values, and against plain Python models."""

import datetime
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.categories import category_of, with_category
from tallyhouse.functions.dates import (
    clock_of,
    date_parts,
    default_pivot_year,
    epoch_seconds,
    is_recent,
    lenient_date,
    strict_date,
)
from tallyhouse.functions.numbers import calculate, try_parse, whole_number_or
from tallyhouse.functions.registered import register_functions
from tallyhouse.functions.text import (
    before_blank,
    drop_first,
    drop_last,
    field_at,
    label,
    lines_of,
    row_text,
    split_trimmed,
    trim_controls,
)

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def over(spark, texts, expression, kind="string"):
    """The expression's value for each text, in order."""
    schema = f"n int, x {kind}"
    found = spark.createDataFrame(list(enumerate(texts)), schema).select("n", expression.alias("y")).collect()
    return [row["y"] for row in sorted(found)]


DATES = {
    "1/2/09 6:17": datetime.date(2009, 2, 1),
    "01/13/09": datetime.date(2010, 1, 1),
    "31/02/2009 x": datetime.date(2009, 3, 3),
    "0/1/09": datetime.date(2008, 12, 31),
    "1/2/68": datetime.date(1968, 2, 1),
    "1/2/45": datetime.date(2045, 2, 1),
    "1/2/46": datetime.date(1946, 2, 1),
    " 5/6/1999": datetime.date(1999, 6, 5),
    "1/0/09": datetime.date(2008, 12, 1),
    "1/1/12345": None,
    "bad": None,
    "": None,
    None: None,
}


def test_lenient_date(spark):
    assert over(spark, DATES, lenient_date("x", pivot_year=46)) == list(DATES.values())
    known = over(spark, DATES, date_parts("x").isNotNull())
    # Digits of a date after the last year are parts, but no date.
    assert all(found or date is None for found, date in zip(known, DATES.values()))


def test_strict_date(spark):
    texts = ["1/2/09 6:17", "01/13/09", "31/02/2009", "29/2/2008", "29/2/2009", "0/1/09", "1/2/68", "bad", None]
    day = datetime.date
    assert over(spark, texts, strict_date("x", pivot_year=46)) == [
        day(2009, 2, 1), None, None, day(2008, 2, 29), None, None, day(1968, 2, 1), None, None
    ]


def test_default_pivot_is_twenty_years_ahead():
    assert default_pivot_year(datetime.date(2026, 5, 1)) == 46
    assert default_pivot_year(datetime.date(1999, 5, 1)) == 19


def model_date(day, month, year_text, pivot):
    year = int(year_text)
    if len(year_text) == 2:
        year += 2000 if year < pivot else 1900
    months = year * 12 + month - 1
    try:
        return datetime.date(months // 12, months % 12 + 1, 1) + datetime.timedelta(days=day - 1)
    except (ValueError, OverflowError):
        return "outside"


@FEW
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 40), st.integers(0, 99)), min_size=1, max_size=60))
def test_lenient_date_model(spark, parts):
    texts = [f"{day}/{month}/{year:02d} 1:00" for day, month, year in parts]
    expected = [model_date(day, month, f"{year:02d}", 46) for day, month, year in parts]
    assert over(spark, texts, lenient_date("x", pivot_year=46)) == expected


def test_clock(spark):
    texts = ["1/2/09 6:17", "1/2/09 23:59:58", "1/2/09", "1/2/09 noon"]
    moments = over(spark, texts, F.date_format(F.lit(datetime.date(2009, 2, 1)).cast("timestamp") + clock_of("x"), "HH:mm:ss"))
    assert moments == ["06:17:00", "23:59:58", None, None]


def test_long_digits_and_unreadable_clocks(spark):
    texts = ["000001/2/09", "1/2/20091", "1/" + "9" * 30 + "/09", "100000/1/2009", "1/2/" + "9" * 12]
    found = over(spark, texts, lenient_date("x", pivot_year=46))
    assert found == [datetime.date(2009, 2, 1), None, None, datetime.date(2282, 10, 16), None]
    clocks = ["1/2/09 6:177", "1/2/09 123:45", "1/2/09 25:00", "1/2/09 0:00"]
    assert over(spark, clocks, clock_of("x").isNull()) == [True, True, True, False]


def test_recent(spark):
    as_of = datetime.date(2009, 2, 10)
    dates = [datetime.date(2009, 2, 1), datetime.date(2009, 1, 13), datetime.date(2009, 1, 11), datetime.date(2009, 1, 12),
             datetime.date(2010, 1, 1), None]
    assert over(spark, dates, is_recent("x", as_of), "date") == [True, True, False, True, True, None]
    assert over(spark, dates, is_recent("x", as_of, exclude_future=True), "date")[4] is False
    today = datetime.date.today()
    assert over(spark, [today, today - datetime.timedelta(days=40)], is_recent("x"), "date") == [True, False]


def test_epoch_seconds_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS x").select(epoch_seconds("x")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == 1710037800


SPLITS = {"a b  ": ["a", "b"], "": [""], "   ": [], " x": ["", "x"], "a  b": ["a", "", "b"], None: None}


def test_split_trimmed(spark):
    assert over(spark, SPLITS, split_trimmed("x")) == list(SPLITS.values())


def test_split_trimmed_separators(spark):
    assert over(spark, ["1::2::", "::", "1:2", ""], split_trimmed("x", "::")) == [["1", "2"], [], ["1:2"], [""]]
    assert over(spark, ["a|b||", "a.b"], split_trimmed("x", "|")) == [["a", "b"], ["a.b"]]
    assert over(spark, ["a||b", "a.b.."], split_trimmed("x", ".")) == [["a||b"], ["a", "b"]]
    assert over(spark, ["a.*b", ".*", "ab"], split_trimmed("x", ".*")) == [["a", "b"], [], ["ab"]]


def model_split(text):
    if text == "":
        return [""]
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@FEW
@given(st.lists(st.text(alphabet="ab \t\n", max_size=12), min_size=1, max_size=60))
def test_split_model(spark, texts):
    assert over(spark, texts, split_trimmed("x")) == [model_split(text) for text in texts]


def model_lines(text):
    lines = re.split("\r\n|\r|\n", text)
    return lines[:-1] if lines[-1] == "" else lines


@FEW
@given(st.lists(st.text(alphabet="ab \r\n", max_size=12), min_size=1, max_size=60))
def test_lines_model(spark, texts):
    found = over(spark, texts, F.coalesce(lines_of("x"), F.array().cast("array<string>")))
    assert found == [model_lines(text) for text in texts]


def test_text_expressions(spark):
    assert over(spark, ["abc]", "", None, "a"], drop_last("x")) == ["abc", "", None, ""]
    assert over(spark, ["[abc", "", None], drop_first("x")) == ["abc", "", None]
    assert over(spark, ["1/2/09 6:17", "one", ""], before_blank("x")) == ["1/2/09", "one", ""]
    assert over(spark, ["\t a b \r\n", "\x00x", " ", None], trim_controls("x")) == ["a b", "x", "", None]
    assert over(spark, ["ann", None], label("Name: ", "x")) == ["Name: ann", "Name: null"]
    assert over(spark, ["a", None], row_text("x", F.lit(1))) == ["[a,1]", "[null,1]"]
    assert over(spark, ["a,b,c", "a", "a,,"], field_at("x", 1)) == ["b", None, None]


def test_ages(spark):
    texts = ["30", "+7", "-3", " 30", "", " ", "x", "99999999999", None, "3.5", "30\n"]
    assert over(spark, texts, whole_number_or("x", 25)) == [30, 7, -3, 25, 25, 25, 25, 25, 25, 25, 25]


def test_try_parse_is_the_cast_where_there_is_one(spark):
    texts = ["1", " 2 ", "+3", "-4.5", "1e3", ".5", "5.", "NaN", "Infinity", "-inf", "x", "", " ", "1-2", "1x", "--1", None]
    for kind in (T.IntegerType(), T.LongType(), T.DoubleType(), T.DecimalType(10, 2)):
        found = over(spark, texts, try_parse("x", kind))
        expected = over(spark, texts, F.col("x").try_cast(kind))
        assert str(found) == str(expected), kind


def test_strict_cast_fails(spark):
    with pytest.raises(PySparkException):
        over(spark, ["x"], F.col("x").cast("int"))


def test_calculator(spark):
    cases = [
        (5.0, 3.45, "SUMA", 8.45), (5.0, 3.0, "resta", 2.0), (5.0, 3.0, "Multiplicacion", 15.0),
        (6.0, 3.0, "division", 2.0), (5.0, 3.45, "raiz", 0.0), (1.0, 0.0, "division", math.inf),
        (-1.0, 0.0, "division", -math.inf), (1.0, -0.0, "division", math.inf), (None, 0.0, "division", None),
    ]
    df = spark.createDataFrame([(n, *case[:3]) for n, case in enumerate(cases)], "n int, a double, b double, op string")
    found = [row["y"] for row in sorted(df.select("n", calculate("a", "b", "op").alias("y")).collect())]
    assert found == [case[3] for case in cases]
    undefined = spark.createDataFrame([(0.0, 0.0, "division")], "a double, b double, op string")
    assert math.isnan(undefined.select(calculate("a", "b", "op")).first()[0])


def test_categories(spark):
    texts = ["life insurance", "car insurace", "car insurance", "Cinema", "cinema", "rent", "", None]
    expected = ["seguros", "seguros", "otro", "ocio", "otro", "alquiler", "otro", "otro"]
    assert over(spark, texts, category_of("x")) == expected
    df = spark.createDataFrame([(text,) for text in texts], "descripcion string")
    joined = {row["descripcion"]: row["categoria"] for row in with_category(df).collect()}
    assert joined == dict(zip(texts, expected))


def test_registered_functions(spark):
    register_functions(spark)
    found = spark.sql("SELECT clean('abc]'), clean(''), clean(null), strLen('abc'), strLen('')").first()
    assert tuple(found) == ("abc", "", None, 3, 0)
    assert spark.sql("SELECT strLen(x) FROM VALUES ('ab'), (null) t(x) ORDER BY x NULLS LAST").collect()[1][0] is None
