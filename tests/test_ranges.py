"""Ids, groups and folds that follow from values: the same for every layout."""

import datetime
import decimal
import math

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from table_rows import rows

from tallyhouse.operators.grouping import fold_columns, group_values
from tallyhouse.operators.numbering import with_ordered_id
from tallyhouse.operators.ranges import Falling, Ranges
from tallyhouse.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FEW = settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_ordered_ids_for_any_layout(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), F.lit("same").alias("y")).repartition(partitions)
    found = with_ordered_id(df, ["x"])
    assert found.columns == ["x", "y", "id"]
    assert sorted((row.x, row.id) for row in found.collect()) == [(x, x + 1) for x in range(1000)]
    falling = with_ordered_id(df, ["y", Falling("x")], "n", start=0)
    assert sorted((row.n, row.x) for row in falling.collect()) == [(i, 999 - i) for i in range(1000)]


def test_hot_order_key_and_repeated_rows(spark):
    hot = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("x"), "id")
    found = with_ordered_id(hot, ["x"], "n").orderBy("n").collect()
    assert [row.n for row in found] == list(range(1, 3001)) and [row.x for row in found] == sorted(row.x for row in found)
    assert sorted(row.id for row in found) == list(range(3000))
    again = with_ordered_id(hot.repartition(3), ["x"], "n").orderBy("n").collect()
    assert found == again, "ties are ordered by their values"
    # A third of all rows are copies of one row: they get a range of their own and are made from a count.
    copies = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("x"), F.lit("c").alias("c"))
    ranges = Ranges(copies, ["x"])
    assert ranges.same
    sizes = {r["_range"]: r["count"] for r in ranges.assign(copies).groupBy("_range").count().collect()}
    # 1,000 copies and the row whose own id is 7.
    assert [sizes[number] for number in ranges.same if number in sizes] == [1001] and sorted(sizes.values())[-2] < 600
    found = with_ordered_id(copies, ["x"], "n").orderBy("n").collect()
    assert [row.n for row in found] == list(range(1, 3001)) and [row.x for row in found] == sorted(row.x for row in found)


def test_ids_of_empty_and_single_row_tables(spark):
    assert with_ordered_id(spark.range(0), ["id"], "n").collect() == []
    assert [tuple(r) for r in with_ordered_id(spark.range(1), ["id"], "n").collect()] == [(0, 1)]


def test_order_of_every_type(spark):
    base = datetime.datetime(2024, 1, 1)
    made = [
        (None if i % 5 == 0 else i % 3 == 0, base + datetime.timedelta(microseconds=i % 7), base.date() + datetime.timedelta(i % 4),
         [math.nan, -0.0, 1.5, -math.inf, None][i % 5], decimal.Decimal(i % 6) / 4, "aÉ￿𝄞"[i % 4], bytes([i % 3]), [i % 2], {"m": i}, i)
        for i in range(120)
    ]
    schema = "b boolean, t timestamp, d date, f double, e decimal(9,2), s string, y binary, a array<int>, m map<string,int>, i int"
    df = spark.createDataFrame(made, schema).withColumn("z", F.col("t").cast("timestamp_ntz")).repartition(4)
    for keys in (["b", Falling("t"), "i"], [Falling("d"), "f", Falling("i")], [Falling("f"), "e", "i"], ["s", Falling("y"), "i"],
                 [Falling("b"), "z", "i"], ["a", Falling("s"), "i"], [Falling("s"), "a", "i"], [F.col("e") * 2, Falling("i")]):
        order = [F.desc(key.column) if isinstance(key, Falling) else F.col(key) if isinstance(key, str) else key for key in keys]
        expected = [row.i for row in df.orderBy(*order).collect()]
        found = [row.i for row in with_ordered_id(df, keys, "n").orderBy("n").collect()]
        assert found == expected, keys


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.text("ab", max_size=2))), max_size=40))
def test_ids_of_any_rows(spark, pairs):
    df = spark.createDataFrame(pairs, "x int, y string")
    found = with_ordered_id(df, [Falling("x"), "y"], "n", ranges=8).orderBy("n").collect()
    order = sorted(pairs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert [tuple(r) for r in found] == [(*pair, i) for i, pair in enumerate(order, 1)]


@pytest.mark.parametrize("name", ["win_surrogate_id", "srt_by_key", "srt_expr", "srt_two_cols", "srt_city_rows", "srt_desc_count"])
def test_numbering_writes_no_files(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert all(file.startswith(f"file://{SF_DIR}") for file in df.inputFiles()) and "SinglePartition" not in plan
    df.collect()


def expected_pieces(pairs, length):
    out = {}
    for key in {k for k, v in pairs}:
        values = sorted(v for k, v in pairs if k == key and v is not None)
        for start in range(0, len(values), length):
            out[key, start // length] = values[start : start + length]
    return out


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_groups_are_equal_for_every_layout(spark, partitions):
    pairs = [("hot" if i % 3 else f"k{i % 11}" if i % 4 else None, i * 7 % 1000 if i % 5 else 5) for i in range(4000)] + [("none", None)]
    df = spark.createDataFrame(pairs, "k string, v int").repartition(partitions)
    found = {(row.k, row.piece): row.grouped for row in group_values(df, ["k"], "v", length=100).collect()}
    assert found == expected_pieces(pairs, 100)
    assert max(map(len, found.values())) == 100 and sum(key[0] == "hot" for key in found) == 27


def test_a_hot_value_is_cut_into_pieces(spark):
    pairs = [("a", 1)] * 995 + [("a", 2), ("a", 0), ("b", 1)]
    df = spark.createDataFrame(pairs, "k string, v int").repartition(4)
    found = {(row.k, row.piece): row.grouped for row in group_values(df, ["k"], "v", length=10).collect()}
    assert found == expected_pieces(pairs, 10)
    two = df.withColumn("j", F.lit(None).cast("int"))
    assert group_values(two, ["k", "j"], "v", length=10).select("k", "j", "piece", "grouped").count() == len(found)
    assert group_values(df.limit(0), ["k"], "v").collect() == []


def test_column_folds(spark):
    numbers = spark.range(1, 20_001, 1, 5).select(F.when(F.col("id") % 3 != 0, F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    product = fold_columns(numbers, ["k"], "v", lambda a, b: a * b % 1_000_003, length=16)
    expected = {None: 1, 1: 1, 2: 1}
    for i in range(1, 20_001):
        expected[i % 3 or None] = expected[i % 3 or None] * i % 1_000_003
    assert {row.k: row.v for row in product.collect()} == expected
    texts = spark.createDataFrame([("a", "xx"), ("a", None), ("a", "yyy"), ("b", "z"), ("c", None)], "k string, v string")
    longest = fold_columns(texts, ["k"], "v", lambda a, b: F.when(F.length(a) >= F.length(b), a).otherwise(b))
    assert rows(longest) == [("a", "yyy"), ("b", "z")]
    assert fold_columns(numbers.limit(0), ["k"], "v", lambda a, b: F.greatest(a, b)).collect() == []
