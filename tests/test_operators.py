"""Relational operators on small literal tables with results worked out by hand."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from table_rows import rows

from tallyhouse.operators.grouping import counted_while_read, fold, fold_by_key, group_values, mean_of_matched
from tallyhouse.operators.joins import drop_listed, join_nested, keep_listed, pair_join
from tallyhouse.operators.numbering import first_per_key, largest, smallest, with_row_id, with_surrogate_id
from tallyhouse.operators.sets import distinct_rows, drop_duplicates, intersect_rows, union_bag
from tallyhouse.sources.replay import replay_sample

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
# A key repeated on both sides, one on each side alone, a repeated row, null keys.
PAIRS = [("north", 3), ("south", 8), ("north", 5), (None, 1), ("east", 9), ("south", 8)]
OTHERS = [("south", 20), ("north", 30), ("south", 21), ("west", 40), (None, 50)]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "k string, v int")


@pytest.fixture(scope="module")
def others(spark):
    return spark.createDataFrame(OTHERS, "k string, w int")


def test_numbers_one_to_hundred(spark):
    numbers = spark.range(1, 101).withColumnRenamed("id", "n").repartition(4)
    assert numbers.count() == 100
    assert [row.n for row in largest(numbers, 5, "n").collect()] == [100, 99, 98, 97, 96]
    assert [row.n for row in smallest(numbers, 5, "n").collect()] == [1, 2, 3, 4, 5]
    assert numbers.where("n % 2 = 0").count() == 50
    assert spark.range(10000).agg(F.sum("id")).first()[0] == 49_995_000


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_surrogate_ids_are_consecutive_and_ordered(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(partitions)
    numbered = with_surrogate_id(df, ["x"])
    assert numbered.columns == ["x", "id"]
    assert sorted((row.x, row.id) for row in numbered.collect()) == [(x, x + 1) for x in range(1000)]
    unordered = [row.id for row in with_surrogate_id(df, start=0).collect()]
    assert sorted(unordered) == list(range(1000))


def test_surrogate_ids_with_a_hot_order_key(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("x"), "id")
    found = with_surrogate_id(df, ["x"], name="n").orderBy("n").collect()
    assert [row.n for row in found] == list(range(1, 3001))
    assert [row.x for row in found] == sorted(row.x for row in found)
    hot = [row.id for row in found if row.x == 7 and row.id % 3 == 0]
    assert hot == sorted(hot), "ties keep their input order"


def test_surrogate_ids_of_an_empty_table(spark):
    assert with_surrogate_id(spark.range(0).withColumnRenamed("id", "x"), ["x"]).collect() == []


def test_row_ids_are_unique(spark):
    assert with_row_id(spark.range(0, 100, 1, 7)).select("row_id").distinct().count() == 100


def test_first_per_key(spark, pairs):
    assert rows(first_per_key(pairs, ["k"], [F.desc("v")])) == [("east", 9), ("north", 5), ("south", 8), (None, 1)]
    two = [("east", 9), ("north", 3), ("north", 5), ("south", 8), ("south", 8), (None, 1)]
    assert rows(first_per_key(pairs, ["k"], ["v"], n=2)) == two


def test_pair_joins(pairs, others):
    inner = rows(pair_join(pairs, others, "k"))
    south = [("south", 8, 20), ("south", 8, 20), ("south", 8, 21), ("south", 8, 21)]
    assert inner == [("north", 3, 30), ("north", 5, 30), *south]
    left = rows(pair_join(others, pairs, "k", "left"))
    assert len(left) == 8 and [row for row in left if row[2] is None] == [("west", 40, None), (None, 50, None)]
    right = rows(pair_join(pairs, others, "k", "right"))
    assert len(right) == 8 and [row for row in right if row[1] is None] == [("west", None, 40), (None, None, 50)]


def test_nested_join(spark):
    users = spark.createDataFrame([(10, "Ada"), (20, "Bo"), (30, "Cy"), (None, "Di")], "id int, name string")
    accounts = spark.createDataFrame(
        [(30, "z", 9), (20, "x", 5), (20, "y", 7), (99, "q", 1), (None, "n", 2)], "id int, account string, salary int"
    )
    found = join_nested(users, accounts, "id")
    assert rows(found.select("id", "name", "value.account", "value.salary")) == [
        (20, "Bo", "x", 5), (20, "Bo", "y", 7), (30, "Cy", "z", 9)
    ]


def test_lookup_lists(spark, pairs):
    listed = spark.createDataFrame([("north",), ("nowhere",)], "k string")
    assert rows(keep_listed(pairs, listed, "k")) == [("north", 3), ("north", 5)]
    assert len(rows(drop_listed(pairs, listed, "k"))) == 4


def test_keyed_sums_and_groups(spark, pairs):
    assert rows(pairs.groupBy("k").agg(F.sum("v"))) == [("east", 9), ("north", 8), ("south", 16), (None, 1)]
    keyed = spark.createDataFrame([("u", 4), ("v", 6), ("u", 2)], "k string, v int")
    assert rows(group_values(keyed, ["k"], "v").select("k", "grouped")) == [("u", [2, 4]), ("v", [6])]


def test_grouped_values_are_whole_and_bounded(spark):
    hot = spark.range(0, 5000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    pieces = group_values(hot, ["k"], "id", length=100).collect()
    assert max(len(row.grouped) for row in pieces) <= 100
    held = sorted(value for row in pieces for value in row.grouped)
    assert held == list(range(5000))
    by_column = group_values(hot, ["k"], "id", piece=F.floor(F.col("id") / 50)).collect()
    assert max(len(row.grouped) for row in by_column) <= 50
    assert sorted(value for row in by_column for value in row.grouped) == list(range(5000))


def test_folds(spark):
    numbers = spark.range(1, 201, 1, 5).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    by_key = fold_by_key(numbers, ["k"], "v", lambda a, b: math.gcd(int(a), int(b)))
    assert rows(by_key) == [(0, 3), (1, 1), (2, 1)]
    assert rows(fold(numbers, "v", max)) == [(200,)]
    texts = spark.createDataFrame([("a", "xx"), ("a", None), ("a", "yyy"), ("b", "z")], "k string, v string")
    longest = fold_by_key(texts, ["k"], "v", lambda a, b: a if len(a) >= len(b) else b)
    assert rows(longest) == [("a", "yyy"), ("b", "z")]
    assert fold(numbers.where("v < 0"), "v", max).collect() == []


def test_mean_of_matched_is_the_mean_after_a_join(spark):
    ratings = spark.createDataFrame([(1, 4), (1, 5), (2, 1), (3, 3), (None, 9)], "u int, r int")
    users = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "u int")
    joined = ratings.join(users, "u").groupBy("u").agg(F.avg("r"))
    assert rows(mean_of_matched(ratings, users, "u", "r")) == rows(joined) == [(1, 4.5), (2, 1.0)]


def test_counters(spark):
    observed, counters = counted_while_read(spark.range(100), even=F.col("id") % 2 == 0, large=F.col("id") > 89)
    assert observed.count() == 100
    assert counters.get == {"even": 50, "large": 10}


def test_sets(spark):
    a, b = spark.range(0, 101), spark.range(0, 1001, 10)
    assert [row.id for row in intersect_rows(a, b).orderBy("id").collect()] == list(range(0, 101, 10))
    assert union_bag(a, b).count() == 202
    letters = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert rows(distinct_rows(letters)) == [("a",), ("b",), (None,)]
    assert rows(intersect_rows(letters, letters)) == [("a",), ("b",), (None,)]
    ab = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(union_bag(ab, ab.select("b", "a"), by_name=True)) == [(1, 2), (1, 2)]
    assert rows(union_bag(ab, ab.select("b", "a"))) == [(1, 2), (2, 1)]


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20), st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20))
def test_set_laws(spark, left, right):
    a = spark.createDataFrame([(x,) for x in left], "x int")
    b = spark.createDataFrame([(x,) for x in right], "x int")
    assert {row.x for row in intersect_rows(a, b).collect()} == set(left) & set(right)
    assert intersect_rows(a, b).count() == len(set(left) & set(right))
    assert union_bag(a, b).count() == len(left) + len(right)


def test_drop_duplicates_keeps_the_first(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "id int, t string")
    assert rows(drop_duplicates(df, ["t"], ["id"])) == [(1, "x"), (2, "y")]


def test_fold_groups_null_keys(spark):
    numbers = spark.createDataFrame([(None, 1), (None, 2), (2**60 + 1, 5), (2**60, 7)], "k long, v long").repartition(4)
    assert rows(fold_by_key(numbers, ["k"], "v", lambda a, b: a + b)) == [(2**60, 7), (2**60 + 1, 5), (None, 3)]


def test_replay(spark):
    df = spark.range(0, 50, 1, 3).select(F.col("id").alias("x"))
    drawn = replay_sample(df, n=200, seed=1)
    assert drawn.count() == 200
    assert {row.x for row in drawn.collect()} <= set(range(50))
    assert rows(replay_sample(df, n=200, seed=1, order_by=["x"])) == rows(replay_sample(df, n=200, seed=1, order_by=["x"]))
    fixed = replay_sample(df, n=100, order_by=["x"], position=F.col("draw") * 7)
    assert rows(fixed) == sorted([(i, i * 7 % 50) for i in range(100)], key=lambda row: tuple(map(str, row)))
    assert replay_sample(df.where("x < 0"), n=5).collect() == []
