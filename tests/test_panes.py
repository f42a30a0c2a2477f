"""Sliding windows by panes against Spark's own windows, in batch and on streams."""

import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from table_rows import rows

from tallyhouse.operators.panes import micros, window_values
from tallyhouse.plans.fraud import suspicious_multi_city, suspicious_same_city, window_counts
from tallyhouse.queries import QUERIES
from tallyhouse.sources.streams import table_stream
from tallyhouse.streaming.fraud import fraud_job, suspicious_stream

SF_DIR = "/root/testdata/sf0.001"


def values():
    return {
        "n": (F.count(F.lit(1)), "sum"),
        "low": (F.min("v"), "min"),
        "high": (F.max("v"), "max"),
        "total": (F.coalesce(F.sum("v"), F.lit(0)), "sum"),
    }


def by_copies(df, keys, time, size, slide):
    grouped = df.groupBy(F.window(time, size, slide), *keys).agg(*[of.alias(name) for name, (of, _) in values().items()])
    return grouped.select(F.col("window.start").alias("start"), *keys, *values())


def test_durations():
    assert micros("2 minutes") == 120 * 10**6 and micros("1 hour 30 seconds") == 3630 * 10**6
    assert micros("250 milliseconds") == 250_000 and micros("1 DAY") == 86400 * 10**6
    for bad in ("", "soon", "2 fortnights", "1 month", "2"):
        with pytest.raises(ValueError):
            micros(bad)


def test_windows_must_not_leave_gaps(spark):
    with pytest.raises(ValueError):
        window_values(spark.range(1), ["id"], "t", "10 seconds", "30 seconds", values())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("size, slide", [
    ("120 seconds", "15 seconds"), ("50 seconds", "20 seconds"), ("10 seconds", "10 seconds"),
    ("1 second", "250 milliseconds"),
])
def test_panes_give_the_windows_of_spark(spark, kind, size, slide):
    made = spark.range(0, 400, 1, 3).select(
        F.expr(f"timestamp_micros(1700000000000000 + id * id * 37 % 900 * 1000000 - 500000 * (id % 3))").cast(kind).alias("t"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, (F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"),
    )
    no_time = made.limit(1).withColumn("t", F.lit(None).cast(kind))
    df = made.union(no_time)
    found = window_values(df, ["k"], "t", size, slide, values())
    expected = by_copies(df, ["k"], "t", size, slide)
    assert found.columns == expected.columns and found.schema["start"].dataType == expected.schema["start"].dataType
    assert rows(found) == rows(expected)
    few = window_values(df, ["k"], "t", size, slide, values(), at_least=3)
    assert rows(few) == rows(expected.where("n >= 3"))


def test_old_and_far_times_and_block_edges(spark):
    # 4096 panes of 15 seconds a block: rows around an edge, before 1970, and far apart.
    edge = 4096 * 15
    moments = [edge + shift for shift in range(-150, 151, 10)] + [-edge - 5, -edge, -1, 0, 10**9]
    df = spark.createDataFrame([(m, m) for m in moments], "s long, v long").select(
        F.timestamp_seconds("s").alias("t"), F.lit("k").alias("k"), "v"
    )
    for size, slide in (("120 seconds", "15 seconds"), ("130 seconds", "15 seconds")):
        assert rows(window_values(df, ["k"], "t", size, slide, values())) == rows(by_copies(df, ["k"], "t", size, slide))


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 300), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3))), max_size=25),
    st.sampled_from([("60 seconds", "15 seconds"), ("45 seconds", "30 seconds")]),
)
def test_panes_of_any_rows(spark, visits, windows):
    df = spark.createDataFrame(visits, "s long, k string, v long").withColumn("t", F.timestamp_seconds("s"))
    assert rows(window_values(df, ["k"], "t", *windows, values())) == rows(by_copies(df, ["k"], "t", *windows))


@pytest.mark.parametrize("name", ["job_suspicious_same_city", "job_suspicious_multi_city", "win_sliding_counts"])
def test_rows_are_not_copied_for_their_windows(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    below = plan[plan.rindex("Aggregate ["):]
    assert "Generate" not in below, "rows reach the panes as they are"


def test_no_rows(spark):
    none = spark.createDataFrame([], "t timestamp, DNI long, ciudad string, momento timestamp")
    assert suspicious_same_city(none).count() == suspicious_multi_city(none).count() == window_counts(none, ["DNI"]).count() == 0


@pytest.mark.parametrize("several", [False, True])
def test_panes_on_a_stream(spark, tmp_path, several):
    start = datetime.datetime(2023, 11, 14, 22, 13, 30)
    visits = [(0, 1, "A"), (30, 1, "A"), (130, 1, "B"), (10, 2, "A"), (20, 2, "C"), (40, 3, None), (41, 3, "A"), (5000, 9, "Z")]
    df = spark.createDataFrame([(start + datetime.timedelta(seconds=s), i, c) for s, i, c in visits], "momento timestamp, DNI long, ciudad string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    last = start + datetime.timedelta(seconds=20000)
    spark.createDataFrame([(last, 10, "Z")], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = table_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    found = suspicious_stream(stream, person="DNI", several_cities=several, by_panes=True)
    for _ in range(2):  # the second run closes what the first one left open
        fraud_job(found, str(tmp_path / "ck"), "parquet", {"path": str(tmp_path / "out")}, interval=None).start().awaitTermination()
    batch = suspicious_multi_city if several else suspicious_same_city
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch(df)) != []
