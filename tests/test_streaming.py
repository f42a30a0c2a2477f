"""Streaming jobs: same results as batch, restarts, late data, pass-through, sums."""

import datetime

import pytest
from pyspark.sql import functions as F
from table_rows import rows
from test_transactions import HEADER, LINES, OPTIONS, messages

from tallyhouse.operators.numbering import with_surrogate_id
from tallyhouse.plans.fraud import suspicious_multi_city, suspicious_same_city, window_counts
from tallyhouse.plans.transactions import RESULT_COLUMNS, result_of, speed_metrics, tagged_results, wide_from_rows
from tallyhouse.session import write_through
from tallyhouse.sources.streams import (
    Admission,
    constant_rate_stream,
    kafka_source_options,
    line_stream,
    measured_speed,
    table_stream,
    with_arrival_time,
)
from tallyhouse.sources.transactions import accepted, check_transactions, header_of, raw_transactions_of
from tallyhouse.streaming.control import run_for, to_console
from tallyhouse.streaming.fraud import fraud_job, suspicious_stream, transactions_of
from tallyhouse.streaming.relay import batch_sums, relay_job
from tallyhouse.streaming.speed import file_results, speed_job

START = 1700000010
VISITS = [(0, 1, "A"), (30, 1, "A"), (130, 1, "B"), (10, 2, "A"), (20, 2, "C")]


def visits(spark, seconds=VISITS):
    schema = "t long, DNI long, ciudad string"
    return spark.createDataFrame(seconds, schema).select(
        F.timestamp_seconds(F.col("t") + START).alias("momento"), "DNI", "ciudad"
    )


def offsets(found):
    """(start seconds after START, person) of suspicious windows."""
    return sorted((row.start.replace(tzinfo=datetime.timezone.utc).timestamp() - START, row.DNI) for row in found)


SAME = [(-75 + 15 * i, 1) for i in range(6)]
SEVERAL = sorted([(15, 1), (30, 1)] + [(-90 + 15 * i, 2) for i in range(7)])


def test_suspicious_windows_in_batch(spark):
    same = suspicious_same_city(visits(spark)).collect()
    assert offsets(same) == SAME and {row.ciudad for row in same} == {"A"}
    several = suspicious_multi_city(visits(spark))
    assert offsets(several.collect()) == SEVERAL
    assert {row["count"] for row in several.where("DNI = 2").collect()} == {2}


def test_window_longer_than_its_slide_multiple(spark):
    """A window length that is no multiple of the slide."""
    counts = window_counts(visits(spark), ["DNI"], size="50 seconds", slide="20 seconds")
    expected = {}
    for t, person, _ in VISITS:
        for start in range(-60 - START % 20, 200, 20):
            if start <= t < start + 50:
                expected[start, person] = expected.get((start, person), 0) + 1
    found = {
        (row.start.replace(tzinfo=datetime.timezone.utc).timestamp() - START, row.DNI): row["count"]
        for row in counts.collect()
    }
    assert found == expected


@pytest.mark.parametrize("several", [False, True])
def test_suspicious_windows_on_a_stream(spark, tmp_path, several):
    """Append mode gives the batch result once a later row has moved the watermark on."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for seconds in (VISITS[:2] + VISITS[3:], VISITS[2:3], [(100_000, 9, "Z")]):
        visits(spark, seconds).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    # All rows in one batch, then the late one: file order does not matter here.
    stream = suspicious_stream(table_stream(spark, source, schema), person="DNI", several_cities=several)
    fraud_job(stream, str(tmp_path / "ck"), "parquet", {"path": out}, interval=None).start().awaitTermination()
    found = spark.read.parquet(out)
    assert offsets(found.collect()) == (SEVERAL if several else SAME)
    batch = suspicious_multi_city if several else suspicious_same_city
    assert rows(found) == rows(batch(visits(spark)).select(*found.columns))


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "ck"))
    visits(spark, [(0, 1, "A"), (5_000, 7, "A")]).coalesce(1).write.mode("append").parquet(source)

    def go():
        stream = suspicious_stream(table_stream(spark, source, visits(spark).schema), person="DNI")
        fraud_job(stream, checkpoint, "parquet", {"path": out}, interval=None).start().awaitTermination()

    go()
    visits(spark, [(10, 1, "A"), (5_001, 7, "A"), (100_000, 9, "Z")]).coalesce(1).write.mode("append").parquet(source)
    go()
    assert {row.DNI for row in spark.read.parquet(out).collect()} == {7}


def test_suspicious_messages_end_to_end(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "01/02/09 6:{},P,12,Visa,ana,{},{},u,51.5,-1.1,Cinema"
    lines = [line.format("17", "London", "C1"), line.format("18", "London", "C1"), line.format("18", "Rome", "C2"),
             "oops", line.format("59", "Paris", "C3")]
    (folder / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    stream = transactions_of(line_stream(spark, str(folder)), header_of(HEADER), 46)
    job = fraud_job(suspicious_stream(stream), str(tmp_path / "ck"), "parquet", {"path": str(tmp_path / "out")}, interval=None)
    job.start().awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(found) == 4 and {(row.cuentaCorriente, row.ciudad, row["count"]) for row in found} == {("C1", "London", 2)}


def test_arrival_time_windows(spark, tmp_path):
    visits(spark).drop("momento").coalesce(1).write.parquet(str(tmp_path / "in"))
    source = table_stream(spark, str(tmp_path / "in"), visits(spark).drop("momento").schema)
    stream = suspicious_stream(with_arrival_time(source), person="DNI", time="arrival")
    query = fraud_job(stream, str(tmp_path / "ck"), "memory", mode="complete", interval=None)
    query.queryName("arrivals").start().awaitTermination()
    found = spark.table("arrivals").collect()
    assert len(found) == 8 and {(row.DNI, row.ciudad) for row in found} == {(1, "A")}


def speed_results(spark, out):
    names = ["city_counts", "high_payments", "city_rows", "category_rows", "recent_rows", "card_means", "rejects"]
    return {name: spark.read.parquet(f"{out}/{name}") for name in names}


def test_speed_job_gives_the_batch_metrics_per_micro_batch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "1.csv").write_text("\n".join(LINES) + "\n")

    def go():
        speed_job(
            line_stream(spark, str(folder), files_per_batch=1), str(tmp_path / "ck"), file_results(out), "speed_test",
            OPTIONS, header_of(HEADER), 46, interval=None,
        ).start().awaitTermination()

    go()
    found = speed_results(spark, out)
    checked = check_transactions(raw_transactions_of(messages(spark)), header_of(HEADER), 46)
    wide = wide_from_rows(accepted(with_surrogate_id(checked, name="DNI")))
    for name, expected in speed_metrics(wide, OPTIONS).items():
        kept = [column for column in expected.columns if column != "DNI"]
        assert rows(found[name].select(*kept)) == rows(expected.select(*kept)), name
    assert rows(found["rejects"].select("line", "reason")) == [("bad line", "field count")]
    # Restarted from its checkpoint with one more file: only that file is new.
    (folder / "2.csv").write_text(LINES[1] + "\n")
    go()
    again = speed_results(spark, out)["city_counts"]
    assert rows(again.select("batch", "ciudad", "NumTransacciones")) == [
        (0, "London", 2), (0, "Madrid", 1), (0, "Paris", 1), (1, "London", 1)
    ]


def test_a_repeated_micro_batch_replaces_its_results(spark, tmp_path):
    write = file_results(str(tmp_path / "out"))
    for _ in range(2):
        write("m", spark.range(3), 5)
    assert spark.read.parquet(str(tmp_path / "out/m")).count() == 3


def test_relay_loses_and_repeats_nothing_over_a_restart(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for part in range(3):
        (folder / f"{part}.txt").write_text("".join(f"{part}-{i}\n" for i in range(50)))
        job = relay_job(line_stream(spark, str(folder), 1), str(tmp_path / "ck"), "text", {"path": out}, interval=None)
        job.start().awaitTermination()
    values = [row.value for row in spark.read.text(out).collect()]
    assert sorted(values) == sorted(f"{part}-{i}" for part in range(3) for i in range(50))


def test_sum_of_every_micro_batch(spark, tmp_path):
    totals = []
    stream = constant_rate_stream(spark, rows_per_batch=2000, below=2000, partitions=2)
    counted = batch_sums(
        stream, str(tmp_path / "ck"), lambda total, batch: totals.append((batch, total.first().total)), interval=1
    ).start()
    assert run_for(counted, 8) is False and not counted.isActive
    batches = [batch for batch, _ in totals]
    assert batches == list(range(len(batches))) and len(batches) >= 2
    assert all(0 < total < 2000 * 2000 for _, total in totals) and len({total for _, total in totals}) > 1


def test_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello\n")
    query = to_console(line_stream(spark, str(tmp_path / "in")), str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert run_for(query, 60) is True
    assert sum(progress.numInputRows for progress in query.recentProgress) == 1


def test_all_results_of_a_micro_batch_come_from_one_scan(spark, tmp_path):
    checked = check_transactions(raw_transactions_of(messages(spark)), header_of(HEADER), 46)
    with_surrogate_id(checked, name="DNI").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = tagged_results(table, OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    twice = table.union(table)
    results = write_through(tagged_results(twice, OPTIONS), by="result")
    assert set(RESULT_COLUMNS) == {row["result"] for row in results.select("result").distinct().collect()}
    for name, expected in speed_metrics(wide_from_rows(accepted(twice)), OPTIONS).items():
        assert rows(result_of(results, name)) == rows(expected), name
    assert rows(result_of(results, "rejects")) == [("bad line", "field count")] * 2
    plan = result_of(results, "city_rows")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(result" in plan, "a sink reads its own folder"


def test_a_backlog_is_taken_in_bounded_micro_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(12):
        (folder / f"{part:02}.txt").write_text("".join(f"{part}-{i}\n" for i in range(50)))
    admission = Admission(rows_per_second=100, interval=2, headroom=0.25)
    assert admission.rows() == 150 and admission.files(50) == 3 and admission.files(10**9) == 1
    sizes, values = [], []

    def take(batch, number):
        found = [row.value for row in batch.collect()]
        sizes.append(len(found))
        values.extend(found)

    stream = line_stream(spark, str(folder), admission.files(50))
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(take)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert sizes == [150] * 4 and sorted(values) == sorted(f"{p}-{i}" for p in range(12) for i in range(50))
    assert measured_speed(query) > 0
    options = kafka_source_options("t", admission=Admission(50_000, 15))
    assert options["maxOffsetsPerTrigger"] == "525000" and options["minPartitions"] == "6"
    assert "maxOffsetsPerTrigger" not in kafka_source_options("t")
