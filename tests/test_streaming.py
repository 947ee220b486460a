"""Streams give what the batch gives, also when more events arrive later or a batch is replayed."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from ensemblage.operators import clustering, logs, monitor
from ensemblage.operators.groups import plan_groups
from ensemblage.streaming import progress as streams

SCHEMA = "job_id string, task_idx int, ts timestamp, signal string"


def write(spark, folder, rows):
    start = dt.datetime(2024, 1, 1)
    data = [(j, t, start + dt.timedelta(hours=h), s) for j, t, h, s in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


FIRST = [("a", 1, 0, "started"), ("a", 2, 1, "done_failed"), ("b", 1, 2, "extra.out"), ("a", 1, 3, "done_success")]
LATER = [("a", 2, 4, "started"), ("a", 3, 50, "started"), ("b", 1, 60, "done_success"), ("b", 9, 61, "started")]


def test_states_and_progress_follow_the_stream(spark, tmp_path):
    events, state = str(tmp_path / "events"), str(tmp_path / "state")
    sizes = spark.createDataFrame([("a", 3), ("b", 2)], "job_id string, n_tasks int")
    write(spark, events, FIRST)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(events)
        return {r.job_id: tuple(r)[1:] for r in streams.stream_progress(stream, sizes, state).collect()}

    def batch():
        states = monitor.task_states(spark.read.schema(SCHEMA).parquet(events))
        return {r.job_id: tuple(r)[1:] for r in monitor.progress(states, sizes).collect()}

    assert run() == batch() == {"a": (3, 2, 1, 1, 2, 0, 1), "b": (2, 1, 0, 0, 0, 1, 2)}
    write(spark, events, LATER)
    assert run() == batch() == {"a": (3, 3, 1, 1, 2, 1, 1), "b": (2, 1, 1, 0, 1, 0, 1)}


def test_time_limits_use_event_time(spark, tmp_path):
    events = str(tmp_path / "events")
    write(spark, events, FIRST + LATER)
    sizes = spark.createDataFrame([("a", 3), ("b", 1)], "job_id string, n_tasks int")

    def run(limit):
        stream = spark.readStream.schema(SCHEMA).parquet(events)
        return {r.job_id: r.timed_out for r in streams.stream_timeouts(stream, sizes, limit).collect()}

    assert run(600) == {"a": True, "b": False} and run(0) == {"a": False, "b": False} and run(6000) == {"a": False, "b": False}


def test_windows_count_signals(spark, tmp_path):
    events = str(tmp_path / "events")
    write(spark, events, FIRST + LATER)
    got = streams.stream_windows(spark.readStream.schema(SCHEMA).parquet(events)).collect()
    assert sorted((r.job_id, r.window_start.day, r.signal, r.n) for r in got) == [
        ("a", 1, "done_failed", 1), ("a", 1, "done_success", 1), ("a", 1, "started", 2), ("a", 3, "started", 1),
        ("b", 1, "extra.out", 1), ("b", 3, "done_success", 1), ("b", 3, "started", 1)]


def test_windows_lose_nothing_over_unordered_batches(spark, tmp_path):
    events, folder = str(tmp_path / "events"), str(tmp_path / "state")
    rows = FIRST + LATER
    for start in range(0, len(rows), 2):  # the latest first, each pair in its own run
        write(spark, events, rows[::-1][start : start + 2])
        got = streams.stream_windows(spark.readStream.schema(SCHEMA).parquet(events), folder=folder)
    whole = spark.read.schema(SCHEMA).parquet(events)
    want = whole.groupBy("job_id", F.date_trunc("day", "ts").alias("day"), "signal").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def folder_bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_ten_unordered_batches_equal_the_batch_and_cost_the_same(spark, tmp_path):
    events, folder = str(tmp_path / "events"), str(tmp_path / "state")
    sizes = spark.createDataFrame([(f"j{i}", 4) for i in range(12)], "job_id string, n_tasks int")
    draw = random.Random(4)
    kept, listed = [], []
    for batch in range(10):  # the same jobs and tasks again and again, in any order of time
        write(spark, events, [(f"j{draw.randrange(12)}", draw.randint(1, 5), draw.randrange(500), draw.choice([*monitor.RANKS, "other"])) for _ in range(60)])
        stream = spark.readStream.schema(SCHEMA).parquet(events)
        got = sorted(map(tuple, streams.stream_progress(stream, sizes, folder).collect()))
        whole = spark.read.schema(SCHEMA).parquet(events)
        seen = whole.select("job_id").distinct()
        assert got == sorted(map(tuple, monitor.progress(monitor.task_states(whole), sizes.join(seen, "job_id", "left_semi")).collect()))
        kept.append(folder_bytes(f"{folder}/tasks/rows"))
        listed.append(len(os.listdir(f"{folder}/tasks/lists")))
    assert max(kept[4:]) < 1.5 * kept[3] and max(listed) <= 3  # two generations at most: a batch has no more to read


def test_a_replayed_or_broken_batch_changes_nothing(spark, tmp_path):
    table = streams.task_table(spark, str(tmp_path))
    start = dt.datetime(2024, 1, 1)

    def update(rows):
        return spark.createDataFrame([(j, t, s, start, start + dt.timedelta(hours=t)) for j, t, s in rows],
                                     "job_id string, task_idx int, state int, first_ts timestamp, last_ts timestamp")

    assert table.read() is None
    table.add(update([("a", 1, 1), ("b", 1, 3)]), 0)
    table.add(update([("a", 1, 2), ("a", 2, 1)]), 1)
    once = sorted(map(tuple, table.read().collect()))
    table.add(update([("a", 1, 2), ("a", 2, 1)]), 1)  # replayed
    update([("a", 1, 9)]).write.parquet(f"{tmp_path}/tasks/rows/2/_bucket=0")  # ended before its list was in place
    assert sorted(map(tuple, table.read().collect())) == once and [r[:3] for r in once] == [("a", 1, 2), ("a", 2, 1), ("b", 1, 3)]
    table.add(update([("b", 1, 1)]), 2)
    assert [r[:3] for r in sorted(map(tuple, table.read().collect()))] == [("a", 1, 2), ("a", 2, 1), ("b", 1, 3)]


def test_streams_without_events(spark, tmp_path):
    events = str(tmp_path / "events")
    os.makedirs(events)
    sizes = spark.createDataFrame([("a", 3)], "job_id string, n_tasks int")
    stream = spark.readStream.schema(SCHEMA).parquet(events)
    assert streams.stream_task_states(stream, str(tmp_path / "s1")).count() == 0
    assert streams.stream_progress(stream, sizes, str(tmp_path / "s2")).count() == 0


def test_blocks_of_a_log(spark):
    text = "head\nNucleus A: 1\nx\nNUCLEUS A = 2\r\ny\nz"
    df = spark.createDataFrame([("m", 1, "f", text), ("m", 2, "f", "Nucleus A: 1\nx")], "ensemble_id string, task_idx int, file_name string, content string")
    rows = logs.block_lines(df, r"\bNucleus\s+A\b").orderBy("task_idx", "block", "pos").collect()
    assert [(r.task_idx, r.block, r.line) for r in rows] == [
        (1, 0, "head"), (1, 1, "Nucleus A: 1"), (1, 1, "x"), (1, 2, "NUCLEUS A = 2"), (1, 2, "y"), (1, 2, "z"), (2, 1, "Nucleus A: 1"), (2, 1, "x")]


def test_one_oversized_ensemble_clusters_alike(spark):
    rows = [(0 if i < 60 else i % 4, i, [float(i % 5), float(i % 3)]) for i in range(100)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, features array<double>")
    usual = sorted(map(repr, clustering.kmeans(df, 3, 2).select("ensemble_id", "conf_idx", "label").collect()))
    spark.conf.set("spark.ensemblage.maxGroupRows", "20")
    try:
        assert plan_groups(df, ("ensemble_id",)).oversized is not None
        spread = sorted(map(repr, clustering.kmeans(df, 3, 2).select("ensemble_id", "conf_idx", "label").collect()))
    finally:
        spark.conf.unset("spark.ensemblage.maxGroupRows")
    assert usual == spread
