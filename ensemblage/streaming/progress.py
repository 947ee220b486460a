"""Task states and progress over a stream of task events; each stream gives what the batch gives.

The stream itself keeps no state: each micro-batch is reduced to one row per task and merged into a bucketed table
(``snapshots``), which has the highest state and the first and last event of each task. Order of events and replays of
batches make no difference, and a batch reads the buckets of its own jobs only, however many batches came before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.operators import monitor
from ensemblage.session import scratch_path
from ensemblage.streaming.snapshots import BucketedTable


def _run(frame: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is available and stop."""
    query = frame.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(work).start()
    query.awaitTermination()


def _append(folder: str) -> Callable[[DataFrame, int], None]:
    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return work


def _merged_tasks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("job_id", "task_idx").agg(F.max("state").alias("state"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def task_table(spark: SparkSession, folder: str) -> BucketedTable:
    """job_id, task_idx, state, first_ts, last_ts: one row per task, a job's tasks in one bucket."""
    return BucketedTable(spark, f"{folder}/tasks", "job_id", _merged_tasks)


def _as_updates(batch: DataFrame) -> DataFrame:
    state = F.max(monitor.signal_rank(F.col("signal"))).alias("state")
    return batch.groupBy("job_id", "task_idx").agg(state, F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def update_tasks(events: DataFrame, folder: str, then: Callable[[DataFrame, int], None] | None = None) -> BucketedTable:
    """Merge what is there into the tasks; ``then`` gets the rows of the buckets that a batch touched and its number."""
    table = task_table(events.sparkSession, folder)

    def work(batch: DataFrame, batch_id: int) -> None:
        touched = table.add(_as_updates(batch), batch_id)
        if then:
            then(touched, batch_id)

    _run(events, work, f"{folder}/_tasks")
    if table.read() is None:  # nothing has come yet: an empty table, of batch -1
        schema = "job_id {}, task_idx {}, state int, first_ts timestamp, last_ts timestamp".format(
            *[events.schema[c].dataType.simpleString() for c in ("job_id", "task_idx")])
        table.empty = events.sparkSession.createDataFrame([], schema)
    return table


def _tasks(table: BucketedTable) -> DataFrame:
    found = table.read()
    return table.empty if found is None else found


def stream_task_states(events: DataFrame, folder: str | None = None) -> DataFrame:
    """Run the stream over what is there and return the latest state per task."""
    spark = events.sparkSession
    return _tasks(update_tasks(events, folder or scratch_path(spark, "states"))).select("job_id", "task_idx", "state")


def stream_progress(events: DataFrame, sizes: DataFrame, folder: str | None = None) -> DataFrame:
    """The latest progress of each job that sent an event, kept up to date batch by batch for the jobs of its buckets."""
    spark = events.sparkSession
    folder = folder or scratch_path(spark, "progress")
    latest = BucketedTable(spark, f"{folder}/jobs", "job_id", lambda rows: rows.groupBy("job_id").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c != "job_id"]), "batch").alias("s")).select("job_id", "s.*"))

    def work(touched: DataFrame, batch_id: int) -> None:
        jobs = touched.select("job_id").distinct()
        counts = monitor.progress(touched.select("job_id", "task_idx", "state"), sizes.join(jobs, "job_id", "left_semi"))
        latest.add(counts.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)

    table = update_tasks(events, folder, work)
    found = latest.read()
    if found is None:
        return monitor.progress(_tasks(table), sizes.limit(0))
    return found.drop("batch")


def stream_timeouts(events: DataFrame, sizes: DataFrame, limit_minutes: int, folder: str | None = None) -> DataFrame:
    """Jobs with tasks left past the limit, by event time: the latest event stands for the clock.

    One stream and one row per task are read, never the events of earlier batches.
    """
    spark = events.sparkSession
    tasks = _tasks(update_tasks(events, folder or scratch_path(spark, "timeouts")))
    span = tasks.groupBy("job_id").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    clock = span.agg(F.max("last_ts")).first()[0]  # one value
    counts = monitor.progress(tasks.select("job_id", "task_idx", "state"), sizes)
    return monitor.timeouts(span, counts, F.lit(clock), limit_minutes)


def stream_windows(events: DataFrame, width: str = "1 day", folder: str | None = None) -> DataFrame:
    """Signals per job and time window. Each batch writes its own counts, which are summed when read.

    No event comes too late and no state is kept; a replayed batch overwrites its counts.
    """
    spark = events.sparkSession
    folder = folder or scratch_path(spark, "windows")

    def work(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy("job_id", F.window("ts", width).alias("w"), "signal").agg(F.count("*").alias("n"))
        _append(f"{folder}/windows")(counted.select("job_id", F.col("w.start").alias("window_start"), "signal", "n"), batch_id)

    _run(events, work, f"{folder}/_windows")
    return spark.read.parquet(f"{folder}/windows").groupBy("job_id", "window_start", "signal").agg(F.sum("n").alias("n"))
