"""Task states, progress of array jobs, accounting failures and time limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.operators.groups import plan_groups

# A task that succeeded counts as such whatever else it signalled; any other signal shows that it started.
RANKS = {"done_success": 3, "done_failed": 2, "started": 1}


def signal_rank(signal: Column) -> Column:
    rank = F.lit(0)
    for name, value in RANKS.items():
        rank = F.when(signal == name, value).otherwise(rank)
    return rank


def task_states(events: DataFrame) -> DataFrame:
    """The highest state each task reached; the order of events does not matter."""
    return events.groupBy("job_id", "task_idx").agg(F.max(signal_rank(F.col("signal"))).alias("state"))


def progress(states: DataFrame, sizes: DataFrame) -> DataFrame:
    """Counts per job out of its declared number of tasks."""
    task = F.col("task_idx").between(1, F.col("n_tasks"))
    sized = plan_groups(states, ("job_id",)).apply(states, lambda d, g: g.attach(d, sizes))
    counted = sized.where(task).groupBy("job_id").agg(
        F.count("*").alias("started"),
        F.count_if(F.col("state") == 3).alias("success"),
        F.count_if(F.col("state") == 2).alias("failed"),
    )
    joined = sizes.join(counted, "job_id", "left").fillna(0, ["started", "success", "failed"])
    processed = F.col("success") + F.col("failed")
    return joined.select(
        "job_id", F.col("n_tasks").alias("total"), "started", "success", "failed",
        processed.alias("processed"),
        F.greatest(F.col("started") - processed, F.lit(0)).alias("in_progress"),
        F.greatest(F.col("n_tasks") - processed, F.lit(0)).alias("left"),
    )


def accounting_failures(roster: DataFrame, states: DataFrame) -> DataFrame:
    """Tasks whose accounting row is not a clean completion; a task without a row says nothing."""
    keyed = roster.withColumn("job_id_raw", F.concat_ws("_", "job_id", "task_idx"))
    joined = keyed.join(states.select("job_id_raw", "state", "exit_code"), "job_id_raw")
    clean = F.upper("state").startswith("COMPLETED") & F.col("exit_code").startswith("0:0")
    failed = joined.where(~F.coalesce(clean, F.lit(False)))
    return failed.select("job_id", "task_idx", "state", "exit_code", F.lit("array_task_not_completed").alias("error"))


def spans(events: DataFrame) -> DataFrame:
    return events.groupBy("job_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def timeouts(span: DataFrame, counts: DataFrame, now: Column, limit_minutes: int) -> DataFrame:
    """Jobs with tasks left after the limit; a limit of zero or less never times out."""
    joined = span.join(counts, "job_id")
    if limit_minutes <= 0:
        return joined.withColumn("timed_out", F.lit(False)).select("job_id", "left", "timed_out")
    over = now > F.col("first_ts") + F.make_interval(mins=F.lit(limit_minutes))
    return joined.select("job_id", "left", (over & (F.col("left") > 0)).alias("timed_out"))


def failures_by_code(failures: DataFrame) -> DataFrame:
    """Failures per step and code, with the totals per step and over all."""
    return failures.rollup("step", "error").agg(F.count("*").alias("n"))
