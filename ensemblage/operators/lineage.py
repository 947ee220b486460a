"""Runs and the runs they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ensemblage.session import cut_lineage


def upstream_chain(runs: DataFrame) -> DataFrame:
    """Per run: depth, root, and the nearest failed ancestor with its distance.

    ``runs`` has ``run``, ``upstream`` (NULL or unknown for a root) and ``ok``. Pointer doubling: a round
    doubles how far each run has looked, so a chain of length n takes log2(n) joins, and only runs that
    still look are joined. No chain without a loop is longer than the number of runs; runs that look further than
    that are in a loop or behind one: ``in_loop`` is true, and they have no depth and no root.
    """
    runs = runs.select("run", "upstream", "ok")
    rounds = max(runs.count(), 1).bit_length() + 1
    known = runs.select(F.col("run").alias("upstream"), F.col("ok").alias("up_ok"))
    start = runs.join(known, "upstream", "left").select(
        "run",
        F.when(F.col("up_ok").isNotNull(), F.col("upstream")).alias("ahead"),
        F.when(F.col("up_ok").isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
        F.when(~F.col("up_ok"), F.col("upstream")).alias("failed"),
        F.when(~F.col("up_ok"), 1).cast("long").alias("failed_depth"),
        F.when(F.col("up_ok").isNotNull(), F.col("upstream")).otherwise(F.col("run")).alias("root"),
    )
    state = cut_lineage(start, "chain")
    for _ in range(rounds):
        jump = state.select(
            F.col("run").alias("ahead"), F.col("ahead").alias("next"), F.col("depth").alias("more"),
            F.col("failed").alias("next_failed"), F.col("failed_depth").alias("next_failed_depth"), F.col("root").alias("next_root"),
        )
        looking = state.where(F.col("ahead").isNotNull())
        done = state.where(F.col("ahead").isNull())
        if looking.isEmpty():
            break
        moved = looking.join(jump, "ahead").select(
            "run", F.col("next").alias("ahead"), (F.col("depth") + F.col("more")).alias("depth"),
            F.coalesce("failed", "next_failed").alias("failed"),
            F.coalesce(F.col("failed_depth"), F.col("depth") + F.col("next_failed_depth")).alias("failed_depth"),
            F.col("next_root").alias("root"),
        )
        state = cut_lineage(done.unionByName(moved), "chain", replaces=state)
    lost = F.col("ahead").isNotNull()
    return state.select(
        "run", F.when(~lost, F.col("depth")).alias("depth"), "failed", "failed_depth", F.when(~lost, F.col("root")).alias("root"),
        lost.alias("in_loop"),
    )


def hash_drift(recorded: DataFrame, contents: DataFrame) -> DataFrame:
    """Recorded digests against those of the content now; a missing content has no present digest."""
    now = contents.select("path_abs", F.sha2(F.encode("content", "UTF-8"), 256).alias("present"))
    joined = recorded.join(now, "path_abs", "left")
    return joined.withColumn("drifted", F.coalesce(F.col("sha256") != F.col("present"), F.lit(True)))


def duplicate_content(contents: DataFrame) -> DataFrame:
    """Digests that several paths share: how many, and the first path. Copies are counted, never paired."""
    hashed = contents.select("path_abs", F.sha2(F.encode("content", "UTF-8"), 256).alias("sha256"))
    counted = hashed.groupBy("sha256").agg(F.count("*").alias("n_paths"), F.min("path_abs").alias("first_path"))
    return counted.where(F.col("n_paths") > 1)
