"""Logs and multi-frame files larger than a row: read by byte ranges, one file by many tasks.

Spark's text source cuts a file into splits at line borders. A line is known by its file, its split's first byte and its
place in the split. Line numbers are prefix sums in two levels: over the counts of a file's splits (one short row per
split), and inside a split, whose rows come in order. Blocks between header lines are numbered in the same way. Lines
are neither shuffled nor sorted for that.

Frames of a geometry file say how long they are in their first line. Only lines that may be such a one are brought together
per file, in order, and walked through one at a time; the lines then meet the frames that they are in by ranges.

Differences to whole files in one row: lines end at line feeds (a carriage return before one is dropped), and there is no
empty line behind the last line feed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ensemblage.session import cut_lineage

#: Splits up to which their table is broadcast; beyond it lines meet it by a shuffle.
MOST_SPLITS = 100_000
#: Lines of a bucket in which lines meet frames.
BUCKET = 256

SPLIT = ["path", "split_start"]


def _lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", "\r$", "").alias("line"))


def _with_splits(lines: DataFrame, splits: DataFrame) -> DataFrame:
    few = splits.limit(MOST_SPLITS + 1).count() <= MOST_SPLITS
    return lines.join(F.broadcast(splits) if few else splits, SPLIT)


def numbered_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, line_no (from 0) and line of all files below ``path``, whose names match ``pattern``."""
    lines = _lines(spark, path, pattern)
    counts = cut_lineage(lines.groupBy(*SPLIT).agg(F.min("row").alias("first_row"), F.count("*").alias("n_lines")), "splits")
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = counts.select(*SPLIT, "first_row", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("lines_before"))
    return _with_splits(lines, splits).select("path", (F.col("lines_before") + F.col("row") - F.col("first_row")).alias("line_no"), "line")


def block_lines(spark: SparkSession, path: str, header: str, pattern: str | None = None) -> DataFrame:
    """path, line_no, block (how many header lines there are up to the line), pos (lines since the header) and line.

    ``header`` is a pattern without flags; case does not matter. Block 0 is what stands before the first header.
    """
    lines = _lines(spark, path, pattern)
    lines = lines.withColumn("is_header", F.col("line").rlike("(?i)" + header))
    own = F.when(F.col("is_header"), F.col("row"))
    counts = cut_lineage(lines.groupBy(*SPLIT).agg(
        F.min("row").alias("first_row"), F.count("*").alias("n_lines"), F.count(own).alias("n_headers"), F.max(own).alias("last_header")), "splits")
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("lines_before", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    last = F.col("lines_before") + F.col("last_header") - F.col("first_row")
    splits = counts.withColumn("last", last).select(
        *SPLIT, "first_row", "lines_before", F.coalesce(F.sum("n_headers").over(before), F.lit(0)).alias("headers_before"),
        F.coalesce(F.max("last").over(before), F.lit(0)).alias("header_before"))
    placed = _with_splits(lines, splits).select(
        *SPLIT, (F.col("lines_before") + F.col("row") - F.col("first_row")).alias("line_no"), "headers_before", "header_before", "is_header", "line")
    return placed.mapInArrow(_count_headers, "path string, line_no bigint, block bigint, pos bigint, line string")


def _count_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a split come one after the other, in order; of each, the headers since its start are counted."""
    split, block, header = None, 0, 0
    for batch in batches:
        blocks, places = [], []
        rows = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
        for path, start, line_no, headers_before, header_before, is_header in rows:
            if (path, start) != split:
                split, block, header = (path, start), headers_before, header_before
            if is_header:
                block, header = block + 1, line_no
            blocks.append(block)
            places.append(line_no - header)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.string()), batch.column(2), pa.array(blocks, pa.int64()), pa.array(places, pa.int64()), batch.column(6).cast(pa.string())],
            names=["path", "line_no", "block", "pos", "line"])


def _borders(lines: DataFrame) -> DataFrame:
    """path, line_no, count, blank_from: lines that may begin a frame, and from where on only blank lines stand before each."""
    blank = F.trim("line") == ""
    head = F.regexp_extract("line", r"^\s*(\d{1,9})\s*$", 1)
    # the last line that isn't blank before each: inside buckets of lines in order, and over the buckets before
    bucket = F.floor(F.col("line_no") / BUCKET)
    narrow = lines.select("path", "line_no", bucket.alias("bucket"), F.when(head != "", head.cast("int")).alias("count"), (~blank).alias("filled"))
    narrow = narrow.where("filled")
    last = cut_lineage(narrow.groupBy("path", "bucket").agg(F.max("line_no").alias("last")), "buckets")
    before = Window.partitionBy("path").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = last.select("path", "bucket", F.max("last").over(before).alias("last_before"))
    inside = Window.partitionBy("path", "bucket").orderBy("line_no")
    lagged = narrow.withColumn("previous", F.lag("line_no").over(inside)).where("count > 0").join(last, ["path", "bucket"])
    return lagged.select("path", "line_no", "count", (F.coalesce("previous", "last_before", F.lit(-1)) + 1).alias("blank_from"))


def frame_starts(lines: DataFrame) -> DataFrame:
    """path, frame_no (from 1), first_line, n_atoms of ``numbered_lines`` of geometry files.

    A malformed or truncated frame ends its file, and the frames before it stay.
    """
    borders = _borders(lines)
    ends = lines.groupBy("path").agg((F.max("line_no") + 1).alias("n_lines"))
    sorted_rows = borders.join(ends, "path").repartition("path").sortWithinPartitions("path", "line_no")
    schema = pa.schema([("path", pa.string()), ("frame_no", pa.int32()), ("first_line", pa.int64()), ("n_atoms", pa.int32())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, at, number = None, 0, 0
        for batch in batches:
            found: list[tuple[Any, ...]] = []
            for name, line_no, count, blank_from, n_lines in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if name != path:
                    path, at, number = name, 0, 0
                if at is None or line_no < at:
                    continue  # the file has ended, or a line inside a frame that looks like a first one
                if blank_from > at or line_no + 2 + count > n_lines:
                    at = None
                    continue
                number += 1
                found.append((name, number, line_no, count))
                at = line_no + 2 + count
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    wanted = sorted_rows.select("path", "line_no", "count", "blank_from", "n_lines")
    return wanted.mapInArrow(walk, "path string, frame_no int, first_line bigint, n_atoms int")


def frame_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, frame_no, n_atoms, atom_index (-1 for the comment) and line of all frames below ``path``."""
    lines = numbered_lines(spark, path, pattern)
    frames = cut_lineage(frame_starts(lines), "frames")
    last = F.col("first_line") + 1 + F.col("n_atoms")
    spread = frames.select("*", F.explode(F.sequence(F.floor((F.col("first_line") + 1) / BUCKET), F.floor(last / BUCKET))).alias("bucket"))
    met = lines.withColumn("bucket", F.floor(F.col("line_no") / BUCKET)).join(spread, ["path", "bucket"])
    return met.where((F.col("line_no") > F.col("first_line")) & (F.col("line_no") <= last)).select(
        "path", "frame_no", "n_atoms", (F.col("line_no") - F.col("first_line") - 2).cast("int").alias("atom_index"), "line")
