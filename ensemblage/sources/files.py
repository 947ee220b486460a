"""Job outputs, energy files, geometry files and accounting lines as tables."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.operators.logs import lines_of, number

RAW_FILES = "ensemble_id string, task_idx int, file_name string, path string, content string, n_bytes long"


def raw_files(listed: DataFrame) -> DataFrame:
    """Rows of ``ensemble_id``, ``path`` and ``content`` (text or bytes) as files of numbered tasks."""
    content = F.col("content")
    if dict(listed.dtypes)["content"] == "binary":
        content = F.make_valid_utf8(content.cast("string"))
    return listed.select(
        "ensemble_id",
        F.regexp_extract("path", r"task_(\d+)/", 1).try_cast("int").alias("task_idx"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        content.alias("content"),
        F.octet_length("content").cast("long").alias("n_bytes"),
    )


def read_job_outputs(spark: SparkSession, root: str, pattern: str = "*.out", ensemble: str = r"/([^/]+)/task_\d+/") -> DataFrame:
    """All task outputs below ``root``; the ensemble is the folder that holds the task folders."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    )
    named = found.withColumn("ensemble_id", F.regexp_extract("path", ensemble, 1))
    return raw_files(named.select("ensemble_id", "path", "content"))


def task_roster(sizes: DataFrame) -> DataFrame:
    """Every task 1..n of each ensemble, whether or not it left files."""
    return sizes.where(F.col("n_tasks") >= 1).select(
        "ensemble_id", F.explode(F.sequence(F.lit(1), F.col("n_tasks").cast("int"))).alias("task_idx")
    )


def roster_size(declared: Column, counted: Column, override: int = 0) -> Column:
    """Configured size, else the declared one, else the number of task folders."""
    return F.lit(override) if override > 0 else F.coalesce(declared, counted)


def missing_tasks(roster: DataFrame, folders: DataFrame, files: DataFrame) -> DataFrame:
    """Tasks without a folder, and tasks whose folder has no output file."""
    keys = ["ensemble_id", "task_idx"]
    absent = roster.join(folders, keys, "left_anti").select(*keys, F.lit("missing_task_dir").alias("error"))
    empty = roster.join(folders, keys, "left_semi").join(files, keys, "left_anti")
    return absent.unionByName(empty.select(*keys, F.lit("no_orca_out_files_found").alias("error")))


def _line_energies(content: Column) -> Column:
    """Per non-empty line: its last number, or NULL."""
    lines = F.filter(lines_of(content), lambda line: F.trim(line) != "")

    def last(line: Column) -> Column:
        tokens = F.split(F.translate(line, ",", " "), r"\s+")
        return F.try_element_at(F.filter(F.transform(tokens, number), lambda v: v.isNotNull()), F.lit(-1))

    return F.transform(lines, last)


def energies_aligned(files: DataFrame, *keys: str) -> DataFrame:
    """One row per non-empty line; a line without a number keeps its place as NULL."""
    listed = files.select(*keys, F.posexplode(_line_energies(F.col("content"))).alias("pos", "energy_kcal"))
    return listed.select(*keys, (F.col("pos") + 1).alias("ordinal"), "energy_kcal")


def energies_dense(files: DataFrame, *keys: str) -> DataFrame:
    """One row per line that has a number; the others are dropped and the rest renumbered."""
    dense = F.filter(_line_energies(F.col("content")), lambda v: v.isNotNull())
    listed = files.select(*keys, F.posexplode(dense).alias("pos", "energy_kcal"))
    return listed.select(*keys, (F.col("pos") + 1).alias("ordinal"), "energy_kcal")


def accounting_states(lines: DataFrame, *keys: str) -> DataFrame:
    """``id|state|exit`` lines; short lines are ignored and the last line of an id wins."""
    parts = F.split(F.trim("line"), r"\|")
    parsed = lines.where(F.size(parts) >= 3).select(
        *keys, "line_no", parts[0].alias("job_id_raw"),
        F.nullif(parts[1], F.lit("")).alias("state"), F.nullif(parts[2], F.lit("")).alias("exit_code"),
    )
    last = parsed.groupBy(*keys, "job_id_raw").agg(F.max_by(F.struct("state", "exit_code"), "line_no").alias("r"))
    return last.select(*keys, "job_id_raw", "r.state", "r.exit_code")


def frames(files: DataFrame, key: str, bodies: bool = True) -> DataFrame:
    """Multi-frame geometry files to frames, ``key`` being one column that names the file.

    A frame's length stands in its first line, so each file is walked once; a malformed frame ends the
    file and the frames before it stay. Without ``bodies`` the lines of atoms stay where they are.
    """
    key_type = dict(files.dtypes)[key]
    kinds = {"frame_no": pa.int32(), "n_atoms": pa.int32(), "comment": pa.string(), **({"body": pa.list_(pa.string())} if bodies else {})}
    schema = f"{key} {key_type}, frame_no int, n_atoms int, comment string" + (", body array<string>" if bodies else "")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ((place, *frame) for place, text in enumerate(batch.column(1)) for frame in _frames_of(text.as_py(), bodies))
            while rows := list(itertools.islice(found, 5000)):
                place, *values = zip(*rows, strict=True)
                columns = [pa.array(v, kind) for v, kind in zip(values, kinds.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place)), *columns], names=[key, *kinds])

    return files.select(key, "content").mapInArrow(walk, schema)


def _frames_of(text: str, bodies: bool) -> Iterator[tuple[int, int, str, list[str]] | tuple[int, int, str]]:
    lines = text.splitlines()
    at, frame_no = 0, 0
    while at < len(lines):
        head = lines[at].strip()
        if not head:
            at += 1
            continue
        count = int(head) if head.isascii() and head.isdigit() else 0
        if count <= 0 or at + 2 + count > len(lines):
            return
        frame_no += 1
        frame = (frame_no, count, lines[at + 1])
        yield (*frame, lines[at + 2 : at + 2 + count]) if bodies else frame
        at += 2 + count


def atoms(framed: DataFrame, *keys: str) -> DataFrame:
    """Atoms of frames: 0-based index, element and coordinates."""
    exploded = framed.select(*keys, F.posexplode("body").alias("atom_index", "line"))
    tokens = F.split(F.trim("line"), r"\s+")
    return exploded.select(
        *keys, "atom_index", F.get(tokens, F.lit(0)).alias("element"),
        *[number(F.get(tokens, F.lit(n))).alias(axis) for n, axis in ((1, "x"), (2, "y"), (3, "z"))],
    )
