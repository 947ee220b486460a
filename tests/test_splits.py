"""Files read by byte ranges against whole files."""

import random

import pytest
from pyspark.sql import functions as F

from ensemblage.operators import logs
from ensemblage.sources import files, splits


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    return str(folder)


def test_lines_and_blocks_are_those_of_whole_files(spark, tmp_path, small_splits):
    rng = random.Random(2)
    texts = {f"{i}.out": "\n".join(rng.choice(["Nucleus A: 1", "nucleus a = 2\r", "x" * rng.randrange(60), "", "Nucleus B: 3"]) for _ in range(n)) + "."
             for i, n in enumerate((0, 1, 40, 1_500))}
    path = write(tmp_path / "logs", texts)
    rows = splits.numbered_lines(spark, path)
    assert rows.rdd.getNumPartitions() >= 8
    name = F.element_at(F.split("path", "/"), -1).alias("file_name")
    got = sorted(tuple(r) for r in rows.select(name, "line_no", "line").collect())
    whole = spark.createDataFrame([("m", 1, n, t) for n, t in texts.items()], "ensemble_id string, task_idx int, file_name string, content string")
    assert got == sorted(tuple(r) for r in logs.log_lines(whole).select("file_name", F.col("line_no").cast("long"), "line").collect())
    header = r"\bNucleus\s+A\s*[:=]"
    blocks = sorted(tuple(r) for r in splits.block_lines(spark, path, header).select(name, "block", "pos", "line").collect())
    assert blocks == sorted(tuple(r) for r in logs.block_lines(whole, header).select("file_name", F.col("block").cast("long"), F.col("pos").cast("long"), "line").collect())


def geometry(rng, frames, end=""):
    out = []
    for _ in range(frames):
        n = rng.randint(1, 7)
        out += [""] * rng.choice([0, 0, 0, 1, 3, 300 if rng.random() < 0.1 else 0]) + [f" {n} ", rng.choice(["energy -1.5", "12", ""])]
        out += [rng.choice(["C 0.0 1.0 2.0", "H 1 2 3", "4"]) for _ in range(n)]
    return "\n".join(out) + "\n" + end


def test_frames_are_those_of_a_single_walk(spark, tmp_path, small_splits):
    rng = random.Random(3)
    texts = {"a.xyz": geometry(rng, 300), "b.xyz": geometry(rng, 20, "9\ncut\nH 0 0 0\n"), "c.xyz": geometry(rng, 3, "no frame\n1\nx\nC 0 0 0\n"),
             "d.xyz": "\n\n", "e.xyz": "words\n1\nx\nC 0 0 0\n", "f.xyz": geometry(rng, 2, "0\nx\n") + "1\nx\nC 0 0 0\n"}
    path = write(tmp_path / "frames", texts)
    whole = spark.createDataFrame(list(texts.items()), "file_id string, content string")
    want = sorted((r.file_id, r.frame_no, r.n_atoms, i - 1, line) for r in files.frames(whole, "file_id").collect() for i, line in enumerate([r.comment, *r.body]))
    name = F.element_at(F.split("path", "/"), -1).alias("file_id")
    found = splits.frame_lines(spark, path).select(name, "frame_no", "n_atoms", "atom_index", "line")
    assert sorted(tuple(r) for r in found.collect()) == want and len(want) > 1_500


def test_folder_of_empty_files(spark, tmp_path):
    path = write(tmp_path / "none", {"a.xyz": "", "b.txt": "1\nx\nC 0 0 0\n"})
    assert splits.frame_lines(spark, path, "*.xyz").count() == 0
