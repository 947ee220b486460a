"""Log texts, files and documents."""

import os

import pytest
from pyspark.sql import functions as F

from ensemblage.operators import logs, sinks, thermo
from ensemblage.sources import documents, files

SCHEMA = "ensemble_id string, task_idx int, file_name string, content string"


def file_table(spark, *contents, name="job.out"):
    return spark.createDataFrame([("m", i, name, c) for i, c in enumerate(contents, 1)], SCHEMA)


COMPOUND = """THERMOCHEMISTRY AT T = 298.15 K
FINAL SINGLE POINT ENERGY   -76.100000000
Total enthalpy                    ...  -76.123456789 Eh
Total entropy correction          ...   -0.034567890 Eh
Final Gibbs free energy           ...  -76.158024679 Eh
G-E(el)                           ...   -0.041234567 Eh
$new_job
FINAL SINGLE POINT ENERGY   -76.987654321
   ****ORCA TERMINATED NORMALLY****
"""


def test_last_markers(spark):
    got = logs.file_values(file_table(spark, COMPOUND, "FINAL SINGLE POINT ENERGY -1.5\nkilled")).orderBy("task_idx").collect()
    first = got[0]
    assert (first.final_energy_eh, first.g_minus_eel_eh, first.final_g_eh) == (-76.987654321, -0.041234567, -76.158024679)
    assert (first.total_h_eh, first.ts_corr_eh, first.temperature_k) == (-76.123456789, -0.03456789, 298.15)
    assert first.ended_ok and first.has_thermo and first.has_energy
    assert got[1].final_energy_eh == -1.5 and got[1].final_g_eh is None and not got[1].ended_ok


def test_marker_case_rules(spark):
    text = "final single point energy -1.0\ntotal ENTHALPY ... -2.0 eh\n"
    got = logs.file_values(file_table(spark, text)).first()
    assert got.final_energy_eh is None and got.total_h_eh == -2.0


def test_normal_end_only_counts_in_the_tail(spark):
    early = "ORCA TERMINATED NORMALLY\n" + "x" * 20000
    assert not logs.file_values(file_table(spark, early)).first().ended_ok


def picked(spark, *named, **options):
    df = spark.createDataFrame([("m", 1, n, c) for n, c in named], SCHEMA)
    return logs.pick_outputs(logs.file_values(df), **options).first()


def test_pick_separate_and_single_files(spark):
    both = picked(spark, ("a.out", COMPOUND), ("b.out", "FINAL SINGLE POINT ENERGY -77.5"))
    assert (both.thermo_out, both.sp_out, both.e_high_eh) == ("a.out", "b.out", -77.5)
    one = picked(spark, ("a.out", COMPOUND))
    assert (one.thermo_out, one.sp_out, one.e_high_eh) == ("a.out", "a.out", -76.987654321)
    neither = picked(spark, ("a.out", "nothing"), ("b.out", "nothing"))
    assert (neither.thermo_out, neither.sp_out, neither.e_high_eh) == ("b.out", "b.out", None)


def test_nmr_runs_are_no_energy_source_unless_asked(spark):
    named = (("a.out", COMPOUND), ("orca_nmr_j.out", "FINAL SINGLE POINT ENERGY -99.0"))
    assert picked(spark, *named).sp_out == "a.out"
    assert picked(spark, *named, sp_candidates="all").e_high_eh == -99.0


def test_energy_failures_may_both_fire(spark):
    got = thermo.energy_failures(logs.file_values(file_table(spark, "nothing", COMPOUND))).collect()
    assert sorted((r.task_idx, r.error) for r in got) == [(1, "missing_or_unparsed_energy"), (1, "orca_not_terminated_normally")]


TABLE = """
CHEMICAL SHIELDING SUMMARY (ppm)
--------------------------------
  Nucleus  Element    Isotropic     Anisotropy
   0       C          175.234       12.345
   1       H           29.700        5.000
   2       H           30.100        5.100

   3       H           99.000        5.100
"""


def test_shieldings(spark):
    rows = logs.shielding_rows(file_table(spark, TABLE)).orderBy("atom_index").collect()
    assert [(r.atom_index, r.element, r.sigma_iso_ppm) for r in rows] == [(0, "C", 175.234), (1, "H", 29.7), (2, "H", 30.1)]
    later = TABLE + "Chemical Shielding Summary\n 1 H 29.999 5.0\n"
    assert {r.atom_index: r.sigma_iso_ppm for r in logs.shielding_rows(file_table(spark, later)).collect()} == {0: 175.234, 1: 29.999, 2: 30.1}
    other = "CHEMICAL SHIELDING SUMMARY\nTIMING SUMMARY\n 1 H 29.0 5.0\n"
    assert logs.shielding_rows(file_table(spark, other)).count() == 0


def couplings(spark, text):
    return [tuple(r)[3:] for r in logs.coupling_rows(file_table(spark, text)).orderBy("i", "j").collect()]


def test_same_line_coupling_header_with_wide_spacing(spark):
    head = " NUCLEUS A = H    8 NUCLEUS B = H    9\n" + " filler\n" * 38
    terms = " J[8,9](FC) iso= -15.001\n J[8,9](SD) iso= 0.012\n J[8,9](PSO) iso= 0.034\n J[8,9](DSO) iso= -0.022\n"
    assert couplings(spark, head + " J[8,9](Total) iso= -14.978\n" + terms) == [(8, "H", 9, "H", -14.978, -15.001, 0.012, 0.034, -0.022)]
    summed = couplings(spark, head + terms)
    assert summed[0][4] == pytest.approx(-14.977)


def test_two_line_and_comma_headers(spark):
    two = " Nucleus A: 0 C\n Nucleus B: 1 H\nFermi contact contribution : 143.456 Hz\nTotal : 145.123 Hz\n"
    assert couplings(spark, two)[0][:6] == (0, "C", 1, "H", 145.123, 143.456)
    comma = "NUCLEUS A = 2 H, NUCLEUS B = 3 H\n Total coupling = 12.345\n"
    assert couplings(spark, comma)[0][:5] == (2, "H", 3, "H", 12.345)


def test_last_block_of_a_pair_wins_and_foreign_marks_do_not_count(spark):
    text = (
        " NUCLEUS A = C 9 NUCLEUS B = H 8\n J[8,9](Total) iso= 1.0\n"
        " NUCLEUS A = H 8 NUCLEUS B = C 9\n J[1,2](Total) iso= 7.0\n J[9,8](Total) iso= 2.0\n"
    )
    assert [r[:5] for r in couplings(spark, text)] == [(8, "H", 9, "C", 2.0)]
    assert couplings(spark, "Nucleus A: 0 C\nno partner\n") == []


def test_no_coupling_mark_of_a_long_line_is_lost(spark):
    marks = " J[1,2](FC) iso= 7.0" * 1_200 + " J[8,9](Total) iso= 2.0"
    text = f" NUCLEUS A = H 8 NUCLEUS B = C 9\n{marks}\n"
    assert [r[:5] for r in couplings(spark, text)] == [(8, "H", 9, "C", 2.0)]


def test_comment_energies(spark):
    lines = ["   0.5 kcal/mol", "Erel:   1.234 kcal/mol Etot: -123.45 Eh", "Energy: -123.456 Eh", "2.5", "", "none",
             "Energy: -123.456 [Eh]", "E -123.45 Hartree.", "E=-123.4(Hartree)", "conf1 0.7 kcal/mol (-1.0 Eh)", "conf1 0.9"]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, c string")
    got = [r[0] for r in df.orderBy("n").select(logs.comment_energy(F.col("c"))).collect()]
    assert got == [0.5, 1.234, None, 2.5, None, None, None, None, None, 0.7, 0.9]


@pytest.mark.parametrize(
    ("text", "aligned", "dense"),
    [
        ("1 -1.234 0.0\n2 -1.230 0.5\n3 -1.225 1.0", [0.0, 0.5, 1.0], [0.0, 0.5, 1.0]),
        ("0.0\nNA\n0.5\n# header\n\n1.0\nNaN", [0.0, None, 0.5, None, 1.0, None], [0.0, 0.5, 1.0]),
        ("1, -1.234, 0.0\r\n", [0.0], [0.0]),
    ],
)
def test_energy_files(spark, text, aligned, dense):
    df = spark.createDataFrame([("m", text)], "ensemble_id string, content string")
    assert [r.energy_kcal for r in files.energies_aligned(df, "ensemble_id").orderBy("ordinal").collect()] == aligned
    assert [r.energy_kcal for r in files.energies_dense(df, "ensemble_id").orderBy("ordinal").collect()] == dense


def test_frames_stop_at_the_first_malformed_one(spark):
    text = "\n2\nfirst\nH 0 0 0\nC 1.5 0 -2e0\n\n1\nsecond\nO 1 2 3\nx\nbad\n1\nlost\nH 0 0 0\n"
    framed = files.frames(spark.createDataFrame([("f", text), ("g", "3\nshort\nH 0 0 0")], "file_id string, content string"), "file_id")
    assert [(r.frame_no, r.n_atoms, r.comment) for r in framed.orderBy("frame_no").collect()] == [(1, 2, "first"), (2, 1, "second")]
    atoms = files.atoms(framed, "file_id", "frame_no").orderBy("frame_no", "atom_index").collect()
    assert [(r.element, r.x, r.z) for r in atoms] == [("H", 0.0, 0.0), ("C", 1.5, -2.0), ("O", 1.0, 3.0)]


def test_frames_without_bodies_carry_no_lines_of_atoms(spark):
    from ensemblage.plans import source_queries

    df = spark.createDataFrame([("f", "2\nfirst\nH 0 0 0\nC 1 0 0\n1\nsecond\nO 1 2 3\n"), ("g", "1\n\nH 0 0 0"), ("h", "")], "file_id string, content string")
    bare, whole = files.frames(df, "file_id", bodies=False), files.frames(df, "file_id")
    assert sorted(map(tuple, bare.collect())) == sorted(map(tuple, whole.drop("body").collect())) and bare.count() == 3
    for query in (source_queries.comments, source_queries.first_frames):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
        assert "MapInArrow" in plan and "body" not in plan


def test_job_outputs_from_disk(spark, tmp_path):
    for task, name, data in ((1, "a.out", b"ok \xff\n"), (2, "b.out", b"x"), (2, "skip.txt", b"y")):
        folder = tmp_path / "mol7" / f"task_{task:04d}"
        os.makedirs(folder, exist_ok=True)
        (folder / name).write_bytes(data)
    got = files.read_job_outputs(spark, str(tmp_path)).orderBy("task_idx").collect()
    assert [(r.ensemble_id, r.task_idx, r.file_name, r.n_bytes) for r in got] == [("mol7", 1, "a.out", 5), ("mol7", 2, "b.out", 1)]
    assert got[0].content == "ok �\n"


def test_missing_tasks(spark):
    roster = files.task_roster(spark.createDataFrame([("m", 3)], "ensemble_id string, n_tasks int"))
    folders = spark.createDataFrame([("m", 1), ("m", 3)], "ensemble_id string, task_idx int")
    outputs = spark.createDataFrame([("m", 1)], "ensemble_id string, task_idx int")
    got = files.missing_tasks(roster, folders, outputs).orderBy("task_idx").collect()
    assert [(r.task_idx, r.error) for r in got] == [(2, "missing_task_dir"), (3, "no_orca_out_files_found")]


def test_accounting_states(spark):
    lines = ["1_1|COMPLETED|0:0", "", "1_2|RUNNING", "1_1|FAILED|1:0", "1_3||"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")
    got = {r.job_id_raw: (r.state, r.exit_code) for r in files.accounting_states(df).collect()}
    assert got == {"1_1": ("FAILED", "1:0"), "1_3": (None, None)}


def test_pointers(spark):
    texts = ['{"schema":"wf.pointer.v1","ok":true,"manifest_path":"/a"}', '{"schema":"wf.pointer.v1","manifest_path":"/a"}',
             "", "{", "[]", '{"schema":"x","manifest_path":"/a"}', '{"schema":"wf.pointer.v1"}', '{"schema":"wf.pointer.v1","manifest_path":5}']
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = documents.pointers(df).orderBy("n").collect()
    assert [r.problem for r in got] == [None, None, "empty", "not_json", "not_an_object", "wrong_schema", "no_manifest_path", "bad_manifest_path"]
    assert [r.ok for r in got[:3]] == [True, False, None]


def test_written_tables_read_back(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, 1.5), ("a", 2, None), ("a", 1, 0.5)], "ensemble_id string, conf_idx int, value double")
    sinks.write_table(df, str(tmp_path / "t"), ["conf_idx"])
    back = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    frames = df.select("ensemble_id", "conf_idx", F.lit("1\nc\nH 0 0 0").alias("text"))
    sinks.write_lines(sinks.ensemble_frames(frames), str(tmp_path / "x"), ["conf_idx"], separator="\n")
    back = sinks.read_lines(spark, str(tmp_path / "x")).where("text <> ''").groupBy("ensemble_id").count().collect()
    assert {r.ensemble_id: r["count"] for r in back} == {"a": 6, "b": 3}


def test_manifests_keep_unreadable_texts_and_custom_buckets(spark):
    texts = ['{"ok":true,"artifacts":{"plots":[{"path":"/p.png","dpi":300},"/q.png"],"array":{"n_tasks":2}},"failures":[{"error":"x","step":1},"y",5]}', "{", "[1]"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "manifest_path string, text string")
    read = documents.manifests(df)
    assert [(r.ok, r.problem) for r in read.orderBy("manifest_path").collect()] == [(True, None), (None, "not_json"), (None, "not_an_object")]
    listed = documents.artifacts(read).orderBy("pos").collect()
    assert [(r.bucket, r.path_abs, r.extra) for r in listed] == [("plots", "/p.png", {"dpi": "300"}), ("plots", "/q.png", None)]
    failed = documents.failures(read).orderBy("pos").collect()
    assert [(r.pos, r.error, r.extra) for r in failed] == [(0, "x", {"step": "1"}), (1, "y", None), (2, None, None)]


def test_energy_lines(spark):
    df = spark.createDataFrame([(1, -123.456789012, 0.0), (2, None, None)], "i int, e double, r double")
    got = [r[0] for r in df.orderBy("i").select(sinks.energy_line(F.col("i"), F.col("e"), F.col("r"))).collect()]
    assert got == ["     1   -123.456789012000    0.000000", "     2   NaN   NaN"]


def test_containers_of_many_ensembles_and_keys_of_folders(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.range(30_000).select(F.format_string("%05d", F.col("id") % 10_000).alias("ensemble_id"), F.col("id").alias("n"), F.concat(F.lit("line "), "id").alias("text"))
    sinks.write_containers(rows, path, ["n"])
    assert 0 < len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 64
    back = sinks.read_containers(spark, path)
    assert back.count() == 30_000 and back.select("ensemble_id").distinct().count() == 10_000
    one = sinks.read_containers(spark, path, ["00007", "nobody"])
    assert [tuple(r) for r in sinks.join_lines(one).collect()] == [("00007", "line 7\nline 10007\nline 20007")]
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [In(ensemble_id" in plan
    broken = rows.withColumn("text", F.when(F.col("n") < 29_000, F.col("text")).otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        sinks.write_containers(broken, str(tmp_path / "d"), ["n"])
    assert not os.path.exists(tmp_path / "d") or not [f for f in os.listdir(tmp_path / "d") if f.startswith("part-") or f == "_SUCCESS"]
    few = rows.where("n IN (7, 12)").withColumn("text", F.lit("x"))
    sinks.write_lines(few, str(tmp_path / "l"), ["n"])
    assert sorted(tuple(r) for r in sinks.read_lines(spark, str(tmp_path / "l")).collect()) == [("00007", "x"), ("00012", "x")]


def test_texts_are_read_once_and_after_they_are_spread(spark):
    """No filter on what is parsed comes before the exchange that spreads files over cores, nor reads the lines again."""
    files = file_table(spark, "Nucleus A: 0 C\nNucleus B: 1 H\nTotal : 2.5 Hz\n").repartition(3)
    rows = {
        "couplings": logs.coupling_rows(files).where("j_pso_hz IS NOT NULL"), "shieldings": logs.shielding_rows(files),
        "blocks": logs.block_lines(files, r"\bNucleus\s+A\s*[:=]"),
    }
    for name, found in rows.items():
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.rindex("Generate"):]
        assert "Filter" not in below, (name, plan)
