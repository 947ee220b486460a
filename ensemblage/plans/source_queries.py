"""Queries on files, documents and log texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators import logs, thermo
from ensemblage.operators.groups import plan_groups
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes
from ensemblage.sources import documents, files

NMR_FILE_SQL = "concat_ws('_', l_partkey, l_suppkey, 'nmr.out')"

CTES = {
    "run_values": """
        SELECT o_custkey AS ensemble_id, (o_orderkey + 1)::INTEGER AS task_idx, o_orderstatus, o_orderpriority,
               printf('%.12f', -75.9::DOUBLE - o_totalprice * 1e-8)::DOUBLE AS e_low,
               printf('%.12f', -76.0::DOUBLE - o_totalprice * 1e-8)::DOUBLE AS e_high,
               printf('%.12f', 0.04::DOUBLE + (o_orderkey % 7) * 1e-4)::DOUBLE AS g_corr,
               printf('%.12f', (-75.9::DOUBLE - o_totalprice * 1e-8) + (0.04::DOUBLE + (o_orderkey % 7) * 1e-4))::DOUBLE AS g_low,
               printf('%.12f', (-75.9::DOUBLE - o_totalprice * 1e-8) + 0.05::DOUBLE)::DOUBLE AS h_low
        FROM orders""",
    "run_files": """
        SELECT *, 'a_freq.out' AS file_name FROM run_values WHERE o_orderstatus <> 'P'
        UNION ALL SELECT *, 'b_sp.out' FROM run_values WHERE o_orderpriority <> '5-LOW'
        UNION ALL SELECT *, 'orca_nmr_h.out' FROM run_values WHERE o_orderpriority = '1-URGENT'""",
    "picked": """
        SELECT *, CASE WHEN freq THEN 'a_freq.out' ELSE 'b_sp.out' END AS thermo_out,
               CASE WHEN sp THEN 'b_sp.out' ELSE 'a_freq.out' END AS sp_out,
               CASE WHEN sp THEN e_high ELSE e_low END AS e_sp,
               CASE WHEN freq THEN g_corr END AS g_minus, CASE WHEN freq THEN g_low END AS g_full,
               CASE WHEN freq THEN h_low END AS h, CASE WHEN freq THEN -0.01::DOUBLE END AS ts,
               CASE WHEN freq THEN 298.15::DOUBLE END AS t
        FROM (SELECT *, o_orderstatus <> 'P' AS freq, o_orderpriority <> '5-LOW' AS sp FROM run_values) WHERE freq OR sp""",
}


def sql(body: str) -> str:
    return with_ctes(body, CTES)


def log_values(given: Given) -> DataFrame:
    return logs.file_values(given.job_files())


@register("src_job_outputs", sql(r"""
    SELECT ensemble_id, task_idx, file_name, printf('/runs/%d/task_%04d/', ensemble_id, task_idx) || file_name AS path,
           octet_length(encode(content))::BIGINT AS n_bytes, md5(content) AS content_md5
    FROM (SELECT *, CASE file_name
        WHEN 'a_freq.out' THEN printf('FINAL SINGLE POINT ENERGY     %.12f', e_low + 0.5) || chr(10)
            || printf('FINAL SINGLE POINT ENERGY     %.12f', e_low) || chr(10) || 'THERMOCHEMISTRY AT T = 298.15 K' || chr(10)
            || printf('Total enthalpy      ...   %.12f Eh', e_low + 0.05) || chr(10)
            || 'Total entropy correction     ...  -0.010000000000 Eh' || chr(10)
            || printf('Final Gibbs free energy   ...  %.12f Eh', e_low + g_corr) || chr(10)
            || printf('G-E(el)     ...  %.12f Eh  26.3 kcal/mol', g_corr) || chr(10)
        WHEN 'b_sp.out' THEN 'SCF done' || chr(13) || chr(10) || printf('FINAL SINGLE POINT ENERGY     %.12f', e_high) || chr(13) || chr(10)
        ELSE 'FINAL SINGLE POINT ENERGY     -99.000000000000' || chr(10) END
        || CASE o_orderstatus WHEN 'F' THEN '****ORCA TERMINATED NORMALLY****' ELSE 'killed' END || chr(10) AS content FROM run_files)"""))
def job_outputs(spark: SparkSession, folder: str) -> DataFrame:
    found = Given(spark, folder).job_files()
    path = F.concat(F.format_string("/runs/%d/task_%04d/", "ensemble_id", "task_idx"), F.col("file_name"))
    read = files.raw_files(found.select("ensemble_id", path.alias("path"), F.encode("content", "UTF-8").alias("content")))
    return read.select("ensemble_id", "task_idx", "file_name", "path", "n_bytes", F.md5(F.encode("content", "UTF-8")).alias("content_md5"))


@register("src_task_roster", """
    SELECT o_custkey AS ensemble_id, unnest(range(1, max(o_orderkey % 9 + 1)::BIGINT + 1))::INTEGER AS task_idx
    FROM orders GROUP BY o_custkey""")
def roster(spark: SparkSession, folder: str) -> DataFrame:
    sizes = Given(spark, folder).table("orders").groupBy(F.col("o_custkey").alias("ensemble_id")).agg(
        F.max(F.col("o_orderkey") % 9 + 1).alias("n_tasks"))
    return files.task_roster(sizes)


@register("src_declared_roster", """
    SELECT '/m/' || o_orderkey AS ensemble_id, unnest(range(1, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 5 ELSE 1 END + 1))::INTEGER AS task_idx
    FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority NOT IN ('5-LOW', '2-HIGH')""")
def declared_roster(spark: SparkSession, folder: str) -> DataFrame:
    """The tasks that a manifest declares, else as many as it lists artifacts."""
    read = documents.manifests(Given(spark, folder).manifest_texts())
    listed = documents.artifacts(read).groupBy("manifest_path").agg(F.count("*").alias("n_listed"))
    sizes = documents.declared_tasks(read).join(listed, "manifest_path", "left")
    return files.task_roster(sizes.select(
        F.col("manifest_path").alias("ensemble_id"), files.roster_size(F.col("n_tasks"), F.col("n_listed")).alias("n_tasks")))


@register("join_missing_tasks", sql("""
    SELECT o_custkey AS ensemble_id, o_orderkey AS task_idx, 'missing_task_dir' AS error FROM orders
    WHERE o_totalprice < 20000
    UNION ALL
    SELECT o_custkey, o_orderkey, 'no_orca_out_files_found' FROM orders
    WHERE o_totalprice >= 20000 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""))
def missing(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    tasks = given.table("orders").select(
        F.col("o_custkey").alias("ensemble_id"), F.col("o_orderkey").alias("task_idx"), "o_totalprice")
    outputs = given.observed().select("ensemble_id", F.col("l_orderkey").alias("task_idx"))
    return files.missing_tasks(tasks, tasks.where("o_totalprice >= 20000"), outputs)


@register("src_log_lines", """
    SELECT l_orderkey AS ensemble_id, count(*) AS n_files,
           sum(CASE l_returnflag WHEN 'A' THEN 19 WHEN 'N' THEN 11 ELSE 9 END)::BIGINT AS n_lines
    FROM lineitem GROUP BY l_orderkey""")
def lines(spark: SparkSession, folder: str) -> DataFrame:
    listed = logs.log_lines(Given(spark, folder).coupling_files())
    return listed.groupBy("ensemble_id").agg(
        F.count_if(F.col("line_no") == 0).alias("n_files"), F.count("*").alias("n_lines"))


@register("win_block_id", f"""
    SELECT l_orderkey AS ensemble_id, l_linenumber AS task_idx, {NMR_FILE_SQL} AS file_name, block, sum(n_lines)::INTEGER AS n_lines
    FROM lineitem JOIN (VALUES ('A', 1, 16), ('A', 2, 3), ('N', 1, 7), ('N', 2, 4), ('R', 1, 2), ('R', 2, 7)
                       ) b(l_returnflag, block, n_lines) USING (l_returnflag)
    GROUP BY ALL""")
def blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs.block_lines(Given(spark, folder).coupling_files(), r"\bNucleus\s+A\s*[:=]")
    return rows.groupBy(*logs.FILE, "block").agg(F.count("*").cast("int").alias("n_lines"))


@register("src_manifests", """
    SELECT '/m/' || o_orderkey AS manifest_path,
           CASE WHEN problem IS NULL THEN CASE o_orderstatus WHEN 'F' THEN 'wf.manifest.v1' ELSE 'wf.result.v1' END END AS schema,
           CASE WHEN problem IS NULL THEN o_orderstatus = 'F' END AS ok,
           CASE WHEN problem IS NULL THEN CASE o_orderstatus WHEN 'F' THEN 'screen' WHEN 'O' THEN 'search' ELSE 'embed' END END AS step,
           CASE WHEN problem IS NULL THEN CASE o_orderstatus WHEN 'F' THEN o_orderkey ELSE 0 END END AS created_at_unix,
           CASE WHEN problem IS NULL THEN CASE o_orderstatus WHEN 'F' THEN 1.5 ELSE 0 END END::DOUBLE AS runtime_seconds,
           CASE WHEN problem IS NULL THEN CASE o_orderstatus WHEN 'P' THEN '' ELSE '/d' END END AS cwd,
           CASE o_orderstatus WHEN 'F' THEN '/d/up' || o_orderkey || '.json' END AS upstream_path,
           NULL::VARCHAR AS upstream_schema, CASE o_orderstatus WHEN 'F' THEN true END AS upstream_ok,
           CASE o_orderstatus WHEN 'F' THEN '{"raw_argv":[]}' END AS inputs, NULL::VARCHAR AS environment, problem
    FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN CASE o_orderpriority WHEN '5-LOW' THEN 'not_json' WHEN '2-HIGH' THEN 'not_an_object' END END AS problem
          FROM orders)""")
def manifests(spark: SparkSession, folder: str) -> DataFrame:
    return documents.manifests(Given(spark, folder).manifest_texts()).drop("doc")


@register("src_pointers", """
    SELECT o_orderkey AS run_id,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'wf.pointer.v1' END AS schema,
           CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS ok,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '/m/' || o_orderkey END AS manifest_path,
           CASE o_orderpriority WHEN '3-MEDIUM' THEN 'wrong_schema' WHEN '4-NOT SPECIFIED' THEN 'bad_manifest_path'
                                WHEN '5-LOW' THEN 'not_an_object' END AS problem
    FROM orders""")
def pointers(spark: SparkSession, folder: str) -> DataFrame:
    return documents.pointers(Given(spark, folder).pointer_texts())


ARTIFACTS = """
    SELECT '/m/' || o_orderkey AS manifest_path, bucket, pos,
           prefix || CASE WHEN suffix IN ('later', 't.csv', 'no.xyz') THEN '' ELSE o_orderkey::VARCHAR END || suffix AS path_abs, label,
           CASE suffix WHEN '.png' THEN '{"dpi":"300"}' END AS extra
    FROM orders JOIN (VALUES ('F', 'accepted', 0, '/d/', '_1.xyz', NULL), ('F', 'accepted', 1, '/d/', '_2.xyz', NULL),
        ('F', 'accepted', 2, '/d/', '_3.log', NULL), ('F', 'xyz', 0, '/d/', 'no.xyz', NULL),
        ('F', 'files', 0, '/d/', 't.csv', 'csv'), ('F', 'files', 1, '/d/', '.txt', 'Orca_Energies'),
        ('O', 'xyz_ensemble', 0, '/d/', '_ens.xyz', NULL), ('O', 'xyz_ensemble', 1, '/d/', '_ens2.xyz', NULL),
        ('O', 'plots', 0, '/d/', '.png', NULL), ('O', 'files', 0, '/d/', '.energies', NULL), ('O', 'files', 1, '/d/', 'later', 'energies'),
        ('P', 'xyz', 0, '/d/', '_s.xyz', NULL)) a(o_orderstatus, bucket, pos, prefix, suffix, label) USING (o_orderstatus)
    WHERE o_orderstatus <> 'P' OR o_orderpriority NOT IN ('5-LOW', '2-HIGH')"""


@register("src_failures", """
    SELECT '/m/' || o_orderkey AS manifest_path, pos, error, CASE pos WHEN 0 THEN '{"task":"' || o_orderkey || '"}' END AS extra
    FROM orders, (VALUES (0, 'no_energies'), (1, 'stopped')) f(pos, error) WHERE o_orderstatus = 'O'""")
def failures(spark: SparkSession, folder: str) -> DataFrame:
    found = documents.failures(documents.manifests(Given(spark, folder).manifest_texts()))
    return found.withColumn("extra", F.to_json("extra"))


@register("src_artifacts", ARTIFACTS)
def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    listed = documents.artifacts(documents.manifests(Given(spark, folder).manifest_texts()))
    return listed.select("manifest_path", "bucket", "pos", "path_abs", "label", F.to_json("extra").alias("extra"))


@register("src_energy_file_pick", """
    SELECT '/m/' || o_orderkey AS manifest_path,
           '/d/' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '.txt' ELSE '.energies' END AS path_abs
    FROM orders WHERE o_orderstatus <> 'P'""")
def energy_file(spark: SparkSession, folder: str) -> DataFrame:
    return documents.energy_files(documents.artifacts(documents.manifests(Given(spark, folder).manifest_texts())))


@register("src_discover_conformers", f"""
    SELECT manifest_path, CASE bucket WHEN 'accepted' THEN 'many' WHEN 'xyz_ensemble' THEN 'ensemble' ELSE 'single' END AS mode,
           bucket, pos, path_abs
    FROM ({ARTIFACTS}) WHERE path_abs LIKE '%\\_1.xyz' ESCAPE '\\' OR path_abs LIKE '%\\_2.xyz' ESCAPE '\\'
       OR path_abs LIKE '%\\_ens.xyz' ESCAPE '\\' OR path_abs LIKE '%\\_s.xyz' ESCAPE '\\'""")
def discovered(spark: SparkSession, folder: str) -> DataFrame:
    listed = documents.artifacts(documents.manifests(Given(spark, folder).manifest_texts()))
    return documents.discover_conformers(listed).drop("energy_kcal")


@register("fn_energy_item", """
    SELECT '/m/' || o_orderkey AS manifest_path, 0 AS pos, 0.5::DOUBLE AS energy_kcal
    FROM orders WHERE o_orderstatus = 'F'""")
def item_energy(spark: SparkSession, folder: str) -> DataFrame:
    listed = documents.artifacts(documents.manifests(Given(spark, folder).manifest_texts()))
    return listed.where(F.col("energy_kcal").isNotNull()).select("manifest_path", "pos", "energy_kcal")


@register("src_energies_aligned", """
    SELECT o_orderkey, 1 AS ordinal, o_totalprice AS energy_kcal FROM orders
    UNION ALL SELECT o_orderkey, unnest([2, 3, 5]), NULL FROM orders
    UNION ALL SELECT o_orderkey, 4, o_orderkey::DOUBLE FROM orders""")
def aligned(spark: SparkSession, folder: str) -> DataFrame:
    return files.energies_aligned(Given(spark, folder).energy_files(), "o_orderkey")


@register("src_energies_dense", """
    SELECT o_orderkey, 1 AS ordinal, o_totalprice AS energy_kcal FROM orders
    UNION ALL SELECT o_orderkey, 2, o_orderkey::DOUBLE FROM orders""")
def dense(spark: SparkSession, folder: str) -> DataFrame:
    return files.energies_dense(Given(spark, folder).energy_files(), "o_orderkey")


@register("src_multixyz", """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS file_id, frame_no, atom_index,
           element, CASE WHEN frame_no = 2 THEN l_tax WHEN atom_index = 0 THEN l_quantity ELSE x0 END AS x,
           CASE WHEN frame_no = 2 THEN 1.0 WHEN atom_index = 0 THEN l_discount ELSE 0.0 END AS y,
           CASE WHEN frame_no = 2 THEN 2.0 WHEN atom_index = 0 THEN l_tax ELSE z0 END AS z
    FROM lineitem, (VALUES (1, 0, 'O', 0.0::DOUBLE, 0.0::DOUBLE), (1, 1, 'H', 0.0, 0.5), (1, 2, 'H', 0.5, 0.0),
                           (2, 0, 'C', 0.0, 0.0)) a(frame_no, atom_index, element, x0, z0)""")
def multixyz(spark: SparkSession, folder: str) -> DataFrame:
    framed = files.frames(Given(spark, folder).frame_files(), "file_id")
    return files.atoms(framed, "file_id", "frame_no")


@register("log_first_k_frames", """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS file_id, 1 AS frame_no, 3 AS n_atoms
    FROM lineitem""")
def first_frames(spark: SparkSession, folder: str) -> DataFrame:
    framed = files.frames(Given(spark, folder).frame_files(), "file_id", bodies=False)
    return framed.where(F.col("frame_no") <= 1).select("file_id", "frame_no", "n_atoms")


@register("log_comment_energy", """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS file_id, frame_no,
           CASE WHEN frame_no = 1 THEN CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'R' THEN -l_quantity END END AS energy_kcal
    FROM lineitem, (VALUES (1), (2)) f(frame_no)""")
def comments(spark: SparkSession, folder: str) -> DataFrame:
    framed = files.frames(Given(spark, folder).frame_files(), "file_id", bodies=False)
    return framed.select("file_id", "frame_no", logs.comment_energy(F.col("comment")).alias("energy_kcal"))


@register("src_sacct", """
    SELECT job_id, job_id_raw, nullif(split_part(arg_max(rest, event_id), '|', 1), '') AS state,
           nullif(split_part(arg_max(rest, event_id), '|', 2), '') AS exit_code
    FROM (SELECT user_id AS job_id, event_id, user_id || '_' || (event_id % 8 + 1) AS job_id_raw,
                 CASE event_type WHEN 'purchase' THEN 'COMPLETED|0:0' WHEN 'error' THEN 'FAILED|1:0'
                      WHEN 'view' THEN 'CANCELLED by 0|0:0' ELSE '|' END AS rest
          FROM events WHERE event_type <> 'signup')
    GROUP BY job_id, job_id_raw""")
def accounting(spark: SparkSession, folder: str) -> DataFrame:
    return files.accounting_states(Given(spark, folder).accounting_lines(), "job_id")


@register("log_last_marker", sql("""
    SELECT ensemble_id, task_idx, file_name,
           CASE file_name WHEN 'a_freq.out' THEN e_low WHEN 'b_sp.out' THEN e_high ELSE -99.0 END AS final_energy_eh,
           CASE file_name WHEN 'a_freq.out' THEN g_corr END AS g_minus_eel_eh,
           CASE file_name WHEN 'a_freq.out' THEN g_low END AS final_g_eh,
           CASE file_name WHEN 'a_freq.out' THEN h_low END AS total_h_eh,
           CASE file_name WHEN 'a_freq.out' THEN -0.01::DOUBLE END AS ts_corr_eh,
           CASE file_name WHEN 'a_freq.out' THEN 298.15::DOUBLE END AS temperature_k
    FROM run_files"""))
def markers(spark: SparkSession, folder: str) -> DataFrame:
    return log_values(Given(spark, folder)).select(*logs.FILE, *K.LOG_MARKERS)


@register("log_terminated_ok", sql("SELECT ensemble_id, task_idx, file_name, o_orderstatus = 'F' AS ended_ok FROM run_files"))
def ended(spark: SparkSession, folder: str) -> DataFrame:
    return log_values(Given(spark, folder)).select(*logs.FILE, "ended_ok")


@register("log_classify", sql("""
    SELECT ensemble_id, task_idx, file_name, file_name = 'a_freq.out' AS has_thermo, true AS has_energy FROM run_files"""))
def classified(spark: SparkSession, folder: str) -> DataFrame:
    return log_values(Given(spark, folder)).select(*logs.FILE, "has_thermo", "has_energy")


@register("log_pick_outputs", sql("""
    SELECT ensemble_id, task_idx, thermo_out, sp_out, e_sp AS e_high_eh, g_minus AS g_minus_eel_low_eh, g_full AS g_low_eh,
           h AS h_low_eh, ts AS ts_corr_low_eh, t AS t_low_k FROM picked"""))
def picked(spark: SparkSession, folder: str) -> DataFrame:
    return logs.pick_outputs(log_values(Given(spark, folder)))


@register("thm_energy_checks", sql("""
    SELECT ensemble_id, task_idx, 'orca_not_terminated_normally' AS error FROM run_files WHERE o_orderstatus <> 'F'"""))
def energy_checks(spark: SparkSession, folder: str) -> DataFrame:
    return thermo.energy_failures(log_values(Given(spark, folder)))


@register("log_shielding_rows", f"""
    SELECT l_orderkey AS ensemble_id, l_linenumber AS task_idx, {NMR_FILE_SQL} AS file_name, atom_index, element,
           CASE atom_index WHEN 0 THEN printf('%.6f', 25.0::DOUBLE + l_extendedprice * 1e-4)::DOUBLE
                WHEN 1 THEN printf('%.3f', 29.0::DOUBLE + l_quantity * 0.1)::DOUBLE
                WHEN 2 THEN -(printf('%.2f', l_discount + 1.0)::DOUBLE) ELSE 9.0 END AS sigma_iso_ppm, aniso AS sigma_aniso_ppm
    FROM lineitem, (VALUES (0, 'C', 12.5::DOUBLE), (1, 'H', -5.0), (2, 'Cl', 10.0), (9, 'H', 1.5)) a(atom_index, element, aniso)""")
def shielding_rows(spark: SparkSession, folder: str) -> DataFrame:
    return logs.shielding_rows(Given(spark, folder).shielding_files())


COUPLINGS = f"""
    SELECT l_orderkey AS ensemble_id, l_linenumber AS task_idx, {NMR_FILE_SQL} AS file_name, i, elem_i, j, elem_j,
           CASE WHEN b = 2 THEN fixed_total WHEN l_returnflag = 'R' THEN fc + sd + 0.034 + -0.022 + 0.001 ELSE total END AS j_total_hz,
           CASE WHEN b = 1 THEN fc END AS j_fc_hz, CASE WHEN b = 1 THEN sd END AS j_sd_hz,
           CASE WHEN l_returnflag = 'R' THEN 0.034::DOUBLE END AS j_pso_hz,
           CASE WHEN l_returnflag = 'R' THEN -0.022::DOUBLE END AS j_dso_hz
    FROM (SELECT *, printf('%.3f', l_quantity - 7.25)::DOUBLE AS total, printf('%.2f', l_quantity * 0.5)::DOUBLE AS fc,
                 printf('%.2f', l_discount)::DOUBLE AS sd FROM lineitem)
    JOIN (VALUES ('A', 1, 8, 'C', 9, 'H', NULL), ('A', 2, 1, 'H', 2, 'H', 1.5::DOUBLE), ('N', 1, 0, 'C', 1, 'H', NULL),
                 ('N', 2, 4, 'H', 5, 'H', 2.5), ('R', 1, 2, 'H', 3, 'H', NULL)
         ) p(l_returnflag, b, i, elem_i, j, elem_j, fixed_total) USING (l_returnflag)"""


@register("log_coupling_rows", f"""
    SELECT ensemble_id, task_idx, file_name, i, elem_i, j, elem_j, {r6('j_total_hz')} AS j_total_hz, j_fc_hz, j_sd_hz,
           j_pso_hz, j_dso_hz FROM ({COUPLINGS})""")
def coupling_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs.coupling_rows(Given(spark, folder).coupling_files())
    return rows.withColumn("j_total_hz", F.round("j_total_hz", 6))


@register("log_coupling_total", f"""
    SELECT ensemble_id, count(*) AS n_pairs, {r6('sum(j_total_hz)')} AS sum_total_hz
    FROM ({COUPLINGS}) WHERE j_pso_hz IS NOT NULL GROUP BY ensemble_id""")
def synthesized(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs.coupling_rows(Given(spark, folder).coupling_files()).where(F.col("j_pso_hz").isNotNull())
    return rows.groupBy("ensemble_id").agg(
        F.count("*").alias("n_pairs"), F.round(F.sum("j_total_hz"), 6).alias("sum_total_hz"))


@register("thm_from_logs", with_ctes(f"""
    SELECT ensemble_id, task_idx, thermo_out, sp_out, {r6('g')} AS g_composite_eh, {r6('dg')} AS delta_g_kcal,
           {r6('CASE WHEN dg IS NOT NULL THEN e / sum(e) OVER (PARTITION BY ensemble_id) END')} AS weight
    FROM (SELECT *, exp(-dg / ({K.R_KCAL_PER_MOL_K}::DOUBLE * {K.ROOM_TEMPERATURE_K}::DOUBLE)) AS e
          FROM (SELECT *, (g - min(g) OVER (PARTITION BY ensemble_id)) * {K.HARTREE_TO_KCAL}::DOUBLE AS dg
                FROM (SELECT *, coalesce(e_sp + g_minus, g_full) AS g FROM picked)))""", CTES))
def thermo_from_logs(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    plan = plan_groups(given.thermo_in(), thermo.ENSEMBLE)
    picks = logs.pick_outputs(log_values(given)).withColumn("conf_idx", F.col("task_idx"))
    rows = thermo.populations(picks, plan=plan)
    measures = ["g_composite_eh", "delta_g_kcal", "weight"]
    return rows.select("ensemble_id", "task_idx", "thermo_out", "sp_out", *[F.round(m, 6).alias(m) for m in measures])
