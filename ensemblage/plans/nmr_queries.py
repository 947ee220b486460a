"""Queries on averaged and calibrated shieldings and couplings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.operators import nmr, sinks, thermo
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes
from ensemblage.session import cut_lineage


def weights(given: Given) -> DataFrame:
    """Conformer weights as the stored result of the thermochemistry step, which several averages read."""
    return cut_lineage(thermo.populations(given.thermo_in()).select("ensemble_id", "conf_idx", "weight"), "weights")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@register("join_weights_observables", with_ctes("""
    SELECT ensemble_id, count(*) AS n_rows, count(DISTINCT conf_idx) AS n_conformers
    FROM shieldings JOIN weights USING (ensemble_id, conf_idx) GROUP BY ensemble_id"""))
def members(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    joined = nmr.weighted_members(given.shieldings(), weights(given))
    per_conformer = joined.groupBy("ensemble_id", "conf_idx").agg(F.count("*").alias("n"))
    return per_conformer.groupBy("ensemble_id").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_conformers")
    )


@register("join_semi_observed", with_ctes("""
    SELECT ensemble_id, conf_idx FROM conformers c
    WHERE EXISTS (SELECT 1 FROM shieldings s WHERE s.ensemble_id = c.ensemble_id AND s.conf_idx = c.conf_idx)"""))
def observed(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    kept = given.conformers().join(given.shieldings(), ["ensemble_id", "conf_idx"], "left_semi")
    return kept.select("ensemble_id", "conf_idx")


@register("agg_weighted_shielding", with_ctes(f"""
    SELECT ensemble_id, atom_index, element, {r6('sigma_avg')} AS sigma_avg_ppm, n_used FROM sigma_means"""))
def shielding_means(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), weights(given))
    return rounded(means, "sigma_avg_ppm").select("ensemble_id", "atom_index", "element", "sigma_avg_ppm", "n_used")


@register("agg_weighted_coupling", with_ctes(f"""
    SELECT ensemble_id, i, j, elem_i, elem_j, {r6('j_avg')} AS j_avg_hz, n_used FROM j_means"""))
def coupling_means(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_couplings(given.couplings(), weights(given))
    return rounded(means, "j_avg_hz").select("ensemble_id", "i", "j", "elem_i", "elem_j", "j_avg_hz", "n_used")


@register("join_calibration", """
    WITH keyed AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE l_returnflag WHEN 'A' THEN ' wp04 ' WHEN 'N' THEN 'WB97X-d' ELSE 'B3LYP' END AS functional,
               CASE l_returnflag WHEN 'A' THEN '6-311++G(2d,p)' ELSE '6-31g(d,p)' END AS basis,
               CASE l_linestatus WHEN 'O' THEN 'chcl3' ELSE 'CHCl3' END AS solvent,
               CASE l_returnflag WHEN 'A' THEN '1H' ELSE '13C' END AS nucleus
        FROM lineitem)
    SELECT keyed.*, CASE trim(lower(functional)) WHEN 'wp04' THEN -1.0698 WHEN 'wb97x-d' THEN -1.0501 END::DOUBLE AS slope,
           CASE trim(lower(functional)) WHEN 'wp04' THEN 31.8447 WHEN 'wb97x-d' THEN 187.25 END::DOUBLE AS intercept
    FROM keyed""")
def calibrated(spark: SparkSession, folder: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    keyed = Given(spark, folder).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(flag == "A", " wp04 ").when(flag == "N", "WB97X-d").otherwise("B3LYP").alias("functional"),
        F.when(flag == "A", "6-311++G(2d,p)").otherwise("6-31g(d,p)").alias("basis"),
        F.when(status == "O", "chcl3").otherwise("CHCl3").alias("solvent"),
        F.when(flag == "A", "1H").otherwise("13C").alias("nucleus"),
    )
    joined = nmr.join_calibration(keyed, nmr.calibration_table(spark))
    return joined.select(*keyed.columns, "slope", "intercept")


@register("nmr_predict_shift", with_ctes(f"""
    SELECT ensemble_id, atom_index, element, {r6('sigma_avg')} AS sigma_avg_ppm, {r6('delta_ppm')} AS delta_ppm,
           cal_source, cal_method, cal_basis, cal_solvent, n_used
    FROM shift_table"""))
def shifts(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), weights(given))
    table = nmr.predict_shifts(means, nmr.calibration_table(spark))
    return rounded(table, "sigma_avg_ppm", "delta_ppm").drop("out_of_range")


@register("nmr_predict_coupling", with_ctes(f"""
    SELECT ensemble_id, i, elem_i, j, elem_j, {r6('j_avg')} AS j_avg_hz, {r6('j_predicted')} AS j_predicted_hz,
           cal_source, cal_method, cal_basis, cal_solvent, n_used
    FROM coupling_table"""))
def couplings(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_couplings(given.couplings(), weights(given))
    table = nmr.predict_couplings(means, nmr.calibration_table(spark))
    return rounded(table, "j_avg_hz", "j_predicted_hz")


@register("nmr_calibration_gaps", with_ctes("""
    SELECT ensemble_id, 'calibration_not_found' AS error, nucleus, functional, basis, 'water' AS solvent
    FROM (SELECT DISTINCT ensemble_id, element FROM sigma_means)
    JOIN (VALUES ('H', '1H', 'WP04', '6-311++G(2d,p)'), ('H', '1H-1H_J', 'mPW1PW91', 'pcJ-2'),
                 ('C', '13C', 'wB97X-D', '6-31G(d,p)')) needed(element, nucleus, functional, basis) USING (element)"""))
def gaps(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), weights(given))
    return nmr.calibration_gaps(means, nmr.calibration_table(spark), nmr.NmrSettings(solvent="water"))


@register("nmr_out_of_range", with_ctes("""
    SELECT ensemble_id, atom_index, element, CASE element WHEN 'H' THEN NOT (delta_ppm BETWEEN 0 AND 12)
           WHEN 'C' THEN NOT (delta_ppm BETWEEN 0 AND 220) END AS out_of_range
    FROM shift_table"""))
def out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), weights(given))
    table = nmr.predict_shifts(means, nmr.calibration_table(spark))
    return table.select("ensemble_id", "atom_index", "element", "out_of_range")


@register("nmr_overrides", with_ctes(f"""
    SELECT ensemble_id, atom_index, element,
           {r6("CASE element WHEN 'H' THEN (sigma_avg - 30.0) / -1.0::DOUBLE ELSE delta_ppm END")} AS delta_ppm,
           CASE element WHEN 'H' THEN 'own fit' ELSE cal_source END AS cal_source
    FROM shift_table"""))
def overrides(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), weights(given))
    own = spark.createDataFrame(
        [("wp04", "6-311++G(2d,p)", "CHCl3", "1H", -1.0, 30.0, "own fit", None, None)], nmr.CALIBRATION_SCHEMA
    )
    table = nmr.predict_shifts(means, nmr.calibration_table(spark, own))
    return rounded(table, "delta_ppm").select("ensemble_id", "atom_index", "element", "delta_ppm", "cal_source")


@register("agg_hh_coverage", with_ctes("""
    SELECT ensemble_id, n_h_atoms, coalesce(n_hh, 0) AS n_hh_pairs, n_h_atoms * (n_h_atoms - 1) // 2 AS n_hh_possible,
           n_h_atoms >= 2 AND coalesce(n_hh, 0) = 0 AS failed
    FROM (SELECT ensemble_id, count(*) FILTER (element = 'H') AS n_h_atoms FROM sigma_means GROUP BY ensemble_id)
    LEFT JOIN (SELECT ensemble_id, count(*) FILTER (hh) AS n_hh FROM coupling_table GROUP BY ensemble_id)
    USING (ensemble_id)"""))
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    known = weights(given)
    return nmr.hydrogen_coverage(
        nmr.average_shieldings(given.shieldings(), known), nmr.average_couplings(given.couplings(), known)
    )


@register("nmr_failures", with_ctes("""
    SELECT ensemble_id, NULL::BIGINT AS conf_idx, 'no_finite_weights' AS error
    FROM weighted GROUP BY ensemble_id HAVING count(w) = 0
    UNION ALL
    SELECT ensemble_id, NULL, 'no_shielding_data_in_any_conformer'
    FROM weighted WHERE ensemble_id NOT IN (SELECT ensemble_id FROM sigma_users) GROUP BY ensemble_id HAVING count(w) > 0
    UNION ALL
    SELECT ensemble_id, conf_idx, 'coupling_parse_empty' FROM conformers
    WHERE (ensemble_id, conf_idx) NOT IN (SELECT (ensemble_id, conf_idx) FROM couplings)
    UNION ALL
    SELECT ensemble_id, NULL, 'no_hh_couplings_parsed'
    FROM (SELECT ensemble_id, count(*) FILTER (element = 'H') AS n_h FROM sigma_means GROUP BY ensemble_id)
    LEFT JOIN (SELECT ensemble_id, count(*) FILTER (hh) AS n_hh FROM coupling_table GROUP BY ensemble_id)
    USING (ensemble_id) WHERE n_h >= 2 AND coalesce(n_hh, 0) = 0"""))
def failures(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    files = given.conformers().select("ensemble_id", "conf_idx")
    return nmr.nmr_failures(weights(given), given.shieldings(), given.couplings(), files)


NMR_SUMMARY = with_ctes("""
    SELECT ensemble_id, 'CHCl3' AS solvent, n_conformers_total, true AS cal_h_found, true AS cal_c_found,
           n_atoms, n_h_atoms, n_with_shielding, coalesce(n_users, 0) AS n_with_couplings,
           coalesce(n_hh, 0) AS n_hh_pairs, n_h_atoms AS n_h_scaled, n_c AS n_c_scaled, coalesce(n_hh, 0) AS n_hh_scaled,
           n_h_atoms > 0 AS cal_h_used, n_c > 0 AS cal_c_used, true AS cal_j_found, coalesce(n_hh, 0) > 0 AS cal_j_used
    FROM (SELECT ensemble_id, count(*) AS n_atoms, count(*) FILTER (element = 'H') AS n_h_atoms,
                 count(*) FILTER (element = 'C') AS n_c, max(n_used) AS n_with_shielding
          FROM sigma_means GROUP BY ensemble_id)
    LEFT JOIN (SELECT ensemble_id, count(*) FILTER (hh) AS n_hh, max(n_used) AS n_users
               FROM coupling_table GROUP BY ensemble_id) USING (ensemble_id)
    LEFT JOIN (SELECT ensemble_id, count(DISTINCT conf_idx) AS n_conformers_total FROM weighted GROUP BY ensemble_id) USING (ensemble_id)""")


def summary_table(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    table = nmr.calibration_table(spark)
    known = weights(given)
    predicted = nmr.nmr_tables(known, given.shieldings(), given.couplings(), table)
    return nmr.nmr_summary(*predicted, table, conformers=known)


register("agg_nmr_summary", NMR_SUMMARY)(summary_table)


@register("sink_nmr_summary_json", f"""
    SELECT ensemble_id, '{{"solvent":"' || solvent || '","n_conformers_total":' || n_conformers_total || ',"n_atoms":' || n_atoms ||
           ',"n_h_atoms":' || n_h_atoms || ',"n_with_shielding":' || n_with_shielding || ',"n_with_couplings":' || n_with_couplings ||
           ',"n_hh_pairs":' || n_hh_pairs || ',"n_h_scaled":' || n_h_scaled || ',"n_c_scaled":' || n_c_scaled || ',"n_hh_scaled":' || n_hh_scaled ||
           ',"cal_h_used":' || cal_h_used || ',"cal_c_used":' || cal_c_used || ',"cal_h_found":' || cal_h_found || ',"cal_c_found":' || cal_c_found ||
           ',"cal_j_found":' || cal_j_found || ',"cal_j_used":' || cal_j_used || '}}' AS summary
    FROM ({NMR_SUMMARY})""")
def summary_json(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.nmr_summary_json(summary_table(spark, folder))


@register("set_nmr_union", with_ctes("""
    SELECT *, 'nmr' AS job_kind FROM dedicated
    UNION ALL
    SELECT ensemble_id, conf_idx, atom_index, 'thermo' FROM shieldings
    WHERE element = 'O' AND (ensemble_id, conf_idx) NOT IN (SELECT (ensemble_id, conf_idx) FROM covered)""", {
    "dedicated": "SELECT ensemble_id, conf_idx, atom_index FROM shieldings WHERE element IN ('H', 'C')",
    "covered": """SELECT ensemble_id, conf_idx FROM dedicated
                  UNION SELECT ensemble_id, conf_idx FROM couplings WHERE elem_i = 'H'"""}))
def nmr_union(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    rows = given.shieldings().select("ensemble_id", "conf_idx", "atom_index", "element")
    dedicated = rows.where(F.col("element") == "H").unionByName(rows.where(F.col("element") == "C"))
    compound = rows.where(F.col("element") == "O").withColumn("job_kind", F.lit("thermo"))
    other = given.couplings().where(F.col("elem_i") == "H")
    united = nmr.with_fallback(dedicated.withColumn("job_kind", F.lit("nmr")), other, compound)
    return united.select("ensemble_id", "conf_idx", "atom_index", "job_kind")


@register("nmr_tables", with_ctes(f"""
    SELECT ensemble_id, 'shift' AS kind, atom_index AS i, NULL::INTEGER AS j, {r6('sigma_avg')} AS raw,
           {r6('delta_ppm')} AS predicted, n_used FROM shift_table
    UNION ALL
    SELECT ensemble_id, 'coupling', i, j, {r6('j_avg')}, {r6('j_predicted')}, n_used FROM coupling_table"""))
def both_tables(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    shift, pair = nmr.nmr_tables(
        weights(given), given.shieldings(), given.couplings(), nmr.calibration_table(spark)
    )
    return shift.select(
        "ensemble_id", F.lit("shift").alias("kind"), F.col("atom_index").alias("i"), F.lit(None).cast("int").alias("j"),
        F.round("sigma_avg_ppm", 6).alias("raw"), F.round("delta_ppm", 6).alias("predicted"), "n_used",
    ).unionByName(pair.select(
        "ensemble_id", F.lit("coupling").alias("kind"), "i", "j",
        F.round("j_avg_hz", 6).alias("raw"), F.round("j_predicted_hz", 6).alias("predicted"), "n_used",
    ))
