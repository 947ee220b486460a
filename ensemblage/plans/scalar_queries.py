"""Queries on lenient parsing, canonical names and written tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K, scalars
from ensemblage.operators import logs, nmr, screen, sinks, thermo
from ensemblage.operators.groups import plan_groups
from ensemblage.plans import nmr_queries
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.session import cut_lineage
from ensemblage.plans.oracle import r6, with_ctes
from ensemblage.plans.source_queries import CTES as SOURCE_CTES, log_values
from ensemblage.plans.screen_queries import screened, sql as screen_sql

KEY = "o_orderkey"


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int | float) else "'" + str(value).replace("'", "''") + "'"


def of_order(values: Sequence[object], kind: str = "VARCHAR") -> str:
    """SQL: each order takes the next value in turn."""
    return f"([{', '.join(map(sql_literal, values))}]::{kind}[])[o_orderkey % {len(values)} + 1]"


def word_of_order(words: Sequence[str | None]) -> Column:
    listed = F.array(*[F.lit(w).cast("string") for w in words])
    return F.element_at(listed, (F.col(KEY) % len(words) + 1).cast("int"))


def words_query(name: str, function: Callable[[Column], Column], cases: Sequence[tuple], kind: str = "VARCHAR") -> None:
    """A query that applies ``function`` to one word per order."""
    words = [c[0] for c in cases]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return Given(spark, folder).table("orders").select(KEY, function(word_of_order(words)).alias("value"))

    register(name, f"SELECT o_orderkey, {of_order([c[1] for c in cases], kind)} AS value FROM orders")(query)


words_query("fn_smd_solvent", scalars.smd_solvent, [
    (" DCM ", "CH2Cl2"), ("chloroform", "CHCl3"), ("H2O", "water"), ("n-Hexane", "hexane"), (" ionic liquid ", "ionic liquid"),
    ("", None), (None, None)])
words_query("fn_alpb_solvent", scalars.alpb_solvent, [
    (" Water", "water"), ("CH2Cl2", "ch2cl2"), ("vacuum", None), ("mecn", None), (None, None), ("woctanol", "woctanol")])
words_query("fn_alpb_problem", scalars.alpb_problem, [
    (" Water", None), ("vacuum", None), ("mecn", "unknown_alpb_solvent"), (None, None), ("gas", "unknown_alpb_solvent")])
words_query("fn_cpcm_solvent", scalars.cpcm_solvent, [
    ("H2O", "water"), ("DiethylEther", "ether"), ("dichloromethane", "ch2cl2"), ("gas", None), ("cs2", None), ("THF ", "thf")])
words_query("fn_cpcm_problem", scalars.cpcm_problem, [("gas", None), ("cs2", "unknown_cpcm_solvent"), ("h2o", None), ("", None)])
words_query("fn_theory_xtb", scalars.xtb_theory, [
    ("gfn2", "GFN2-XTB"), ("", "GFN2-XTB"), (None, "GFN2-XTB"), (" GFN1xtb ", "GFN1-XTB"), ("gff", "GFN-FF"), ("pm7", None)])
words_query("fn_theory_crest", scalars.crest_theory, [
    ("1", "GFN1-XTB"), ("gfn-ff (GFF)", "GFN-FF"), ("GFN2//GFNFF", "GFN2//GFN-FF"), (None, "GFN2-XTB"), ("b3lyp", None)])
words_query("fn_theory_goat", scalars.goat_theory, [
    ("gfn2", "XTB"), ("", "XTB"), ("R2SCAN3C", "r2SCAN-3c"), (" B3LYP D3 def2-SVP ", "B3LYP D3 def2-SVP"), ("B3LYP; rm", None)])
words_query("fn_opt_level", scalars.opt_level, [(None, "tight"), (" VeryTight", "verytight"), ("", "tight"), ("hard", None)])
words_query("fn_goat_mode", scalars.goat_mode, [(None, "regular"), ("Default", "regular"), (" QUICK ", "quick"), ("slow", None)])
words_query("fn_functional_alias", scalars.functional_keyword, [
    (" wp04", "B3LYP/G"), ("WB97X-D", "wB97X-D3"), ("mpw1pw91", "mPW1PW"), ("PBE0 ", "PBE0"), (None, "")])
words_query("fn_is_3c_composite", scalars.is_3c_composite, [
    ("! r2SCAN-3c TightOpt", True), ("xr2scan-3c", False), ("B97-3C", True), ("b97-3cx", False), (None, False), ("PBE0", False)], "BOOLEAN")
words_query("fn_operations", lambda w: F.array_join(scalars.operations(w), ","), [
    (None, "optimize"), ("Energy, OPT,opt", "optimize,sp_energy"), ('["hess","grad"]', "sp_gradient,sp_hessian"),
    ('{"SP Energy":true,"Geometry Optimization":true,"SP Hessian":false}', "optimize,sp_energy"), ("fly", None), (" ", "optimize")])
words_query("fn_metric", scalars.metric, [(None, "mix"), (" RMSD_pruning", "rmsd"), ("rotcorr", "rotcorr_rmsd"), ("auto", "mix"), ("l2", None)])
words_query("fn_clustering", scalars.clustering, [(None, "auto"), ("KMeans", "kmeans"), ("dbscan ", "dbscan"), ("ward", None)])
words_query("fn_n_clusters", scalars.n_clusters, [("auto", None), ("4", 4), (" 12 ", 12), ("0", None), ("-2", None), ("x", None)], "INTEGER")
words_query("fn_n_clusters_problem", scalars.n_clusters_problem, [
    ("auto", None), ("4", None), ("0", "bad_n_clusters"), ("-2", "bad_n_clusters"), ("x", "bad_n_clusters"), (None, None)])
words_query("fn_spin_by_two", scalars.spin_by_two, [("H", 1), ("n", 2), ("D", 2), ("Xe", 1), ("O", 1)], "INTEGER")
words_query("fn_config_key_ok", scalars.key_problem, [
    ("max_k", None), (" k", "whitespace_in_key"), ("  ", "empty_key"), ("9k", "invalid_key"), (None, "missing_key"), ("a-b", None)])
words_query("fn_kv_problem", lambda w: scalars.config_problem(F.split(w, ";")), [
    ("a=1;b=2", None), ("a", "no_equals_sign"), ("=1", "empty_key"), ("a.b=1", "bad_key"), ("[1]", "json_array"), ("{x}", "bad_json"),
    ('{"a":1}', None)])


@register("fn_kv_config", """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'charge=' || o_orderkey || ',solvent=x=y' WHEN 1 THEN 'k=' || o_orderkey
                                          ELSE NULL END AS config
    FROM orders""")
def kv_config(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col(KEY)
    text = (
        F.when(key % 3 == 0, F.format_string(" charge = 0;solvent= x=y;charge=%d", key))
        .when(key % 3 == 1, F.format_string('{"k": "%d"}', key)).otherwise("no equals sign")
    )
    entries = F.map_entries(scalars.config_map(F.split(text, ";")))
    shown = F.array_sort(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return Given(spark, folder).table("orders").select(KEY, F.array_join(shown, ",").alias("config"))


SETTING = """
    SELECT o_orderkey, o_orderpriority AS kind, o_orderkey % 2 = 0 AS even, CASE o_orderpriority
               WHEN '1-URGENT' THEN o_orderkey::VARCHAR WHEN '2-HIGH' THEN printf('%.2f', o_totalprice)
               WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'off' END
               WHEN '5-LOW' THEN 'x y' END AS word, o_totalprice
    FROM orders"""


def setting_query(name: str, expected: str, function: Callable[[Column], Column]) -> None:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return Given(spark, folder).settings().select(KEY, function(F.col("text")).alias("value"))

    register(name, with_ctes(f"SELECT o_orderkey, {expected} AS value FROM setting", {"setting": SETTING}))(query)


setting_query("fn_parse_int", "CASE kind WHEN '1-URGENT' THEN o_orderkey ELSE -1 END::INTEGER", lambda t: scalars.parse_int(t, -1))
setting_query("fn_parse_float", "CASE kind WHEN '1-URGENT' THEN o_orderkey WHEN '2-HIGH' THEN o_totalprice ELSE 0.5 END::DOUBLE",
              lambda t: scalars.parse_float(t, 0.5))
setting_query("fn_parse_bool", "CASE WHEN word = 'Yes' OR word = '1' THEN true ELSE false END", lambda t: scalars.parse_bool(t, False))
setting_query("fn_tri", "CASE WHEN word IN ('Yes', '1') THEN 'true' WHEN word IN ('off', '0') THEN 'false' ELSE 'auto' END",
              lambda t: scalars.tri_state(t))
setting_query("fn_opt_int", "CASE kind WHEN '1-URGENT' THEN o_orderkey END::INTEGER", scalars.optional_int)
setting_query("fn_opt_str", "word", scalars.optional_text)


@register("fn_multiplicity", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 5 ELSE o_orderkey % 3 + 1 END AS value FROM orders""")
def multiplicity(spark: SparkSession, folder: str) -> DataFrame:
    explicit = F.when(F.col("o_orderstatus") == "F", F.col(KEY) % 5)
    return Given(spark, folder).table("orders").select(KEY, scalars.multiplicity(explicit, F.col(KEY) % 3).alias("value"))


def renumbered(before: str) -> str:
    return f"""
        SELECT page_id, CASE WHEN k = 1 THEN name ELSE name || '_' || k END AS name
        FROM (SELECT page_id, name, row_number() OVER (PARTITION BY name ORDER BY page_id) AS k FROM {before})"""


@register("fn_safe_name", with_ctes("SELECT page_id, name AS file_stem FROM again", {
    "stems": r"""
        SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(split_part(url, '?', 1), '[^A-Za-z0-9._-]+', '_', 'g'),
               '_+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'molecule') AS name FROM pages""",
    "first": renumbered("stems"), "second": renumbered("first"), "again": renumbered("second")}))
def safe_names(spark: SparkSession, folder: str) -> DataFrame:
    stems = Given(spark, folder).table("pages").select(
        "page_id", scalars.safe_name(F.get(F.split("url", r"\?"), F.lit(0))).alias("name"))
    return unique_names(stems, "page_id").withColumnRenamed("name", "file_stem")


def unique_names(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``_2``, ``_3`` and so on behind every ``name`` that is taken, numbered again until none is given twice."""
    while True:
        plan = plan_groups(rows, ("name",))
        numbered = cut_lineage(plan.apply(rows, lambda d, g: g.ordinal(d, "k", [F.col(order)])), "names")
        rows = numbered.withColumn("name", F.when(F.col("k") == 1, F.col("name")).otherwise(F.concat_ws("_", "name", "k"))).drop("k")
        if numbered.where("k > 1").isEmpty():
            return rows


@register("fn_stable_id", "SELECT page_id, ('0x' || substr(sha1(url), 1, 7))::BIGINT AS id FROM pages")
def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    return Given(spark, folder).table("pages").select("page_id", scalars.stable_id(F.col("url")).alias("id"))


@register("set_ordered_dedupe", """
    SELECT doc_id, md5(string_agg(w, ' ' ORDER BY place)) AS digest, count(*) AS n_words
    FROM (SELECT doc_id, w, min(place) AS place FROM
          (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS place
           FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)) GROUP BY doc_id, w)
    GROUP BY doc_id""")
def ordered_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array_distinct(F.split("text", " "))
    return Given(spark, folder).table("documents").select(
        "doc_id", F.md5(F.encode(F.array_join(words, " "), "UTF-8")).alias("digest"), F.size(words).cast("bigint").alias("n_words"))


CONFIG_CASES = {
    "solvent": (scalars.cpcm_solvent, ["H2O", "gas", "cs2", None], ["water", None, None, None]),
    "theory": (scalars.crest_theory, ["gfn1", "", "b3lyp"], ["GFN1-XTB", "GFN2-XTB", None]),
    "calculations": (lambda w: F.array_join(scalars.operations(w), ","), ["opt", "fly", "hess,opt", "", "sp"],
                     ["optimize", None, "optimize,sp_hessian", "optimize", "sp_energy"]),
    "metric": (scalars.metric, ["moi", "l2", None, "rotcorr", "auto", "", "rmsd"], ["moi", None, "mix", "rotcorr_rmsd", "mix", "mix", "rmsd"]),
}


@register("job_normalise_configs", f"""
    SELECT o_orderkey, {", ".join(f"{of_order(case[2])} AS {name}" for name, case in CONFIG_CASES.items())},
           concat_ws(',', CASE WHEN o_orderkey % 4 = 2 THEN 'solvent' END, CASE WHEN o_orderkey % 3 = 2 THEN 'theory' END,
                     CASE WHEN o_orderkey % 5 = 1 THEN 'calculations' END, CASE WHEN o_orderkey % 7 = 1 THEN 'metric' END) AS problems
    FROM orders""")
def configs(spark: SparkSession, folder: str) -> DataFrame:
    raw = Given(spark, folder).table("orders").select(KEY, *[word_of_order(c[1]).alias(n) for n, c in CONFIG_CASES.items()])
    return normalise_configs(raw, KEY)


def normalise_configs(raw: DataFrame, key: str) -> DataFrame:
    """Raw run settings to canonical ones, with the names of the settings that were refused."""
    values = {name: case[0](F.col(name)) for name, case in CONFIG_CASES.items()}
    refused = [F.when(scalars.cpcm_problem(F.col("solvent")).isNotNull(), "solvent")]
    refused += [F.when(values[name].isNull(), name) for name in ("theory", "calculations", "metric")]
    return raw.select(key, *[v.alias(n) for n, v in values.items()], F.concat_ws(",", *refused).alias("problems"))


# written tables

@register("sink_thermo_table", with_ctes(f"""
    SELECT ensemble_id, task_idx AS "index", printf('/runs/%d/task_%04d', ensemble_id, task_idx) AS task_dir, thermo_out, sp_out,
           {r6('e_sp')} AS E_high_eh, {r6('g_minus')} AS G_minus_Eel_low_eh, {r6('g_full')} AS G_low_eh, {r6('g')} AS G_composite_eh,
           {r6('dg')} AS deltaG_kcal, {r6('w')} AS boltzmann_weight, {r6('w * 100.0')} AS boltzmann_percent, {r6('cum')} AS cumulative_weight,
           {r6('cum * 100.0')} AS cumulative_percent, '1atm' AS standard_state, 0.0::DOUBLE AS std_state_corr_kcal,
           298.15::DOUBLE AS temperature_k_used, t AS T_low_k_parsed, {r6('h')} AS H_low_eh, {r6('ts')} AS TS_corr_low_eh
    FROM (SELECT *, CASE WHEN w IS NOT NULL THEN sum(w) OVER (PARTITION BY ensemble_id, w IS NULL ORDER BY dg, task_idx
                                                             ROWS UNBOUNDED PRECEDING) END AS cum
          FROM (SELECT *, CASE WHEN dg IS NOT NULL THEN e / sum(e) OVER (PARTITION BY ensemble_id) END AS w
                FROM (SELECT *, exp(-dg / ({K.R_KCAL_PER_MOL_K}::DOUBLE * {K.ROOM_TEMPERATURE_K}::DOUBLE)) AS e
                      FROM (SELECT *, (g - min(g) OVER (PARTITION BY ensemble_id)) * {K.HARTREE_TO_KCAL}::DOUBLE AS dg
                            FROM (SELECT *, coalesce(e_sp + g_minus, g_full) AS g FROM roster LEFT JOIN picked USING (ensemble_id, task_idx))))))""", {**SOURCE_CTES, "roster": "SELECT o_custkey AS ensemble_id, (o_orderkey + 1)::INTEGER AS task_idx FROM orders"}))
def thermo_sink(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    plan = plan_groups(given.thermo_in(), thermo.ENSEMBLE)
    roster = given.table("orders").select(F.col("o_custkey").alias("ensemble_id"), (F.col(KEY) + 1).cast("int").alias("task_idx"))
    picks = logs.over_roster(roster, logs.pick_outputs(log_values(given))).withColumns({
        "conf_idx": F.col("task_idx"), "task_dir": F.format_string("/runs/%d/task_%04d", "ensemble_id", "task_idx")})
    table = sinks.thermo_table(thermo.populations(picks, plan=plan), "1atm", K.ROOM_TEMPERATURE_K)
    measures = [n for n, t in table.dtypes if t == "double" and n not in ("std_state_corr_kcal", "temperature_k_used", "T_low_k_parsed")]
    return table.withColumns({m: F.round(m, 6) for m in measures})


@register("sink_shifts_table", with_ctes(f"""
    SELECT ensemble_id, atom_index, element, {r6('sigma_avg')} AS sigma_iso_avg_ppm, {r6('delta_ppm')} AS delta_predicted_ppm,
           cal_source AS calibration_source, cal_method AS calibration_method, cal_basis AS calibration_basis,
           cal_solvent AS calibration_solvent, n_used AS n_conformers_used FROM shift_table"""))
def shifts_sink(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_shieldings(given.shieldings(), nmr_queries.weights(given))
    table = sinks.shifts_table(nmr.predict_shifts(means, nmr.calibration_table(spark)))
    return nmr_queries.rounded(table, "sigma_iso_avg_ppm", "delta_predicted_ppm")


@register("sink_couplings_table", with_ctes(f"""
    SELECT ensemble_id, i, elem_i, j, elem_j, {r6('j_avg')} AS J_total_avg_hz, {r6('j_predicted')} AS J_predicted_hz,
           cal_source AS calibration_source, cal_method AS calibration_method, cal_basis AS calibration_basis,
           cal_solvent AS calibration_solvent, n_used AS n_conformers_used FROM coupling_table"""))
def couplings_sink(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    means = nmr.average_couplings(given.couplings(), nmr_queries.weights(given))
    table = sinks.couplings_table(nmr.predict_couplings(means, nmr.calibration_table(spark)))
    return nmr_queries.rounded(table, "J_total_avg_hz", "J_predicted_hz")


@register("sink_energy_table", with_ctes(f"""
    SELECT ensemble_id, conf_idx, CASE WHEN e_high_eh IS NULL THEN printf('%6d   NaN   NaN', conf_idx)
           ELSE printf('%6d   % .12f   % .6f', conf_idx, e_high_eh, rel) END AS line
    FROM (SELECT *, (e_high_eh - min(e_high_eh) OVER (PARTITION BY ensemble_id)) * {K.HARTREE_TO_KCAL}::DOUBLE AS rel FROM thermo_in)"""))
def energy_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in()
    plan = plan_groups(rows, screen.ENSEMBLE)
    rows = plan.apply(rows, lambda d, g: screen.relative_hartree(d, g, "e_high_eh"))
    line = sinks.energy_line(F.col("conf_idx"), F.col("e_high_eh"), F.col("rel_energy_kcal"))
    return rows.select("ensemble_id", "conf_idx", line.alias("line"))


@register("sink_accepted_energies", screen_sql("""
    SELECT ensemble_id, conf_idx, printf('%6d  % .6f', conf_idx, rel) AS line FROM geo_screen WHERE rel IS NOT NULL"""))
def accepted_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = screened(Given(spark, folder)).where(F.col("rel_energy_kcal").isNotNull())
    return rows.select("ensemble_id", "conf_idx", sinks.relative_line(F.col("conf_idx"), F.col("rel_energy_kcal")).alias("line"))


@register("sink_ensemble_text", """
    SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx, printf(E'1\\n%.2f\\nH 0 0 0\\n', o_totalprice) AS text FROM orders""")
def frames_sink(spark: SparkSession, folder: str) -> DataFrame:
    text = F.format_string("1\n%.2f\nH 0 0 0", "o_totalprice")
    ending = F.when(F.col("o_orderstatus") == "F", "\n").otherwise("")
    return sinks.ensemble_frames(Given(spark, folder).table("orders").select(
        F.col("o_custkey").alias("ensemble_id"), (F.col(KEY) + 1).alias("conf_idx"), F.concat(text, ending).alias("text")))


@register("sink_summary_json", with_ctes("""
    SELECT ensemble_id, '{"n_conformers":' || count(*) || ',"n_with_G":' || count(g) || coalesce(',"Gmin_eh":' || round(min(g), 6), '') ||
           ',"temperature_k":298.15,"standard_state":"1atm","std_state_corr_kcal":0.0}' AS summary
    FROM gibbs GROUP BY ensemble_id"""))
def summary_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in().withColumn("g_composite_eh", thermo.composite_gibbs())
    # the summary has all digits; six places are for the comparison
    return sinks.thermo_summary(rows.withColumn("g_composite_eh", scalars.rounded(F.col("g_composite_eh"), 6)), "1atm", K.ROOM_TEMPERATURE_K)
