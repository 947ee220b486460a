"""Queries on equivalence groups, array-job progress and their streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.operators import equivalence, monitor, nmr
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes
from ensemblage.session import cut_lineage
from ensemblage.sources import files
from ensemblage.streaming import progress as streams

CTES = {
    "mol": """
        SELECT l_orderkey AS ensemble_id, l_linenumber AS atom_index,
               min(CASE l_returnflag WHEN 'A' THEN 'H' WHEN 'N' THEN 'C' ELSE 'O' END) AS element,
               min(l_linestatus) AS class_id, min(CASE WHEN l_tax < 0.08 THEN l_discount END) AS ppm
        FROM lineitem GROUP BY ALL""",
    "mol_bonds": """
        SELECT DISTINCT l_orderkey AS ensemble_id, a, b FROM
        (SELECT l_orderkey, l_linenumber AS a, (l_linenumber + l_quantity::INTEGER) % 7 + 1 AS b FROM lineitem
         UNION ALL SELECT l_orderkey, (l_linenumber + l_quantity::INTEGER) % 7 + 1, l_linenumber FROM lineitem) WHERE a <> b""",
    "mol_edges": """
        SELECT l_orderkey AS ensemble_id, least(a, b) AS i, greatest(a, b) AS j, min(l_tax * 10.0::DOUBLE) AS hz FROM
        (SELECT *, l_linenumber AS a, ((l_linenumber + l_quantity::INTEGER) % 7 + 1)::INTEGER AS b FROM lineitem)
        WHERE a <> b GROUP BY ALL""",
    "mol_both": """
        SELECT ensemble_id, i AS a, j AS b, hz FROM mol_edges UNION ALL SELECT ensemble_id, j, i, hz FROM mol_edges""",
    "mol_spread": """
        SELECT *, coalesce(max(ppm) OVER c - min(ppm) OVER c > 0.05, false) AS apart, min(atom_index) OVER c AS head,
               avg(ppm) OVER c AS mean_ppm, count(*) OVER c AS n
        FROM mol WINDOW c AS (PARTITION BY ensemble_id, element, class_id)""",
    "mol_refined": """
        SELECT *, CASE WHEN apart THEN atom_index ELSE head END AS cls, CASE WHEN apart THEN 1 ELSE n END AS class_size,
               CASE WHEN apart THEN ppm ELSE mean_ppm END AS class_ppm
        FROM mol_spread""",
    "mol_mismatch": """
        SELECT DISTINCT m.ensemble_id, m.element, m.cls
        FROM mol_refined m JOIN mol_refined o ON m.ensemble_id = o.ensemble_id AND m.element = o.element AND m.cls <> o.cls
        LEFT JOIN mol_both x ON x.ensemble_id = m.ensemble_id AND x.a = m.atom_index AND x.b = o.atom_index
        LEFT JOIN mol_both r ON r.ensemble_id = m.ensemble_id AND r.a = m.cls AND r.b = o.atom_index
        WHERE m.class_size > 1 AND ((x.hz IS NULL) <> (r.hz IS NULL) OR abs(x.hz - r.hz) > 0.5)""",
    "mol_tiers": """
        SELECT m.*, CASE WHEN class_size = 1 THEN 'none' WHEN q.cls IS NULL THEN 'hard' ELSE 'soft' END AS tier
        FROM mol_refined m LEFT JOIN mol_mismatch q USING (ensemble_id, element, cls)""",
    "mol_labels": """
        SELECT *, chr((64 + dense_rank() OVER (PARTITION BY ensemble_id, element ORDER BY first_atom))::INTEGER) AS label,
               CASE tier WHEN 'none' THEN ppm ELSE class_ppm END AS shown_ppm
        FROM (SELECT *, CASE tier WHEN 'hard' THEN cls ELSE atom_index END AS first_atom FROM mol_tiers)""",
    "states": """
        SELECT user_id AS job_id, (event_id % 8 + 1)::INTEGER AS task_idx,
               max(CASE event_type WHEN 'purchase' THEN 3 WHEN 'error' THEN 2 WHEN 'click' THEN 0 ELSE 1 END)::INTEGER AS state
        FROM events GROUP BY ALL""",
    "job_progress": """
        SELECT job_id, 9 AS total, count(*) AS started, count(*) FILTER (state = 3) AS success,
               count(*) FILTER (state = 2) AS failed, count(*) FILTER (state >= 2) AS processed,
               count(*) FILTER (state < 2) AS in_progress, 9 - count(*) FILTER (state >= 2) AS "left"
        FROM states GROUP BY job_id""",
    **{
        f"colour{k}": f"""
            SELECT m.ensemble_id, m.atom_index, any_value(m.element) AS element,
                   md5(any_value(m.colour) || '|' || coalesce(string_agg(n.colour, ',' ORDER BY n.colour), '')) AS colour
            FROM {f'colour{k - 1}' if k > 1 else "(SELECT *, element AS colour FROM mol)"} m
            LEFT JOIN mol_bonds b ON b.ensemble_id = m.ensemble_id AND b.a = m.atom_index
            LEFT JOIN {f'colour{k - 1}' if k > 1 else "(SELECT *, element AS colour FROM mol)"} n
              ON n.ensemble_id = m.ensemble_id AND n.atom_index = b.b
            GROUP BY m.ensemble_id, m.atom_index"""
        for k in range(1, 8)
    },
}


def sql(body: str) -> str:
    return with_ctes(body, CTES)


def members(given: Given) -> DataFrame:
    return equivalence.equivalence(given.atoms(), given.j_edges())


@register("eqv_topological_classes", sql("""
    SELECT ensemble_id, atom_index, element, min(atom_index) OVER (PARTITION BY ensemble_id, colour) AS class_id FROM colour7"""))
def classes(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return equivalence.topological_classes(given.atoms(), given.bonds())


@register("eqv_symmetry_classes")
def orbits(spark: SparkSession, folder: str) -> DataFrame:
    """Classes by the symmetries of each molecule's graph, which neighbourhoods alone may miss."""
    given = Given(spark, folder)
    return equivalence.symmetry_classes(given.atoms(), given.bonds(), whole=True)


@register("eqv_shift_refine", sql(f"""
    SELECT ensemble_id, atom_index, element, cls, class_size, {r6('class_ppm')} AS class_ppm FROM mol_refined"""))
def refined(spark: SparkSession, folder: str) -> DataFrame:
    rows = equivalence.refine_by_shift(Given(spark, folder).atoms())
    return rows.select("ensemble_id", "atom_index", "element", "cls", "class_size", F.round("class_ppm", 6).alias("class_ppm"))


@register("eqv_magnetic_test", sql("""
    SELECT ensemble_id, element, cls, q.cls IS NULL AS magnetic
    FROM (SELECT DISTINCT ensemble_id, element, cls FROM mol_refined WHERE class_size > 1) m
    LEFT JOIN mol_mismatch q USING (ensemble_id, element, cls)"""))
def magnetic(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    rows = equivalence.refine_by_shift(given.atoms())
    several = rows.where("class_size > 1").select(*equivalence.CLASS).distinct()
    tested = several.join(equivalence.magnetic_test(rows, given.j_edges()), equivalence.CLASS, "left")
    return tested.fillna(True, ["magnetic"])


@register("eqv_tier", sql("SELECT ensemble_id, atom_index, tier FROM mol_tiers"))
def tier(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    rows = cut_lineage(equivalence.refine_by_shift(given.atoms()), "refined")  # read three times
    return equivalence.tiers(rows, equivalence.magnetic_test(rows, given.j_edges())).select("ensemble_id", "atom_index", "tier")


@register("eqv_labels", sql("SELECT ensemble_id, element, atom_index, label FROM mol_labels"))
def labels(spark: SparkSession, folder: str) -> DataFrame:
    return members(Given(spark, folder)).select("ensemble_id", "element", "atom_index", "label")


@register("eqv_groups", sql(f"""
    SELECT ensemble_id, element, label, tier, count(*) AS n_atoms, {r6('max(shown_ppm)')} AS shift_ppm, 1 AS spin_by_two
    FROM mol_labels GROUP BY ensemble_id, element, label, tier HAVING max(shown_ppm) IS NOT NULL"""))
def groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = equivalence.groups(members(Given(spark, folder)))
    return rows.drop("first_atom").withColumn("shift_ppm", F.round("shift_ppm", 6))


GROUP_PAIRS = sql(f"""
    SELECT x.ensemble_id, a.element, a.label, b.label AS other_label, {r6('avg(hz)')} AS j_hz
    FROM mol_both x JOIN mol_labels a ON a.ensemble_id = x.ensemble_id AND a.atom_index = x.a
    JOIN mol_labels b ON b.ensemble_id = x.ensemble_id AND b.atom_index = x.b
    WHERE a.element = b.element AND a.label <> b.label AND a.shown_ppm IS NOT NULL
    GROUP BY x.ensemble_id, a.element, a.label, b.label""")


@register("eqv_group_couplings", GROUP_PAIRS)
def group_couplings(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    rows = equivalence.group_couplings(members(given), given.j_edges())
    return rows.withColumn("j_hz", F.round("j_hz", 6))


@register("join_group_pairs", sql("""
    SELECT x.ensemble_id, x.a, x.b, a.element, a.cls AS cls_a, b.cls AS cls_b
    FROM mol_both x JOIN mol_refined a ON a.ensemble_id = x.ensemble_id AND a.atom_index = x.a
    JOIN mol_refined b ON b.ensemble_id = x.ensemble_id AND b.atom_index = x.b WHERE a.element = b.element"""))
def group_pairs(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    joined = equivalence.edges_between(given.j_edges(), equivalence.refine_by_shift(given.atoms()), "cls")
    return joined.select("ensemble_id", "a", "b", "element", "cls_a", "cls_b")


@register("agg_mean_non_null", sql(f"SELECT ensemble_id, element, {r6('avg(ppm)')} AS mean_ppm FROM mol GROUP BY ensemble_id, element"))
def mean_known(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).atoms().groupBy("ensemble_id", "element").agg(F.avg("ppm").alias("mean_ppm"))
    return rows.withColumn("mean_ppm", F.round("mean_ppm", 6))


@register("agg_progress", sql("SELECT * FROM job_progress"))
def progress(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return monitor.progress(monitor.task_states(given.task_events()), given.job_sizes())


@register("str_task_state", sql("SELECT * FROM states"))
def stream_states(spark: SparkSession, folder: str) -> DataFrame:
    return streams.stream_task_states(Given(spark, folder).task_event_stream())


@register("str_progress", sql("SELECT * FROM job_progress"))
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return streams.stream_progress(given.task_event_stream(), given.job_sizes())


@register("str_timeout", sql("""
    SELECT job_id, "left", now > first_ts + INTERVAL 14400 MINUTE AND "left" > 0 AS timed_out
    FROM (SELECT user_id AS job_id, min(ts) AS first_ts, (SELECT max(ts) FROM events) AS now FROM events GROUP BY user_id)
    JOIN job_progress USING (job_id)"""))
def stream_timeouts(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return streams.stream_timeouts(given.task_event_stream(), given.job_sizes(), 14400)


@register("str_progress_windows", """
    SELECT user_id AS job_id, date_trunc('day', ts)::VARCHAR AS window_start,
           CASE event_type WHEN 'purchase' THEN 'done_success' WHEN 'error' THEN 'done_failed' WHEN 'click' THEN 'orca_opt.out'
                ELSE 'started' END AS signal, count(*) AS n
    FROM events GROUP BY ALL""")
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = streams.stream_windows(Given(spark, folder).task_event_stream())
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@register("join_sacct_failures", """
    SELECT job_id, task_idx, state, exit_code, 'array_task_not_completed' AS error
    FROM (SELECT user_id AS job_id, (event_id % 8 + 1)::INTEGER AS task_idx,
                 arg_max(CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'CANCELLED by 0' ELSE '-' END, event_id) AS raw_state,
                 nullif(raw_state, '-') AS state,
                 nullif(arg_max(CASE event_type WHEN 'error' THEN '1:0' WHEN 'click' THEN '-' ELSE '0:0' END, event_id), '-') AS exit_code
          FROM events WHERE event_type <> 'signup' GROUP BY 1, 2)
    WHERE NOT coalesce(state = 'COMPLETED' AND exit_code = '0:0', false)""")
def accounting_failures(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    roster = files.task_roster(given.job_sizes().withColumnRenamed("job_id", "ensemble_id"))
    roster = roster.withColumnRenamed("ensemble_id", "job_id")
    return monitor.accounting_failures(roster, files.accounting_states(given.accounting_lines()))


@register("agg_failures_by_code", with_ctes("""
    SELECT step, error, count(*) AS n FROM (
        SELECT 'thermo' AS step, 'missing_thermochem_or_energy_for_G' AS error FROM gibbs WHERE g IS NULL
        UNION ALL SELECT 'screen', 'no_energy' FROM conformers WHERE energy_kcal IS NULL
        UNION ALL SELECT 'screen', 'no_geometry' FROM conformers WHERE conf_idx NOT IN (SELECT l_orderkey + 1 FROM lineitem))
    GROUP BY ROLLUP (step, error)"""))
def failure_counts(spark: SparkSession, folder: str) -> DataFrame:
    from ensemblage.operators import thermo

    given = Given(spark, folder)
    conformers = given.conformers()
    lacking = conformers.join(given.shieldings(), ["ensemble_id", "conf_idx"], "left_anti")
    parts = [
        thermo.thermo_failures(given.thermo_in()).select(F.lit("thermo").alias("step"), "error"),
        conformers.where("energy_kcal IS NULL").select(F.lit("screen").alias("step"), F.lit("no_energy").alias("error")),
        lacking.select(F.lit("screen").alias("step"), F.lit("no_geometry").alias("error")),
    ]
    return monitor.failures_by_code(parts[0].unionByName(parts[1]).unionByName(parts[2]))
