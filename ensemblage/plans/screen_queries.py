"""Queries on energy windows, masks, clusters and the best conformer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators import screen
from ensemblage.operators.groups import plan_groups
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes

MEMBER = screen.MEMBER
OVER = "OVER (PARTITION BY ensemble_id)"

SCREEN_CTES = {
    "masked": """
        SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx, o_orderpriority <> '5-LOW' AS kept
        FROM orders""",
    "geo": f"""
        SELECT c.*, count(*) {OVER} AS n_input, CASE WHEN count(*) {OVER} >= 3 THEN kept ELSE true END AS kept
        FROM conformers_all c JOIN masked USING (ensemble_id, conf_idx)""",
    "geo_window": f"""
        SELECT *, coalesce(CASE WHEN kept THEN energy_kcal END - min(CASE WHEN kept THEN energy_kcal END) {OVER} <= 2.0,
                           true) AS inside FROM geo""",
    "geo_screen": f"""
        SELECT *, kept AND inside AS accepted,
               CASE WHEN NOT kept THEN '{K.REASON_PRUNED}' WHEN NOT inside THEN '{K.REASON_WINDOW}' END AS reason,
               CASE WHEN kept AND inside THEN energy_kcal - min(CASE WHEN kept AND inside THEN energy_kcal END) {OVER} END
                   AS rel
        FROM geo_window""",
    "clu_window": f"""
        SELECT *, energy_kcal - min(energy_kcal) {OVER} <= 3.0 AS inside,
               conf_idx % 4 AS label, abs(energy_kcal - 2.5) AS distance
        FROM conformers_all""",
    "clu_sized": f"SELECT *, count(*) FILTER (inside) {OVER} >= 3 AS screened FROM clu_window",
    "clu_centre": """
        SELECT ensemble_id, label, arg_min(conf_idx, (distance, energy_kcal, conf_idx)) AS centre,
               row_number() OVER (PARTITION BY ensemble_id ORDER BY label) - 1 AS dense
        FROM clu_sized WHERE inside AND screened GROUP BY ensemble_id, label""",
    "clu_joined": """
        SELECT m.*, centre, dense, inside AND (NOT screened OR conf_idx = centre) AS accepted,
               row_number() OVER (PARTITION BY m.ensemble_id, inside ORDER BY conf_idx) - 1 AS lone
        FROM clu_sized m LEFT JOIN clu_centre c
          ON m.ensemble_id = c.ensemble_id AND m.label = c.label AND inside AND screened""",
    "clu_screen": f"""
        SELECT ensemble_id, conf_idx, energy_kcal, accepted,
               CASE WHEN NOT inside THEN '{K.REASON_WINDOW}' WHEN NOT accepted THEN '{K.REASON_CLUSTER}' END AS reason,
               CASE WHEN accepted THEN energy_kcal - min(CASE WHEN accepted THEN energy_kcal END) {OVER} END AS rel,
               CASE WHEN inside THEN CASE WHEN screened THEN dense ELSE lone END END::INTEGER AS cluster_id,
               CASE WHEN inside THEN CASE WHEN screened AND NOT accepted THEN distance ELSE 0.0 END END AS cluster_distance
        FROM clu_joined""",
}


def sql(body: str) -> str:
    return with_ctes(body, SCREEN_CTES)


def mask(given: Given) -> DataFrame:
    return given.table("orders").select(
        F.col("o_custkey").alias("ensemble_id"), (F.col("o_orderkey") + 1).alias("conf_idx"),
        (F.col("o_orderpriority") != "5-LOW").alias("accepted"),
    )


def screened(given: Given, **options) -> DataFrame:
    return screen.geometric_screen(given.conformers(all_energies=True), mask(given), 2.0, **options)


def clustered(given: Given) -> DataFrame:
    rows = given.conformers(all_energies=True)
    labels = rows.select(
        *MEMBER, (F.col("conf_idx") % 4).alias("label"), F.abs(F.col("energy_kcal") - 2.5).alias("distance")
    )
    return screen.cluster_screen(rows, labels, 3.0)


@register("flt_energy_window", sql(f"""
    SELECT ensemble_id, conf_idx FROM
    (SELECT *, coalesce(energy_kcal - min(energy_kcal) {OVER} <= 2.0, true) AS inside FROM conformers) WHERE inside"""))
def window(spark: SparkSession, folder: str) -> DataFrame:
    return screen.energy_window(Given(spark, folder).conformers(), 2.0).where("in_window").select(*MEMBER)


@register("flt_energy_window_post", sql("SELECT ensemble_id, conf_idx, kept, inside FROM geo_window"))
def window_post(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    plan = plan_groups(given.conformers(), screen.ENSEMBLE)
    joined = given.conformers(all_energies=True).join(mask(given), MEMBER)

    def chain(rows: DataFrame, groups: screen.Groups) -> DataFrame:
        rows = screen.bypass_small(rows, groups)
        rows = rows.withColumn("kept", ~F.col("screened") | F.col("accepted"))
        return screen.within_window(rows, groups, 2.0, F.col("kept"))

    return plan.apply(joined, chain).select(*MEMBER, "kept", F.col("in_window").alias("inside"))


@register("flt_energy_window_pre", sql("SELECT ensemble_id, conf_idx FROM clu_window WHERE inside"))
def window_pre(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).conformers(all_energies=True)
    return screen.energy_window(rows, 3.0).where("in_window").select(*MEMBER)


@register("prj_use_energies", sql(f"""
    SELECT ensemble_id, conf_idx, bool_and(energy_kcal IS NOT NULL) {OVER} AS use_energies FROM conformers"""))
def use_energies(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).conformers()
    plan = plan_groups(rows, screen.ENSEMBLE)
    return plan.apply(rows, screen.decide_use_energies).select(*MEMBER, "use_energies")


@register("prj_use_energies_required", sql("""
    SELECT ensemble_id, count(energy_kcal) AS n_with_energy, count(*) AS n_input,
           'use_energies_required_but_unavailable' AS error
    FROM conformers GROUP BY ensemble_id HAVING count(energy_kcal) < count(*)"""))
def required(spark: SparkSession, folder: str) -> DataFrame:
    return screen.energies_required(Given(spark, folder).conformers())


@register("prj_min_size_bypass", sql(f"""
    SELECT ensemble_id, conf_idx, count(*) {OVER} AS n_input, count(*) {OVER} >= 8 AS screened FROM conformers"""))
def bypass(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).conformers()
    plan = plan_groups(rows, screen.ENSEMBLE)
    return plan.apply(rows, lambda d, g: screen.bypass_small(d, g, 8)).select(*MEMBER, "n_input", "screened")


@register("prj_relative_energy", sql(f"SELECT ensemble_id, conf_idx, {r6('rel')} AS rel_energy_kcal FROM geo_screen"))
def relative(spark: SparkSession, folder: str) -> DataFrame:
    rows = screened(Given(spark, folder))
    return rows.select(*MEMBER, F.round("rel_energy_kcal", 6).alias("rel_energy_kcal"))


@register("prj_relative_hartree", sql(f"""
    SELECT ensemble_id, conf_idx, {r6(f'(e_high_eh - min(e_high_eh) {OVER}) * {K.HARTREE_TO_KCAL}::DOUBLE')} AS rel_energy_kcal
    FROM thermo_in"""))
def hartree(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in()
    plan = plan_groups(rows, screen.ENSEMBLE)
    rows = plan.apply(rows, lambda d, g: screen.relative_hartree(d, g, "e_high_eh"))
    return rows.select(*MEMBER, F.round("rel_energy_kcal", 6).alias("rel_energy_kcal"))


@register("prj_reject_reason", sql("SELECT ensemble_id, conf_idx, accepted, reason AS rejected_reason FROM geo_screen"))
def reasons(spark: SparkSession, folder: str) -> DataFrame:
    return screened(Given(spark, folder)).select(*MEMBER, "accepted", "rejected_reason")


@register("prj_keep_rejected", sql("SELECT ensemble_id, conf_idx FROM geo_screen WHERE accepted"))
def accepted_only(spark: SparkSession, folder: str) -> DataFrame:
    return screened(Given(spark, folder), keep_rejected=False).select(*MEMBER)


@register("scr_external_mask", sql("""
    SELECT ensemble_id, conf_idx, CASE WHEN bool_and(label IS NOT NULL) OVER (PARTITION BY ensemble_id) AND ensemble_id % 5 <> 0
                                  THEN label ELSE true END AS kept_by_mask
    FROM conformers c LEFT JOIN
      (SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx, o_orderstatus = 'F' AS label
       FROM orders WHERE o_totalprice < 450000) m USING (ensemble_id, conf_idx)"""))
def external(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    rows = given.conformers()
    supplied = given.table("orders").where("o_totalprice < 450000").select(
        F.col("o_custkey").alias("ensemble_id"), (F.col("o_orderkey") + 1).alias("conf_idx"),
        (F.col("o_orderstatus") == "F").alias("accepted"),
    )
    # every fifth ensemble's mask is too long: its rows come twice
    supplied = supplied.unionByName(supplied.where("ensemble_id % 5 = 0"))
    plan = plan_groups(rows, screen.ENSEMBLE)
    return plan.apply(rows, lambda d, g: screen.apply_mask(d, supplied, g)).select(*MEMBER, "kept_by_mask")


@register("scr_mask_failures", sql("""
    SELECT ensemble_id, count(*) AS n_input, count(*) FILTER (o_totalprice < 450000) AS n_mask,
           'pruning_returned_unexpected_mask_length' AS error
    FROM (SELECT o_custkey AS ensemble_id, * FROM orders) GROUP BY ensemble_id
    HAVING count(*) <> count(*) FILTER (o_totalprice < 450000) AND count(*) >= 3"""))
def mask_failures(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    return screen.mask_failures(given.conformers(), given.table("orders").where("o_totalprice < 450000").select(
        F.col("o_custkey").alias("ensemble_id")))


@register("scr_cluster_representatives", sql(f"""
    SELECT ensemble_id, conf_idx, accepted, reason AS rejected_reason, {r6('rel')} AS rel_energy_kcal, cluster_id,
           {r6('cluster_distance')} AS cluster_distance FROM clu_screen"""))
def representatives(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(Given(spark, folder)).select(
        *MEMBER, "accepted", "rejected_reason", F.round("rel_energy_kcal", 6).alias("rel_energy_kcal"), "cluster_id",
        F.round("cluster_distance", 6).alias("cluster_distance"),
    )


@register("agg_best_conformer", sql("""
    SELECT ensemble_id, arg_min(conf_idx, (rel, conf_idx)) AS conf_idx, 'lowest_rel_energy_kcal' AS best_chosen_by
    FROM geo_screen WHERE accepted GROUP BY ensemble_id"""))
def best(spark: SparkSession, folder: str) -> DataFrame:
    return screen.best_conformer(screened(Given(spark, folder)))


@register("agg_best_cluster_center", sql("""
    SELECT ensemble_id, arg_min(conf_idx, (cluster_id, conf_idx)) AS conf_idx, 'first_cluster_center' AS best_chosen_by
    FROM clu_screen WHERE accepted GROUP BY ensemble_id"""))
def best_centre(spark: SparkSession, folder: str) -> DataFrame:
    rows = clustered(Given(spark, folder)).withColumn("rel_energy_kcal", F.lit(None).cast("double"))
    return screen.best_conformer(rows, "first_cluster_center")


@register("agg_best_of_array", sql("""
    SELECT ensemble_id, conf_idx FROM
    (SELECT ensemble_id, arg_min(conf_idx, (e_high_eh, conf_idx)) AS conf_idx FROM thermo_in
     WHERE e_high_eh IS NOT NULL GROUP BY ensemble_id)
    WHERE conf_idx IN (SELECT l_orderkey + 1 FROM lineitem)"""))
def best_array(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    energies = given.thermo_in().withColumnRenamed("e_high_eh", "energy_eh")
    return screen.best_of_array(energies, given.shieldings())


@register("agg_screen_counts", sql(f"""
    SELECT ensemble_id, count(*) AS n_input, count(*) FILTER (accepted) AS n_accepted,
           count(*) FILTER (NOT accepted) AS n_rejected, count(*) FILTER (reason = '{K.REASON_WINDOW}') AS n_above_ewin
    FROM geo_screen GROUP BY ensemble_id"""))
def counts(spark: SparkSession, folder: str) -> DataFrame:
    return screen.screen_counts(screened(Given(spark, folder)))


@register("set_accept_split", sql("""
    SELECT 'accepted' AS bucket, ensemble_id, conf_idx FROM geo_screen WHERE accepted
    UNION ALL SELECT 'rejected', ensemble_id, conf_idx FROM geo_screen WHERE NOT accepted"""))
def split(spark: SparkSession, folder: str) -> DataFrame:
    bucket = F.when(F.col("accepted"), "accepted").otherwise("rejected")
    return screened(Given(spark, folder)).select(bucket.alias("bucket"), *MEMBER)


@register("win_ordinal", sql("""
    SELECT ensemble_id, conf_idx, row_number() OVER (PARTITION BY ensemble_id ORDER BY conf_idx)::INTEGER AS ordinal
    FROM conformers"""))
def ordinal(spark: SparkSession, folder: str) -> DataFrame:
    return screen.ordinals(Given(spark, folder).conformers()).select(*MEMBER, "ordinal")


@register("topk_conformers", sql("""
    SELECT ensemble_id, conf_idx FROM conformers
    QUALIFY row_number() OVER (PARTITION BY ensemble_id ORDER BY conf_idx) <= 3"""))
def topk(spark: SparkSession, folder: str) -> DataFrame:
    return screen.first_members(Given(spark, folder).conformers(), 3).select(*MEMBER)


@register("ord_by_index", sql("SELECT ensemble_id, conf_idx, accepted FROM geo_screen ORDER BY ensemble_id, conf_idx"))
def ordered(spark: SparkSession, folder: str) -> DataFrame:
    return screened(Given(spark, folder)).select(*MEMBER, "accepted").orderBy(*MEMBER)


@register("join_positional", with_ctes(f"""
    SELECT ensemble_id, conf_idx, {r6('''CASE WHEN listed >= n THEN value END''')} AS energy_kcal
    FROM (SELECT *, row_number() OVER (PARTITION BY ensemble_id ORDER BY conf_idx) AS pos, count(*) {OVER} AS n
          FROM conformers)
    LEFT JOIN (SELECT o_custkey AS ensemble_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
                      o_totalprice * 1.0371319e-5 AS value, count(*) OVER (PARTITION BY o_custkey) AS listed
               FROM orders WHERE o_totalprice < 450000) USING (ensemble_id, pos)"""))
def positional(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    members = given.conformers().withColumn("energy_kcal", F.lit(None).cast("double"))
    listed = given.table("orders").where("o_totalprice < 450000").select(
        F.col("o_custkey").alias("ensemble_id"), F.col("o_orderkey").alias("conf_idx"),
        (F.col("o_totalprice") * F.lit(1.0371319e-5)).alias("energy_kcal"),
    )
    joined = screen.join_positional(members, screen.ordinals(listed).drop("conf_idx"))
    return joined.select(*MEMBER, F.round("energy_kcal", 6).alias("energy_kcal"))


@register("join_rel_by_index", sql(f"""
    SELECT c.ensemble_id, c.conf_idx, {r6('rel')} AS rel_energy_kcal
    FROM conformers c LEFT JOIN
      (SELECT ensemble_id, conf_idx, (e_high_eh - min(e_high_eh) {OVER}) * {K.HARTREE_TO_KCAL}::DOUBLE AS rel
       FROM thermo_in) USING (ensemble_id, conf_idx)"""))
def rel_by_index(spark: SparkSession, folder: str) -> DataFrame:
    given = Given(spark, folder)
    energies = given.thermo_in()
    plan = plan_groups(energies, screen.ENSEMBLE)
    relative_rows = plan.apply(energies, lambda d, g: screen.relative_hartree(d, g, "e_high_eh"))
    known = relative_rows.where(F.col("rel_energy_kcal").isNotNull()).select(*MEMBER, "rel_energy_kcal")
    joined = given.conformers().join(known, MEMBER, "left")
    return joined.select(*MEMBER, F.round("rel_energy_kcal", 6).alias("rel_energy_kcal"))


@register("join_pair_candidates", sql("""
    SELECT a.ensemble_id, a.conf_idx, count(b.conf_idx) AS n_partners
    FROM conformers a LEFT JOIN conformers b
      ON a.ensemble_id = b.ensemble_id AND a.conf_idx <> b.conf_idx
     AND b.energy_kcal >= a.energy_kcal - 0.5 AND b.energy_kcal <= a.energy_kcal + 0.5
    WHERE a.energy_kcal IS NOT NULL GROUP BY a.ensemble_id, a.conf_idx"""))
def pair_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return screen.partner_counts(Given(spark, folder).conformers(), 0.5)
