"""Queries on composite free energies and populations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators import thermo
from ensemblage.operators.groups import plan_groups
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import r6, with_ctes


@register("thm_composite_gibbs", with_ctes(f"SELECT ensemble_id, conf_idx, {r6('g')} AS g_composite_eh FROM gibbs"))
def composite(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in()
    return rows.select("ensemble_id", "conf_idx", F.round(thermo.composite_gibbs(), 6).alias("g_composite_eh"))


@register("agg_gibbs_min", with_ctes(f"SELECT ensemble_id, {r6('min(g)')} AS g_min_eh FROM gibbs GROUP BY ensemble_id"))
def gibbs_min(spark: SparkSession, folder: str) -> DataFrame:
    lowest = thermo.lowest_gibbs(Given(spark, folder).thermo_in())
    return lowest.select("ensemble_id", F.round("g_min_eh", 6).alias("g_min_eh"))


@register("win_delta_g", with_ctes(f"SELECT ensemble_id, conf_idx, {r6('dg')} AS delta_g_kcal FROM delta"))
def delta_g(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in().withColumn("g_composite_eh", thermo.composite_gibbs())
    rows = plan_groups(rows, thermo.ENSEMBLE).apply(rows, lambda d, g: thermo.relative_gibbs(d, g, 0.0))
    return rows.select("ensemble_id", "conf_idx", F.round("delta_g_kcal", 6).alias("delta_g_kcal"))


@register("thm_std_state", with_ctes(
    f"SELECT ensemble_id, conf_idx, {r6(f'dg + {K.R_KCAL_PER_MOL_K}::DOUBLE * {K.ROOM_TEMPERATURE_K}::DOUBLE * ln(24.46::DOUBLE)')}"
    f" AS delta_g_kcal, {r6('w')} AS weight FROM weighted"))
def molar_state(spark: SparkSession, folder: str) -> DataFrame:
    rows = thermo.populations(Given(spark, folder).thermo_in(), standard_state="1M")
    return rows.select(
        "ensemble_id", "conf_idx", F.round("delta_g_kcal", 6).alias("delta_g_kcal"), F.round("weight", 6).alias("weight")
    )


@register("agg_boltzmann_weights", with_ctes(f"SELECT ensemble_id, conf_idx, {r6('w')} AS weight FROM weighted"))
def weights(spark: SparkSession, folder: str) -> DataFrame:
    rows = Given(spark, folder).thermo_in().withColumn("g_composite_eh", thermo.composite_gibbs())

    def chain(d: DataFrame, g: thermo.Groups) -> DataFrame:
        return thermo.boltzmann_weights(thermo.relative_gibbs(d, g, 0.0), g, K.ROOM_TEMPERATURE_K)

    rows = plan_groups(rows, thermo.ENSEMBLE).apply(rows, chain)
    return rows.select("ensemble_id", "conf_idx", F.round("weight", 6).alias("weight"))


@register("win_cumulative_weight", with_ctes(f"SELECT ensemble_id, conf_idx, {r6('cum')} AS cum_weight FROM cumulated"))
def cumulative(spark: SparkSession, folder: str) -> DataFrame:
    rows = thermo.populations(Given(spark, folder).thermo_in())
    return rows.select("ensemble_id", "conf_idx", F.round("cum_weight", 6).alias("cum_weight"))


@register("win_population_cover", with_ctes(
    "SELECT ensemble_id, count(*) AS n_cover FROM cumulated WHERE cum - w < 0.9 GROUP BY ensemble_id"))
def cover(spark: SparkSession, folder: str) -> DataFrame:
    rows = thermo.population_cover(thermo.populations(Given(spark, folder).thermo_in()))
    return rows.groupBy("ensemble_id").agg(F.count("*").alias("n_cover"))


@register("thm_failures", with_ctes(
    "SELECT ensemble_id, conf_idx, 'missing_thermochem_or_energy_for_G' AS error FROM gibbs WHERE g IS NULL"))
def failures(spark: SparkSession, folder: str) -> DataFrame:
    return thermo.thermo_failures(Given(spark, folder).thermo_in())


@register("agg_renormalize", with_ctes(f"""
    SELECT ensemble_id, conf_idx, {r6('w / sum(w) OVER (PARTITION BY ensemble_id)')} AS weight
    FROM (SELECT ensemble_id, conf_idx, CASE WHEN w >= 0.01 THEN w END AS w FROM weighted)"""))
def renormalized(spark: SparkSession, folder: str) -> DataFrame:
    rows = thermo.populations(Given(spark, folder).thermo_in())
    kept = rows.select("ensemble_id", "conf_idx", F.when(F.col("weight") >= 0.01, F.col("weight")).alias("weight"))
    kept = thermo.renormalize(kept)
    return kept.select("ensemble_id", "conf_idx", F.round("weight", 6).alias("weight"))


THERMO_TABLE = with_ctes(f"""
    SELECT ensemble_id, conf_idx, {r6('e_high_eh')} AS e_high_eh, {r6('g')} AS g_composite_eh,
           {r6('dg')} AS delta_g_kcal, {r6('w')} AS weight, {r6('cum')} AS cum_weight
    FROM cumulated""")


@register("thm_table", THERMO_TABLE)
def thermo_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = thermo.populations(Given(spark, folder).thermo_in())
    measures = ["e_high_eh", "g_composite_eh", "delta_g_kcal", "weight", "cum_weight"]
    return rows.select("ensemble_id", "conf_idx", *[F.round(m, 6).alias(m) for m in measures])
