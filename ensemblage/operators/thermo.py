"""Composite free energies, Boltzmann weights and cumulative populations per ensemble."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators.groups import GroupPlan, SpreadGroups, TaskGroups, plan_groups

ENSEMBLE = ("ensemble_id",)
Groups = TaskGroups | SpreadGroups


def standard_state_shift(standard_state: str, temperature_k: float) -> float:
    """kcal/mol added to every relative free energy in a 1 mol/L standard state."""
    if temperature_k <= 0:
        raise ValueError(f"temperature must be positive, got {temperature_k!r}")
    state = standard_state.strip().lower()
    if state not in K.STANDARD_STATES:
        raise ValueError(f"standard state must be one of {K.STANDARD_STATES}, got {standard_state!r}")
    if state not in K.MOLAR_STATES:
        return 0.0
    return K.R_KCAL_PER_MOL_K * temperature_k * math.log(K.MOLAR_VOLUME_RATIO)


def composite_gibbs() -> Column:
    """High-level energy plus low-level correction, else the low-level free energy."""
    return F.coalesce(F.col("e_high_eh") + F.col("g_minus_eel_low_eh"), F.col("g_low_eh"))


def thermo_failures(df: DataFrame) -> DataFrame:
    """One failure row per conformer without a usable free energy."""
    return df.where(composite_gibbs().isNull()).select(
        *ENSEMBLE, "conf_idx", F.lit("missing_thermochem_or_energy_for_G").alias("error")
    )


def relative_gibbs(df: DataFrame, groups: Groups, shift: float) -> DataFrame:
    df = groups.with_aggs(df, g_min_eh=F.min("g_composite_eh"))
    delta = (F.col("g_composite_eh") - F.col("g_min_eh")) * K.HARTREE_TO_KCAL + F.lit(shift)
    return df.withColumn("delta_g_kcal", delta)


def boltzmann_weights(df: DataFrame, groups: Groups, temperature_k: float, stable: bool = False) -> DataFrame:
    """exp(-dG/RT) over its sum; NULL stays NULL, and an unusable sum gives NULL throughout.

    ``stable`` subtracts the lowest dG first, so that no ensemble underflows.
    """
    if temperature_k <= 0:
        raise ValueError(f"temperature must be positive, got {temperature_k!r}")
    beta = 1.0 / (K.R_KCAL_PER_MOL_K * temperature_k)
    delta = F.col("delta_g_kcal")
    if stable:
        df = groups.with_aggs(df, _lowest=F.min("delta_g_kcal"))
        delta = delta - F.col("_lowest")
    df = df.withColumn("_boltzmann", F.exp(-delta * F.lit(beta)))
    df = groups.with_aggs(df, _partition=F.sum("_boltzmann"))
    usable = (F.col("_partition") > 0) & (F.col("_partition") < F.lit(float("inf")))
    weight = F.when(usable, F.col("_boltzmann") / F.col("_partition"))
    return df.withColumn("weight", weight).drop("_boltzmann", "_partition", "_lowest")


def cumulative_weights(df: DataFrame, groups: Groups) -> DataFrame:
    """Running weight by ascending dG; ties in input order."""
    return groups.running_sum(
        df,
        "cum_weight",
        F.col("weight"),
        [F.col("delta_g_kcal"), F.col("conf_idx")],
        where=F.col("delta_g_kcal").isNotNull() & F.col("weight").isNotNull(),
    )


def population_cover(df: DataFrame, share: float = 0.9) -> DataFrame:
    """The smallest set of conformers whose populations reach ``share``."""
    return df.where(F.col("cum_weight") - F.col("weight") < share)


def populations(
    df: DataFrame,
    temperature_k: float = K.ROOM_TEMPERATURE_K,
    standard_state: str = "1atm",
    plan: GroupPlan | None = None,
    stable: bool = False,
) -> DataFrame:
    """Thermochemistry rows to free energies, weights and cumulative weights."""
    shift = standard_state_shift(standard_state, temperature_k)
    plan = plan or plan_groups(df, ENSEMBLE)

    def chain(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = relative_gibbs(rows, groups, shift)
        rows = boltzmann_weights(rows, groups, temperature_k, stable)
        return cumulative_weights(rows, groups)

    return plan.apply(df.withColumn("g_composite_eh", composite_gibbs()), chain)


def renormalize(df: DataFrame, plan: GroupPlan | None = None, weight: str = "weight") -> DataFrame:
    """Finite weights rescaled to sum to one per ensemble; NULL where there is nothing to rescale."""
    plan = plan or plan_groups(df, ENSEMBLE)

    def scale(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = groups.with_aggs(rows, _total=F.sum(weight))
        return rows.withColumn(weight, F.when(F.col("_total") > 0, F.col(weight) / F.col("_total"))).drop("_total")

    return plan.apply(df, scale)


def lowest_gibbs(df: DataFrame) -> DataFrame:
    return df.groupBy(*ENSEMBLE).agg(F.min(composite_gibbs()).alias("g_min_eh"))


def energy_failures(files: DataFrame) -> DataFrame:
    """Files without an energy and files without a normal end; one file may give both."""
    reasons = F.array(
        F.when(F.col("final_energy_eh").isNull(), F.lit("missing_or_unparsed_energy")),
        F.when(~F.coalesce(F.col("ended_ok"), F.lit(False)), F.lit("orca_not_terminated_normally")),
    )
    return files.select(*ENSEMBLE, "task_idx", F.explode(F.array_compact(reasons)).alias("error"))
