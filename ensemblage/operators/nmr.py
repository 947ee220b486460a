"""Population-weighted shieldings and couplings, and their linear scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.functions.tables import fixed_table
from ensemblage.operators import thermo

CALIBRATION_SCHEMA = (
    "functional string, basis string, solvent string, nucleus string, slope double, intercept double, "
    "source string, valid_lo double, valid_hi double"
)
CALIBRATION_KEYS = ("functional", "basis", "solvent", "nucleus")


@dataclass(frozen=True)
class NmrSettings:
    """Levels of theory whose calibration applies to a run."""

    solvent: str = "CHCl3"
    method_h: str = "WP04"
    basis_h: str = "6-311++G(2d,p)"
    method_c: str = "wB97X-D"
    basis_c: str = "6-31G(d,p)"
    method_j: str = "mPW1PW91"
    basis_j: str = "pcJ-2"

    def method(self) -> Column:
        nucleus = F.col("nucleus")
        return (
            F.when(nucleus == "1H", self.method_h).when(nucleus == "13C", self.method_c)
            .when(nucleus == "1H-1H_J", self.method_j)
        )

    def basis(self) -> Column:
        nucleus = F.col("nucleus")
        return (
            F.when(nucleus == "1H", self.basis_h).when(nucleus == "13C", self.basis_c)
            .when(nucleus == "1H-1H_J", self.basis_j)
        )


def calibration_table(spark: SparkSession, overrides: DataFrame | None = None) -> DataFrame:
    """The published scaling rows in table order; override rows come first and so win."""
    table = fixed_table(spark, K.CALIBRATION_ROWS, CALIBRATION_SCHEMA).withColumn("origin", F.lit(1))
    if overrides is None:
        return table
    overrides = overrides.withColumns({"origin": F.lit(0), "position": F.monotonically_increasing_id()})
    return overrides.unionByName(table)


def join_calibration(df: DataFrame, table: DataFrame) -> DataFrame:
    """Left join on the four names, trimmed: an exact match first, else the first one that differs in case only."""
    values = ["slope", "intercept", "source", "valid_lo", "valid_hi"]
    first = F.struct("origin", "position")
    entry = F.struct("origin", *values)
    exact = table.groupBy(*CALIBRATION_KEYS).agg(F.min_by(entry, first).alias("_exact"))
    folded = table.groupBy(*[F.lower(k).alias(k) for k in CALIBRATION_KEYS]).agg(F.min_by(entry, first).alias("_folded"))
    exact_keys = [F.trim(df[k]).eqNullSafe(exact[k]) for k in CALIBRATION_KEYS]
    joined = df.join(exact, exact_keys, "left").drop(*[exact[k] for k in CALIBRATION_KEYS])
    folded_keys = [F.lower(F.trim(df[k])) == folded[k] for k in CALIBRATION_KEYS]
    joined = joined.join(folded, folded_keys, "left").drop(*[folded[k] for k in CALIBRATION_KEYS])
    # an override that matches in any case beats a default that matches exactly
    override = (F.col("_folded.origin") == 0) & ~F.coalesce(F.col("_exact.origin") == 0, F.lit(False))
    chosen = F.when(override, F.col("_folded")).otherwise(F.coalesce("_exact", "_folded"))
    joined = joined.withColumn("_entry", chosen)
    return joined.withColumns({v: F.col(f"_entry.{v}") for v in values}).drop("_exact", "_folded", "_entry")


def predicted_shift(sigma: Column, slope: Column, intercept: Column) -> Column:
    """Inverse of sigma = slope * delta + intercept; a zero slope is an error."""
    failed = F.raise_error(F.lit("calibration slope must not be zero"))
    return F.when(slope == 0, failed.cast("double")).otherwise((sigma - intercept) / slope)


def predicted_coupling(j_hz: Column, slope: Column, intercept: Column) -> Column:
    return slope * j_hz + intercept


def weighted_members(observables: DataFrame, weights: DataFrame) -> DataFrame:
    """Observables of the conformers that have a weight."""
    known = weights.where(F.col("weight").isNotNull()).select("ensemble_id", "conf_idx", "weight")
    return observables.join(known, ["ensemble_id", "conf_idx"])


def contributors(members: DataFrame) -> DataFrame:
    """Per ensemble: conformers with at least one row and a weight; kept only if the weights add up to more than 0."""
    per_conformer = members.groupBy("ensemble_id", "conf_idx").agg(F.first("weight").alias("weight"))
    totals = per_conformer.groupBy("ensemble_id").agg(
        F.count("*").alias("n_used"), F.sum("weight").alias("_total")
    )
    return totals.where(F.col("_total") > 0).drop("_total")


def weighted_mean(value: str) -> Column:
    weight = F.sum("weight")
    return F.when(weight > 0, F.sum(F.col("weight") * F.col(value)) / weight).otherwise(F.lit(0.0))


def average_shieldings(shieldings: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean shielding per atom; the element is that of the first contributing conformer.

    An atom that one conformer lists twice counts twice.
    """
    members = weighted_members(shieldings, weights)
    means = members.groupBy("ensemble_id", "atom_index").agg(
        weighted_mean("sigma_iso_ppm").alias("sigma_avg_ppm"),
        F.min_by("element", F.struct("conf_idx", "element")).alias("element"),
    )
    return means.join(contributors(members), "ensemble_id")


def average_couplings(couplings: DataFrame, weights: DataFrame) -> DataFrame:
    """Mean coupling per pair over the rows with a total; all rows count towards ``n_used``."""
    members = weighted_members(couplings, weights)
    first = F.struct("conf_idx", "elem_i", "elem_j")
    means = members.where(F.col("j_total_hz").isNotNull()).groupBy("ensemble_id", "i", "j").agg(
        weighted_mean("j_total_hz").alias("j_avg_hz"),
        F.min_by("elem_i", first).alias("elem_i"),
        F.min_by("elem_j", first).alias("elem_j"),
    )
    return means.join(contributors(members), "ensemble_id")


def predict_shifts(means: DataFrame, table: DataFrame, settings: NmrSettings = NmrSettings()) -> DataFrame:
    """Averaged shieldings to chemical shifts; elements without a calibration keep the raw value."""
    nucleus = F.when(F.col("element") == "H", "1H").when(F.col("element") == "C", "13C")
    keyed = means.withColumn("nucleus", nucleus)
    keyed = keyed.withColumns(
        {"functional": settings.method(), "basis": settings.basis(), "solvent": F.lit(settings.solvent)}
    )
    joined = join_calibration(keyed, table)
    found = F.col("slope").isNotNull()
    shift = predicted_shift(F.col("sigma_avg_ppm"), F.col("slope"), F.col("intercept"))
    return joined.withColumns(
        {
            "delta_ppm": shift,
            "cal_source": F.when(found, F.col("source")).otherwise(""),
            "cal_method": F.when(found, F.col("functional")).otherwise(""),
            "cal_basis": F.when(found, F.col("basis")).otherwise(""),
            "cal_solvent": F.lit(settings.solvent),
            "out_of_range": ~shift.between(F.col("valid_lo"), F.col("valid_hi")),
        }
    ).select(
        "ensemble_id", "atom_index", "element", "sigma_avg_ppm", "delta_ppm", "cal_source", "cal_method",
        "cal_basis", "cal_solvent", "n_used", "out_of_range",
    )


def predict_couplings(means: DataFrame, table: DataFrame, settings: NmrSettings = NmrSettings()) -> DataFrame:
    """Averaged couplings to predictions; pairs other than H-H keep the raw value."""
    nucleus = F.when((F.col("elem_i") == "H") & (F.col("elem_j") == "H"), "1H-1H_J")
    keyed = means.withColumn("nucleus", nucleus)
    keyed = keyed.withColumns(
        {"functional": settings.method(), "basis": settings.basis(), "solvent": F.lit(settings.solvent)}
    )
    joined = join_calibration(keyed, table)
    found = F.col("slope").isNotNull()
    return joined.withColumns(
        {
            "j_predicted_hz": predicted_coupling(F.col("j_avg_hz"), F.col("slope"), F.col("intercept")),
            "cal_source": F.when(found, F.col("source")).otherwise(""),
            "cal_method": F.when(found, F.col("functional")).otherwise(""),
            "cal_basis": F.when(found, F.col("basis")).otherwise(""),
            "cal_solvent": F.lit(settings.solvent),
        }
    ).select(
        "ensemble_id", "i", "elem_i", "j", "elem_j", "j_avg_hz", "j_predicted_hz", "cal_source", "cal_method",
        "cal_basis", "cal_solvent", "n_used",
    )


def calibration_gaps(means: DataFrame, table: DataFrame, settings: NmrSettings = NmrSettings()) -> DataFrame:
    """Failure rows for nuclei that occur but have no calibration; H-H couplings need hydrogen."""
    present = means.where(F.col("element").isin("H", "C")).select("ensemble_id", "element").distinct()
    nuclei = F.when(F.col("element") == "H", F.array(F.lit("1H"), F.lit("1H-1H_J"))).otherwise(F.array(F.lit("13C")))
    needed = present.select("ensemble_id", F.explode(nuclei).alias("nucleus"))
    needed = needed.withColumns(
        {"functional": settings.method(), "basis": settings.basis(), "solvent": F.lit(settings.solvent)}
    )
    missing = join_calibration(needed, table).where(F.col("slope").isNull())
    return missing.select(
        "ensemble_id", F.lit("calibration_not_found").alias("error"), "nucleus", "functional", "basis", "solvent"
    )


def hydrogen_coverage(shift_means: DataFrame, coupling_means: DataFrame) -> DataFrame:
    """H-H pairs found against pairs possible; none at all with two or more hydrogens is a failure."""
    atoms = shift_means.groupBy("ensemble_id").agg(F.count_if(F.col("element") == "H").alias("n_h_atoms"))
    both = (F.col("elem_i") == "H") & (F.col("elem_j") == "H")
    pairs = coupling_means.groupBy("ensemble_id").agg(F.count_if(both).alias("n_hh_pairs"))
    joined = atoms.join(pairs, "ensemble_id", "left").fillna(0, ["n_hh_pairs"])
    possible = F.col("n_h_atoms") * (F.col("n_h_atoms") - 1)
    return joined.withColumns(
        {
            "n_hh_possible": (possible / 2).cast("long"),
            "failed": (F.col("n_h_atoms") >= 2) & (F.col("n_hh_pairs") == 0),
        }
    )


def nmr_failures(weights: DataFrame, shieldings: DataFrame, couplings: DataFrame, coupling_files: DataFrame) -> DataFrame:
    """Failure rows of the averaging step, one per ensemble and cause (per file for unparsed couplings)."""
    state = weights.groupBy("ensemble_id").agg(F.count("weight").alias("n_weights"))
    no_weights = state.where(F.col("n_weights") == 0)
    usable = contributors(weighted_members(shieldings, weights))
    no_shielding = state.where(F.col("n_weights") > 0).join(usable, "ensemble_id", "left_anti")
    unparsed = coupling_files.join(couplings, ["ensemble_id", "conf_idx"], "left_anti")
    coverage = hydrogen_coverage(average_shieldings(shieldings, weights), average_couplings(couplings, weights))
    nothing = F.lit(None).cast(coupling_files.schema["conf_idx"].dataType)

    def failure(df: DataFrame, error: str, conf_idx: Column = nothing) -> DataFrame:
        return df.select("ensemble_id", conf_idx.alias("conf_idx"), F.lit(error).alias("error"))

    return (
        failure(no_weights, "no_finite_weights")
        .unionByName(failure(no_shielding, "no_shielding_data_in_any_conformer"))
        .unionByName(failure(unparsed, "coupling_parse_empty", F.col("conf_idx")))
        .unionByName(failure(coverage.where("failed"), "no_hh_couplings_parsed"))
    )


def nmr_summary(
    shifts: DataFrame, couplings: DataFrame, table: DataFrame, settings: NmrSettings = NmrSettings(), conformers: DataFrame | None = None,
) -> DataFrame:
    """Counts per ensemble, and for each calibration whether it exists and whether a row used it.

    ``conformers`` (ensemble_id, conf_idx) are all that were to be averaged; without them their number is NULL.
    """
    scaled_h = (F.col("element") == "H") & F.col("delta_ppm").isNotNull()
    scaled_c = (F.col("element") == "C") & F.col("delta_ppm").isNotNull()
    atoms = shifts.groupBy("ensemble_id").agg(
        F.count("*").alias("n_atoms"),
        F.count_if(F.col("element") == "H").alias("n_h_atoms"),
        F.max("n_used").alias("n_with_shielding"),
        F.count_if(scaled_h).alias("n_h_scaled"),
        F.count_if(scaled_c).alias("n_c_scaled"),
    )
    both = (F.col("elem_i") == "H") & (F.col("elem_j") == "H")
    pairs = couplings.groupBy("ensemble_id").agg(
        F.count_if(both).alias("n_hh_pairs"),
        F.count_if(both & F.col("j_predicted_hz").isNotNull()).alias("n_hh_scaled"),
        F.max("n_used").alias("n_with_couplings"),
    )
    joined = atoms.join(pairs, "ensemble_id", "left").fillna(0, ["n_hh_pairs", "n_hh_scaled", "n_with_couplings"])
    if conformers is None:
        joined = joined.withColumn("n_conformers_total", F.lit(None).cast("long"))
    else:
        totals = conformers.groupBy("ensemble_id").agg(F.count_distinct("conf_idx").alias("n_conformers_total"))
        joined = joined.join(totals, "ensemble_id", "left")
    nuclei = {"1H": "cal_h_found", "13C": "cal_c_found", "1H-1H_J": "cal_j_found"}
    wanted = shifts.sparkSession.createDataFrame([(n,) for n in nuclei], "nucleus string").withColumns(
        {"functional": settings.method(), "basis": settings.basis(), "solvent": F.lit(settings.solvent)}
    )
    # one row per nucleus
    found = {r["nucleus"]: r["slope"] is not None for r in join_calibration(wanted, table).select("nucleus", "slope").collect()}
    joined = joined.withColumns({name: F.lit(found[nucleus]) for nucleus, name in nuclei.items()})
    return joined.select(
        "ensemble_id", F.lit(settings.solvent).alias("solvent"), "n_conformers_total", "n_atoms", "n_h_atoms", "n_with_shielding", "n_with_couplings", "n_hh_pairs",
        "n_h_scaled", "n_c_scaled", "n_hh_scaled",
        (F.col("n_h_scaled") > 0).alias("cal_h_used"),
        (F.col("n_c_scaled") > 0).alias("cal_c_used"),
        "cal_h_found", "cal_c_found", "cal_j_found",
        (F.col("n_hh_scaled") > 0).alias("cal_j_used"),
    )


def with_fallback(dedicated: DataFrame, dedicated_other: DataFrame, fallback: DataFrame) -> DataFrame:
    """Rows of the dedicated files, and of the compound file where a conformer has no dedicated rows of either kind."""
    keys = ["ensemble_id", "conf_idx"]
    covered = dedicated.select(*keys).union(dedicated_other.select(*keys)).distinct()
    return dedicated.unionByName(fallback.join(covered, keys, "left_anti"))


def nmr_tables(
    weights: DataFrame, shieldings: DataFrame, couplings: DataFrame, table: DataFrame,
    settings: NmrSettings = NmrSettings(), plan=None,
) -> tuple[DataFrame, DataFrame]:
    """Conformer weights and observables to the predicted shift and coupling tables."""
    weights = thermo.renormalize(weights, plan)
    shifts = predict_shifts(average_shieldings(shieldings, weights), table, settings)
    pairs = predict_couplings(average_couplings(couplings, weights), table, settings)
    return shifts, pairs
