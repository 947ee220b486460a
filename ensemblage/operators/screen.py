"""Screens that reduce an ensemble: energy windows, supplied masks, clusters, and the records they leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators.groups import GroupPlan, SpreadGroups, TaskGroups, plan_groups

ENSEMBLE = ("ensemble_id",)
MEMBER = ["ensemble_id", "conf_idx"]
Groups = TaskGroups | SpreadGroups


def check_window(width_kcal: float) -> float:
    if width_kcal < 0:
        raise ValueError(f"energy window must not be negative, got {width_kcal!r}")
    return float(width_kcal)


def within_window(df: DataFrame, groups: Groups, width_kcal: float, survives: Column | None = None) -> DataFrame:
    """``in_window``: energy at most ``width_kcal`` above the lowest one; unknown energies stay in.

    With ``survives`` only those conformers set the lowest energy and only they can fall outside.
    """
    energy = F.col("energy_kcal")
    if survives is not None:
        energy = F.when(survives, energy)
    df = groups.with_aggs(df.withColumn("_energy", energy), _lowest=F.min("_energy"))
    inside = F.coalesce(F.col("_energy") - F.col("_lowest") <= check_window(width_kcal), F.lit(True))
    return df.withColumn("in_window", inside).drop("_energy", "_lowest")


def energy_window(df: DataFrame, width_kcal: float, survives: Column | None = None, plan: GroupPlan | None = None) -> DataFrame:
    plan = plan or plan_groups(df, ENSEMBLE)
    return plan.apply(df, lambda d, g: within_window(d, g, width_kcal, survives))


def decide_use_energies(df: DataFrame, groups: Groups, mode: str = "auto") -> DataFrame:
    """``use_energies`` per conformer: with auto only where the whole ensemble has energies."""
    if mode not in ("auto", "true", "false"):
        raise ValueError(f"mode must be auto, true or false, got {mode!r}")
    df = groups.with_aggs(df, have_energies=F.bool_and(F.col("energy_kcal").isNotNull()))
    use = {"auto": F.col("have_energies"), "true": F.lit(True), "false": F.lit(False)}[mode]
    return df.withColumn("use_energies", use)


#: Why nothing of an ensemble is accepted that must use energies but lacks some.
ENERGIES_MISSING = "use_energies_required_but_unavailable"


def _lacks_energies(mode: str) -> Column:
    return ~F.col("have_energies") if mode == "true" else F.lit(False)


def energies_required(df: DataFrame) -> DataFrame:
    """Failure rows of ensembles that must use energies but lack some."""
    state = df.groupBy(*ENSEMBLE).agg(F.count("energy_kcal").alias("n_with_energy"), F.count("*").alias("n_input"))
    return state.where("n_with_energy < n_input").withColumn(
        "error", F.lit(ENERGIES_MISSING)
    )


def bypass_small(df: DataFrame, groups: Groups, min_conformers: int = 3) -> DataFrame:
    """``screened`` is false where an ensemble is too small to be screened."""
    df = groups.with_aggs(df, n_input=F.count("*"))
    return df.withColumn("screened", F.col("n_input") >= min_conformers)


def apply_mask(df: DataFrame, mask: DataFrame, groups: Groups) -> DataFrame:
    """Join a supplied accept mask; where it does not cover exactly the ensemble, everything is accepted.

    ``mask_ok`` tells which of the two happened.
    """
    once = mask.groupBy(*MEMBER).agg(F.bool_and("accepted").alias("_accepted"))  # a repeated row must not repeat conformers
    lengths = mask.groupBy(*ENSEMBLE).agg(F.count("*").alias("_n_mask"))
    joined = groups.attach(df.join(once, MEMBER, "left"), lengths, "left")
    joined = groups.with_aggs(joined, _covered=F.bool_and(F.col("_accepted").isNotNull()), _n=F.count("*"))
    joined = joined.withColumn("mask_ok", F.col("_covered") & (F.coalesce("_n_mask", F.lit(0)) == F.col("_n")))
    kept = F.when(F.col("mask_ok"), F.col("_accepted")).otherwise(F.lit(True))
    return joined.withColumn("kept_by_mask", kept).drop("_accepted", "_n_mask", "_covered", "_n")


def mask_failures(df: DataFrame, mask: DataFrame, min_conformers: int = 3) -> DataFrame:
    """Ensembles whose mask has another length than the ensemble; those too small to be screened need none."""
    expected = df.groupBy(*ENSEMBLE).agg(F.count("*").alias("n_input"))
    given = mask.groupBy(*ENSEMBLE).agg(F.count("*").alias("n_mask"))
    joined = expected.join(given, list(ENSEMBLE), "left").fillna(0, ["n_mask"])
    return joined.where((F.col("n_input") != F.col("n_mask")) & (F.col("n_input") >= min_conformers)).withColumn("error", F.lit("pruning_returned_unexpected_mask_length"))


def relative_energy(df: DataFrame, groups: Groups) -> DataFrame:
    """``rel_energy_kcal`` above the lowest accepted conformer, for accepted conformers only."""
    accepted = F.when(F.col("accepted"), F.col("energy_kcal"))
    df = groups.with_aggs(df.withColumn("_accepted_energy", accepted), _lowest=F.min("_accepted_energy"))
    relative = F.col("_accepted_energy") - F.col("_lowest")
    return df.withColumn("rel_energy_kcal", relative).drop("_accepted_energy", "_lowest")


def relative_hartree(df: DataFrame, groups: Groups, energy: str = "energy_eh") -> DataFrame:
    df = groups.with_aggs(df, _lowest=F.min(energy))
    return df.withColumn("rel_energy_kcal", (F.col(energy) - F.col("_lowest")) * K.HARTREE_TO_KCAL).drop("_lowest")


def geometric_screen(
    df: DataFrame, mask: DataFrame, width_kcal: float, use_energies: str = "auto", min_conformers: int = 3,
    keep_rejected: bool = True, plan: GroupPlan | None = None,
) -> DataFrame:
    """Geometric mask first, then the energy window over its survivors; the mask's reason wins."""
    check_window(width_kcal)
    plan = plan or plan_groups(df, ENSEMBLE)

    def chain(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = decide_use_energies(bypass_small(rows, groups, min_conformers), groups, use_energies)
        rows = apply_mask(rows, mask, groups)
        rows = rows.withColumn("kept", F.when(F.col("screened"), F.col("kept_by_mask")).otherwise(F.lit(True)))
        rows = within_window(rows, groups, width_kcal, F.col("kept"))
        applies = F.col("use_energies") & F.col("have_energies")
        rows = rows.withColumn("in_window", F.when(applies, F.col("in_window")).otherwise(F.lit(True)))
        failed = _lacks_energies(use_energies)
        reason = F.when(failed, ENERGIES_MISSING).when(~F.col("kept"), K.REASON_PRUNED).when(~F.col("in_window"), K.REASON_WINDOW)
        rows = rows.withColumns({"accepted": ~failed & F.col("kept") & F.col("in_window"), "rejected_reason": reason})
        return relative_energy(rows, groups)

    result = plan.apply(df, chain).select(
        *df.columns, "accepted", "rejected_reason", "rel_energy_kcal", "mask_ok"
    )
    return result if keep_rejected else result.where("accepted")


def cluster_screen(
    df: DataFrame, clusters: DataFrame, width_kcal: float, use_energies: str = "auto", min_conformers: int = 3,
    keep_rejected: bool = True, plan: GroupPlan | None = None,
) -> DataFrame:
    """Energy window first, then one accepted centre per cluster; ``clusters`` has a label and a distance per conformer.

    Conformers outside the window have no cluster. The centre is the one nearest to it, then the lowest
    in energy, then the first. Ensembles with too few survivors keep them all, each its own cluster; so do those
    where a survivor has no label, which ``label_failures`` lists.
    """
    check_window(width_kcal)
    plan = plan or plan_groups(df, ENSEMBLE)

    def chain(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = within_window(decide_use_energies(rows, groups, use_energies), groups, width_kcal)
        applies = F.col("use_energies") & F.col("have_energies")
        rows = rows.withColumn("in_window", F.when(applies, F.col("in_window")).otherwise(F.lit(True)))
        rows = rows.withColumn("failed", _lacks_energies(use_energies))
        unlabelled = F.col("in_window") & F.col("label").isNull()
        rows = groups.with_aggs(rows, _n_within=F.count_if("in_window"), _unlabelled=F.count_if(unlabelled))
        enough = (F.col("_n_within") >= min_conformers) & (F.col("_unlabelled") == 0)
        return rows.withColumn("screened", enough).drop("_n_within", "_unlabelled")

    once = clusters.groupBy(*MEMBER).agg(F.min_by(F.struct("label", "distance"), F.struct("distance", "label")).alias("_c"))
    once = once.select(*MEMBER, "_c.label", "_c.distance")
    labelled = plan.apply(df.join(once, MEMBER, "left"), chain)
    centres = cluster_centres(labelled.where(F.col("in_window") & F.col("screened")), plan)
    within = F.col("in_window") & F.col("screened")
    joined = labelled.join(
        centres, (labelled.ensemble_id == centres.c_ensemble) & (labelled.label == centres.c_label) & within, "left"
    )
    is_centre = F.col("conf_idx") == F.col("c_conf")
    accepted = ~F.col("failed") & F.col("in_window") & (~F.col("screened") | F.coalesce(is_centre, F.lit(False)))
    joined = joined.withColumns(
        {
            "accepted": accepted,
            "rejected_reason": F.when(F.col("failed"), ENERGIES_MISSING).when(~F.col("in_window"), K.REASON_WINDOW)
            .when(~accepted, K.REASON_CLUSTER),
            "cluster_id": F.when(within, F.col("c_dense")),
            "cluster_distance": F.when(within, F.when(is_centre, F.lit(0.0)).otherwise(F.col("distance"))),
        }
    )
    lone = F.col("in_window") & ~F.col("screened")
    extra = joined.withColumns(
        {"cluster_distance": F.when(lone, F.lit(0.0)).otherwise(F.col("cluster_distance")), "_lone": lone}
    )

    def finish(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = groups.running_sum(rows, "_place", F.lit(1), [F.col("conf_idx")], where=F.col("_lone"))
        place = F.when(F.col("_lone"), (F.col("_place") - 1).cast("int"))
        rows = rows.withColumn("cluster_id", F.coalesce(place, F.col("cluster_id")))
        return relative_energy(rows, groups)

    result = plan.apply(extra, finish).select(
        *df.columns, "accepted", "rejected_reason", "rel_energy_kcal", "cluster_id", "cluster_distance"
    )
    return result if keep_rejected else result.where("accepted")


def label_failures(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Ensembles in which conformers have no label: nothing of them is taken for a duplicate."""
    known = clusters.where(F.col("label").isNotNull()).select(*MEMBER).distinct().withColumn("_labelled", F.lit(1))
    state = df.join(known, MEMBER, "left").groupBy(*ENSEMBLE).agg(F.count("_labelled").alias("n_labelled"), F.count("*").alias("n_input"))
    return state.where("n_labelled < n_input").withColumn("error", F.lit("clustering_returned_unexpected_label_count"))


def cluster_centres(labelled: DataFrame, plan: GroupPlan | None = None) -> DataFrame:
    """One row per cluster: its centre and a dense id from 0 in label order.

    ``plan`` may come from the conformers, which are never fewer than their clusters.
    """
    order = F.struct("distance", F.col("energy_kcal").isNull(), "energy_kcal", "conf_idx")
    centres = labelled.where(F.col("label").isNotNull()).groupBy("ensemble_id", "label").agg(
        F.min_by("conf_idx", order).alias("c_conf")
    )
    plan = plan or plan_groups(centres, ENSEMBLE)
    dense = plan.apply(centres, lambda d, g: g.ordinal(d, "c_dense", [F.col("label")]))
    return dense.select(
        F.col("ensemble_id").alias("c_ensemble"), F.col("label").alias("c_label"), "c_conf",
        (F.col("c_dense") - 1).alias("c_dense"),
    )


def best_conformer(screened: DataFrame, fallback: str = "first_accepted_by_index") -> DataFrame:
    """The accepted conformer lowest in energy, ties to the lower index; without energies the fallback's first."""
    by_energy = F.col("rel_energy_kcal").isNotNull()
    order = F.struct(~by_energy, F.coalesce("rel_energy_kcal", F.lit(0.0)), F.col("conf_idx"))
    if fallback == "first_cluster_center":
        order = F.struct(
            ~by_energy, F.coalesce("rel_energy_kcal", F.lit(0.0)),
            F.when(~by_energy, F.coalesce("cluster_id", F.lit(1 << 30))).otherwise(0), F.col("conf_idx"),
        )
    best = screened.where("accepted").groupBy(*ENSEMBLE).agg(
        F.min_by(F.struct("conf_idx", by_energy.alias("by_energy")), order).alias("best")
    )
    chosen = F.when(F.col("best.by_energy"), "lowest_rel_energy_kcal").otherwise(fallback)
    return best.select(*ENSEMBLE, F.col("best.conf_idx").alias("conf_idx"), chosen.alias("best_chosen_by"))


def best_of_array(energies: DataFrame, geometries: DataFrame) -> DataFrame:
    """Lowest absolute energy per ensemble; no best where that conformer has no geometry."""
    lowest = energies.where(F.col("energy_eh").isNotNull()).groupBy(*ENSEMBLE).agg(
        F.min_by("conf_idx", F.struct("energy_eh", "conf_idx")).alias("conf_idx")
    )
    return lowest.join(geometries, MEMBER, "left_semi")


def screen_counts(screened: DataFrame) -> DataFrame:
    return screened.groupBy(*ENSEMBLE).agg(
        F.count("*").alias("n_input"),
        F.count_if("accepted").alias("n_accepted"),
        F.count_if(~F.col("accepted")).alias("n_rejected"),
        F.count_if(F.col("rejected_reason") == K.REASON_WINDOW).alias("n_above_ewin"),
    )


def ordinals(df: DataFrame, order: list[Column] | None = None, plan: GroupPlan | None = None) -> DataFrame:
    """Members renumbered 1..n by position; their own ids stay."""
    plan = plan or plan_groups(df, ENSEMBLE)
    return plan.apply(df, lambda d, g: g.ordinal(d, "ordinal", order or [F.col("conf_idx")]))


def first_members(df: DataFrame, k: int, plan: GroupPlan | None = None) -> DataFrame:
    """The first k members of each ensemble; zero or less keeps all."""
    return df if k <= 0 else ordinals(df, plan=plan).where(F.col("ordinal") <= k).drop("ordinal")


def join_positional(members: DataFrame, energies: DataFrame, plan: GroupPlan | None = None) -> DataFrame:
    """Energies of a parallel list by position, used where no member has an energy and the list is long enough."""
    plan = plan or plan_groups(members, ENSEMBLE)

    lengths = energies.groupBy(*ENSEMBLE).agg(F.count("*").alias("_listed"))

    def number(rows: DataFrame, groups: Groups) -> DataFrame:
        rows = groups.with_aggs(rows, _known=F.count("energy_kcal"), _n=F.count("*"))
        return groups.attach(groups.ordinal(rows, "ordinal", [F.col("conf_idx")]), lengths, "left")

    numbered = plan.apply(members, number)
    values = energies.select(*ENSEMBLE, F.col("ordinal"), F.col("energy_kcal").alias("_value"))
    joined = numbered.join(values, [*ENSEMBLE, "ordinal"], "left")
    usable = (F.col("_known") == 0) & (F.col("_listed") >= F.col("_n"))
    energy = F.when(usable, F.col("_value")).otherwise(F.col("energy_kcal"))
    return joined.withColumn("energy_kcal", energy).drop("_known", "_n", "_listed", "_value")


def partner_counts(df: DataFrame, max_gap_kcal: float = 0.5, plan: GroupPlan | None = None) -> DataFrame:
    """How many other conformers of the ensemble lie within the energy gate of each conformer.

    A sweep over the sorted energies: the rows at or below e + gap less the rows below e - gap. It sizes
    the pairwise comparison without forming a single pair.
    """
    plan = plan or plan_groups(df, ENSEMBLE)
    known = df.where(F.col("energy_kcal").isNotNull()).select(*MEMBER, "energy_kcal")
    energy = F.col("energy_kcal")
    # at equal positions: lower probes first, then the conformers, then upper probes
    events = known.select(
        *MEMBER,
        F.explode(
            F.array(
                F.struct((energy - max_gap_kcal).alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("one")),
                F.struct(energy.alias("at"), F.lit(1).alias("kind"), F.lit(1).alias("one")),
                F.struct((energy + max_gap_kcal).alias("at"), F.lit(2).alias("kind"), F.lit(0).alias("one")),
            )
        ).alias("e"),
    ).select(*MEMBER, "e.*")
    order = [F.col("at"), F.col("kind"), F.col("conf_idx")]
    swept = plan.apply(events, lambda d, g: g.running_sum(d, "seen", F.col("one"), order))
    return swept.where("kind <> 1").groupBy(*MEMBER).agg(
        (F.max("seen") - F.min("seen") - 1).cast("long").alias("n_partners")
    )
