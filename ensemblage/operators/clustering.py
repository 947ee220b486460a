"""Clusters of conformers in descriptor space, many ensembles at once; the definitions are this library's own."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.operators.geometry import union, with_cells
from ensemblage.operators.groups import SpreadGroups, TaskGroups, join_on, plan_groups
from ensemblage.session import cut_lineage

MEMBER = ["ensemble_id", "conf_idx"]


def square_distance(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, d: total + d)


#: Members of an ensemble that one task clusters for all numbers of clusters; larger ensembles go through rounds.
LLOYD_ROWS = 50_000
RUN = ["ensemble_id", "k"]


def _start_order() -> list[Column]:
    """Members in the order of a digest of their index, which any engine can compute."""
    return [F.md5(F.col("conf_idx").cast("string").cast("binary")), F.col("conf_idx")]


def _nearest(features: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = np.stack([((features - c) ** 2).sum(axis=1) for c in centres], axis=1)
    labels = squares.argmin(axis=1)
    return labels, squares[np.arange(len(labels)), labels]


def _lloyd(features: np.ndarray, k: int, max_rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, bool, int]:
    """Labels, squared distances, whether the centres rest and the rounds it took, from rows in the order of their start."""
    centres = features[:k].copy()
    for number in range(1, max_rounds + 1):
        labels, _ = _nearest(features, centres)
        new = np.stack([features[labels == c].mean(axis=0) if (labels == c).any() else centres[c] for c in range(len(centres))])
        shift = ((new - centres) ** 2).sum(axis=1).max()
        centres = new
        if shift <= tolerance * tolerance:
            break
    return *_nearest(features, centres), bool(shift <= tolerance * tolerance), number


def _silhouettes(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Each member's silhouette by squared distances, from the count, sum and sum of squares of each cluster."""
    names, codes, counts = np.unique(labels, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return np.zeros(len(labels))
    sums = np.stack([features[codes == c].sum(axis=0) for c in range(len(names))])
    own = (features**2).sum(axis=1)
    squares = np.array([own[codes == c].sum() for c in range(len(names))])
    total = counts * own[:, None] + squares - 2 * features @ sums.T  # to all members of each cluster
    mine = total[np.arange(len(codes)), codes]
    within = mine / np.maximum(counts[codes] - 1, 1)
    others = total / counts
    others[np.arange(len(codes)), codes] = np.inf
    between = others.min(axis=1)
    most = np.maximum(within, between)
    score = np.divide(between - within, most, out=np.zeros(len(codes)), where=most > 0)
    return np.where(counts[codes] == 1, 0.0, score)


def _clusters(points: DataFrame, ks: Sequence[int], dimensions: int, max_rounds: int, tolerance: float, task_rows: int | None) -> DataFrame:
    """ensemble_id, conf_idx, k, label, square, converged, rounds, score (the silhouette) for each number of clusters."""
    if min(ks) < 1:
        raise ValueError(f"k must be at least 1, got {min(ks)}")
    points = points.select(*MEMBER, "features")
    kinds = [points.schema[c].dataType.simpleString() for c in MEMBER]
    schema = f"ensemble_id {kinds[0]}, conf_idx {kinds[1]}, k int, label int, square double, converged boolean, rounds int, score double"
    order = _start_order()

    def in_task(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        features = np.stack(frame["features"].to_numpy()).astype(float)
        found = []
        for k in ks:
            labels, squares, converged, rounds = _lloyd(features, k, max_rounds, tolerance)
            found.append(pd.DataFrame({
                "ensemble_id": frame["ensemble_id"].to_numpy(), "conf_idx": frame["conf_idx"].to_numpy(), "k": k, "label": labels, "square": squares,
                "converged": converged, "rounds": rounds, "score": _silhouettes(features, labels)}))
        return pd.concat(found)

    def step(rows: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        ranked = groups.ordinal(rows, "rank", order)
        if isinstance(groups, TaskGroups):
            return ranked.groupBy("ensemble_id").applyInPandas(in_task, schema)
        return _lloyd_in_rounds(cut_lineage(ranked, "ranked"), groups, ks, dimensions, max_rounds, tolerance)

    return plan_groups(points, ("ensemble_id",), task_rows or LLOYD_ROWS).apply(points, step)


def _lloyd_in_rounds(points: DataFrame, groups: SpreadGroups, ks: Sequence[int], dimensions: int, max_rounds: int, tolerance: float) -> DataFrame:
    """The same for large ensembles: all numbers of clusters in one loop, whose centres are one short row per run.

    Points are only joined to centres, which are broadcast, and averaged before they are shuffled.
    """
    start = points.where(F.col("rank") <= max(ks)).groupBy("ensemble_id").agg(F.sort_array(F.collect_list(F.struct("rank", "features"))).alias("c"))
    start = start.select("ensemble_id", F.transform("c", lambda c: c["features"]).alias("all"), F.explode(F.array(*map(F.lit, ks))).alias("k"))
    centres = cut_lineage(start.select(*RUN, F.slice("all", 1, F.col("k")).alias("centres"), F.lit(True).alias("moving"), F.lit(0).alias("rounds")), "centres")

    def assigned(runs: DataFrame) -> DataFrame:
        joined = groups.attach(points, runs.select(*RUN, "centres"))
        squares = F.transform("centres", lambda c: square_distance(c, F.col("features")))
        nearest = joined.select(*MEMBER, "k", "features", squares.alias("squares"))
        least = F.array_min("squares")
        return nearest.select(*MEMBER, "k", "features", (F.array_position("squares", least) - 1).cast("int").alias("label"), least.alias("square"))

    for number in range(1, max_rounds + 1):
        moving = centres.where("moving")
        means = assigned(moving).groupBy(*RUN, "label").agg(F.array(*[F.avg(F.col("features")[i]) for i in range(dimensions)]).alias("mean"))
        new = means.groupBy(*RUN).agg(F.map_from_entries(F.collect_list(F.struct("label", "mean"))).alias("means"))
        # a cluster that lost all members keeps its centre
        moved = join_on(moving, new, RUN).select(
            *RUN, F.col("centres").alias("old"),
            F.transform("centres", lambda c, i: F.coalesce(F.try_element_at(F.col("means"), i), c)).alias("centres"))
        shift = F.array_max(F.zip_with("old", "centres", square_distance))
        moved = moved.select(*RUN, "centres", (shift > tolerance * tolerance).alias("moving"), F.lit(number).alias("rounds"))
        centres = cut_lineage(moved.unionByName(centres.where(~F.col("moving"))), "centres", replaces=centres)
        if centres.where("moving").isEmpty():
            break
    state = centres.select(*RUN, (~F.col("moving")).alias("converged"), "rounds")
    labelled = cut_lineage(assigned(centres), "labelled")
    own = square_distance(F.transform("features", lambda x: F.lit(0.0)), F.col("features"))
    moments = labelled.groupBy(*RUN, "label").agg(
        F.count("*").alias("n"), F.array(*[F.sum(F.col("features")[i]) for i in range(dimensions)]).alias("sum"), F.sum(own).alias("squares"))
    clusters = moments.groupBy(*RUN).agg(F.collect_list(F.struct("label", "n", "sum", "squares")).alias("clusters"))
    runs = join_on(state, clusters, RUN)
    scored = join_on(labelled, F.broadcast(runs), RUN)  # one row per oversized ensemble and number of clusters

    def mean_square(c: Column, n: Column) -> Column:
        product = F.aggregate(F.zip_with(c["sum"], "features", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        return (c["n"] * own + c["squares"] - 2 * product) / n

    mine = F.filter("clusters", lambda c: c["label"] == F.col("label"))[0]
    within = mean_square(mine, F.greatest(mine["n"] - 1, F.lit(1)))
    between = F.array_min(F.transform(F.filter("clusters", lambda c: c["label"] != F.col("label")), lambda c: mean_square(c, c["n"])))
    most = F.greatest("within", "between")
    score = F.when((F.size("clusters") < 2) | (mine["n"] == 1) | (most <= 0), 0.0).otherwise((F.col("between") - F.col("within")) / most)
    return scored.withColumns({"within": within, "between": between}).select(
        *MEMBER, "k", "label", "square", "converged", "rounds", score.alias("score"))


def kmeans(points: DataFrame, k: int, dimensions: int, max_rounds: int = 300, tolerance: float = 1e-6, task_rows: int | None = None) -> DataFrame:
    """Lloyd's algorithm per ensemble over ``features`` (an array of doubles); gives ``label`` and ``distance``.

    ``converged`` is false for the ensembles whose centres still moved in the last round, which ``rounds`` counts.
    It starts from the k members whose index has the lowest MD5 digests; a cluster that loses all members keeps its centre.
    """
    found = _clusters(points, [k], dimensions, max_rounds, tolerance, task_rows)
    return found.select(*MEMBER, "label", F.sqrt("square").alias("distance"), "converged", "rounds")


def kmeans_auto(
    points: DataFrame, dimensions: int, k_max: int = 8, max_rounds: int = 300, tolerance: float = 1e-6, task_rows: int | None = None,
) -> DataFrame:
    """k-means with the k of 2..k_max whose mean silhouette (by squared distances) is highest, the lower k of equals.

    A k of more than an ensemble's members isn't tried, but 2 always is; one member alone is one cluster.
    ``k_least`` and ``k_most`` are the range that was searched; ``converged`` and ``rounds`` are those of the chosen k.
    """
    found = cut_lineage(_clusters(points, list(range(2, k_max + 1)), dimensions, max_rounds, tolerance, task_rows), "runs")
    scores = found.groupBy(*RUN).agg(F.round(F.avg("score"), 9).alias("score"), F.count("*").alias("n"))
    fitting = scores.where((F.col("k") <= F.col("n")) | (F.col("k") == 2))
    best = cut_lineage(fitting.groupBy("ensemble_id").agg(F.min_by(F.struct("k", "score"), F.struct(-F.col("score"), "k")).alias("best")), "best")
    chosen = best.select("ensemble_id", F.col("best.k").alias("k"), F.col("best.score").alias("silhouette"))
    return join_on(found, chosen, RUN).select(
        *MEMBER, "label", F.sqrt("square").alias("distance"), "k", "silhouette", F.lit(2).alias("k_least"), F.lit(k_max).alias("k_most"), "converged", "rounds")


#: Tests of single members against each other for one pair of cells; beyond it both cells are halved first.
DIRECT = 1_000


def threshold_clusters(points: DataFrame, coordinates: list[str], cut: float, min_members: int = 1, max_rounds: int = 1000) -> DataFrame:
    """Clusters by real distance: single linkage at ``cut``, and with ``min_members`` above 1 a density clustering.

    A member is a core if at least ``min_members`` members, itself included, lie within ``cut`` of it. Cores within
    ``cut`` of each other share a cluster; another member joins the lowest cluster that has a core within ``cut``, or
    else is a cluster of its own. ``label`` is the lowest index of the cluster's cores.

    Rows are put in cells of width ``cut`` / sqrt(d), whose members are within ``cut`` of each other for certain.
    Two cells are linked if their nearest cores are close enough: boxes around the cores settle most pairs, small
    pairs are measured, and larger ones are halved until they are settled, so no large cell meets another whole.
    """
    cells = [f"cell_{i}" for i in range(len(coordinates))]
    width = cut / math.sqrt(len(coordinates)) * (1 - 1e-12)
    placed = cut_lineage(with_cells(points, [F.col(c) for c in coordinates], width), "placed")
    cores = _cores(placed, coordinates, cells, cut, min_members)
    counted = cut_lineage(cores.groupBy("ensemble_id", *cells).agg(F.min("conf_idx").alias("node")), "cells")
    links = _linked_cells(cores.join(counted, ["ensemble_id", *cells]), coordinates, cells, cut, width)
    labels = lowest_labels(counted.select("ensemble_id", "node"), links, max_rounds)
    named = counted.join(labels, ["ensemble_id", "node"]).select("ensemble_id", *cells, "label")
    labelled = cores.join(named, ["ensemble_id", *cells])
    if min_members == 1:
        return labelled.select(*points.columns, "label")
    labelled = cut_lineage(labelled, "labelled_cores")
    others = placed.join(cores.select(*MEMBER), MEMBER, "left_anti")
    near = _around(others, labelled, coordinates, cells, cut).groupBy(*MEMBER).agg(F.min("label").alias("label"))
    rest = others.join(near, MEMBER, "left").withColumn("label", F.coalesce("label", "conf_idx"))
    return labelled.select(*points.columns, "label").unionByName(rest.select(*points.columns, "label"))


def lowest_labels(nodes: DataFrame, links: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """ensemble_id, node, label: the lowest node that links (ensemble_id, node, other; both ways) lead to, step by step."""
    labels = before = cut_lineage(nodes.select("ensemble_id", "node", F.col("node").alias("label")), "labels")
    for _ in range(max_rounds):
        around = join_on(links, labels.withColumnRenamed("node", "other"), ["ensemble_id", "other"]).groupBy("ensemble_id", "node").agg(
            F.min("label").alias("seen"))
        lowered = join_on(labels, around, ["ensemble_id", "node"], "left").select(
            "ensemble_id", "node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        # then take the label of the label, which halves the remaining way
        jump = lowered.select("ensemble_id", F.col("node").alias("label"), F.col("label").alias("further"))
        lowered = cut_lineage(
            join_on(lowered, jump, ["ensemble_id", "label"]).select(
                "ensemble_id", "node", "old", F.least("label", "further").alias("label")), "labels", replaces=before)
        before = lowered
        labels = lowered.select("ensemble_id", "node", "label")
        if lowered.where(F.col("old") != F.col("label")).isEmpty():
            return labels
    raise RuntimeError(f"clusters still grow after {max_rounds} rounds")


def _steps(cells: list[str]) -> list[tuple[int, ...]]:
    """The moves to cells that may hold members within the cut."""
    reach = math.ceil(math.sqrt(len(cells)))
    return [s for s in itertools.product(range(-reach, reach + 1), repeat=len(cells)) if any(s)]


def _around(few: DataFrame, many: DataFrame, coordinates: list[str], cells: list[str], cut: float) -> DataFrame:
    """Rows of ``few`` with the label of each row of ``many`` within the cut, in their own and the nearby cells.

    ``few`` are members that aren't cores, of which a cell has fewer than a core needs neighbours.
    """
    moves = F.array(*[F.struct(*[(F.col(c) + d).alias(c) for c, d in zip(cells, step)]) for step in [(0,) * len(cells), *_steps(cells)]])
    spread = few.select(*MEMBER, *[F.col(c).alias(f"_{c}") for c in coordinates], F.explode(moves).alias("c")).select(
        *MEMBER, *[f"_{c}" for c in coordinates], "c.*")
    label = "label" if "label" in many.columns else "conf_idx"
    wide = many.select("ensemble_id", *cells, *coordinates, F.col(label).alias("label"))
    square = sum(((F.col(c) - F.col(f"_{c}")) * (F.col(c) - F.col(f"_{c}")) for c in coordinates), F.lit(0.0))
    return spread.join(wide, ["ensemble_id", *cells]).where(square <= cut * cut).select(*MEMBER, "label")


def _cores(placed: DataFrame, coordinates: list[str], cells: list[str], cut: float, min_members: int) -> DataFrame:
    if min_members <= 1:
        return placed
    full = placed.groupBy("ensemble_id", *cells).agg(F.count("*").alias("n"))
    sized = cut_lineage(placed.join(full, ["ensemble_id", *cells]), "sized")
    sparse = sized.where(F.col("n") < min_members).drop("n")
    counts = _around(sparse, placed, coordinates, cells, cut).groupBy(*MEMBER).agg(F.count("*").alias("n_near"))
    dense = sparse.join(counts.where(F.col("n_near") >= min_members).select(*MEMBER), MEMBER, "left_semi")
    return cut_lineage(sized.where(F.col("n") >= min_members).drop("n").unionByName(dense), "cores")


def _linked_cells(cores: DataFrame, coordinates: list[str], cells: list[str], cut: float, width: float) -> DataFrame:
    """Pairs (ensemble_id, node, other), both ways, of cells whose nearest cores are within the cut."""
    columns = ["ensemble_id", "node", *[F.col(c).alias(f"x{i}") for i, c in enumerate(coordinates)]]
    rows = cut_lineage(cores.select(*columns, *cells), "core_points")
    xs = [f"x{i}" for i in range(len(coordinates))]
    parts = [f"part_{i}" for i in range(len(xs))]
    moves = F.array(*[F.struct(*[(F.col(c) + d).alias(c) for c, d in zip(cells, step)]) for step in _steps(cells)])
    nodes = rows.select("ensemble_id", "node", *cells).distinct()
    reach = nodes.select("ensemble_id", "node", F.explode(moves).alias("c")).select("ensemble_id", "node", "c.*")
    pairs = reach.join(nodes.withColumnRenamed("node", "other"), ["ensemble_id", *cells]).where("node < other").select("ensemble_id", "node", "other")
    whole = [F.lit(0).cast("long").alias(p) for p in parts]
    open_pairs = pairs.select("*", *[p.alias(f"a_{n}") for p, n in zip(whole, parts)], *[p.alias(f"b_{n}") for p, n in zip(whole, parts)])
    found: list[DataFrame] = []
    for level in itertools.count():
        size = width / 2**level
        # a cell's corner, so that halves lie inside their cell
        inside = [
            F.greatest(F.lit(0), F.least(F.lit(2**level - 1), F.floor((F.col(x) - F.col(c) * width) / size))).cast("long") for x, c in zip(xs, cells)
        ]
        located = rows.withColumns(dict(zip(parts, inside)))
        boxes = located.groupBy("ensemble_id", "node", *parts).agg(
            F.count("*").alias("n"), *[f(x).alias(f"{k}_{x}") for x in xs for k, f in (("low", F.min), ("high", F.max))])
        sides = []
        for side, node in (("a", "node"), ("b", "other")):
            sides.append(boxes.select("ensemble_id", F.col("node").alias(node), *[F.col(p).alias(f"{side}_{p}") for p in parts], F.col("n").alias(f"{side}_n"),
                                      *[F.col(f"{k}_{x}").alias(f"{side}_{k}_{x}") for x in xs for k in ("low", "high")]))
        met = open_pairs.join(sides[0], ["ensemble_id", "node", *[f"a_{p}" for p in parts]]).join(
            sides[1], ["ensemble_id", "other", *[f"b_{p}" for p in parts]])
        gap = [F.greatest(F.col(f"a_low_{x}") - F.col(f"b_high_{x}"), F.col(f"b_low_{x}") - F.col(f"a_high_{x}"), F.lit(0.0)) for x in xs]
        span = [F.greatest(F.col(f"a_high_{x}") - F.col(f"b_low_{x}"), F.col(f"b_high_{x}") - F.col(f"a_low_{x}")) for x in xs]
        least, most = (sum((d * d for d in ds), F.lit(0.0)) for ds in (gap, span))
        met = cut_lineage(met.withColumns({"least": least, "most": most}).where(F.col("least") <= cut * cut), "box_pairs")
        key = ["ensemble_id", "node", "other"]
        sure = met.where(F.col("most") <= cut * cut).select(*key).distinct()
        unsure = met.where(F.col("most") > cut * cut).join(sure, key, "left_anti")
        direct = unsure.where(F.col("a_n") * F.col("b_n") <= DIRECT)
        left = located.select("ensemble_id", "node", *[F.col(p).alias(f"a_{p}") for p in parts], *[F.col(x).alias(f"a_{x}") for x in xs])
        right = located.select("ensemble_id", F.col("node").alias("other"), *[F.col(p).alias(f"b_{p}") for p in parts], *[F.col(x).alias(f"b_{x}") for x in xs])
        measured = direct.select(*key, *[f"{s}_{p}" for s in "ab" for p in parts]).join(
            left, ["ensemble_id", "node", *[f"a_{p}" for p in parts]]).join(right, ["ensemble_id", "other", *[f"b_{p}" for p in parts]])
        square = sum(((F.col(f"a_{x}") - F.col(f"b_{x}")) * (F.col(f"a_{x}") - F.col(f"b_{x}")) for x in xs), F.lit(0.0))
        near = measured.where(square <= cut * cut).select(*key).distinct()
        settled = cut_lineage(sure.unionByName(near).distinct(), "cell_links")
        found.append(settled)
        wide = unsure.where(F.col("a_n") * F.col("b_n") > DIRECT).join(settled, key, "left_anti")
        if wide.isEmpty():
            break
        halves = wide.select(*key, *[f"{s}_{p}" for s in "ab" for p in parts])
        for s in "ab":
            for p in parts:
                halves = halves.withColumn(f"{s}_{p}", F.explode(F.array(F.col(f"{s}_{p}") * 2, F.col(f"{s}_{p}") * 2 + 1)))
        open_pairs = cut_lineage(halves, "open_pairs")
    links = union(found).distinct()
    return cut_lineage(links.unionByName(links.select("ensemble_id", F.col("other").alias("node"), F.col("node").alias("other"))), "links")


def centroid_distances(labelled: DataFrame, features: list[str]) -> DataFrame:
    """Distance of each member to its cluster's mean, to choose representatives by."""
    means = labelled.groupBy("ensemble_id", "label").agg(*[F.avg(f).alias(f"mean_{f}") for f in features])
    joined = labelled.join(means, ["ensemble_id", "label"])
    total = sum(((F.col(f) - F.col(f"mean_{f}")) ** 2 for f in features), F.lit(0.0))
    return joined.select(*MEMBER, "label", F.sqrt(total).alias("distance"))
