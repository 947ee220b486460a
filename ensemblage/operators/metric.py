"""Clusters of conformers by a distance between shapes instead of coordinates of points.

The distances are this library's own: ``rmsd`` of the centred atoms as they stand, ``rotcorr_rmsd`` after the best
rotation, ``moi`` the largest difference between logarithms of principal moments, and ``mix`` the mean of the last two.
All obey the triangle inequality, so distances to a few landmarks bound a distance from below: they are coordinates that
tell which pairs are worth measuring. Conformers of different formula are never near each other.

Clusters are those of single linkage at ``cut``, named by their lowest index. Small ensembles are measured pair
by pair, many at once; an ensemble that fits a task is searched there from member to member. Of a larger one a net is kept, in which each member has a leader within half the cut; leaders
within the cut are linked, and of leaders up to twice the cut apart that aren't in one cluster yet, members are measured in
blocks. That last step can be quadratic in the members of such leaders, and of nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ensemblage.operators import geometry
from ensemblage.operators.clustering import lowest_labels
from ensemblage.operators.geometry import MEMBER
from ensemblage.operators.groups import SpreadGroups, TaskGroups, join_on, plan_groups
from ensemblage.session import cut_lineage

METRICS = ("rmsd", "moi", "rotcorr_rmsd", "mix")
#: Members of an ensemble that one task searches, and of a block of a leader's members.
SEARCH_ROWS = 2_000
BLOCK_ROWS = 500
#: Members of an ensemble of which all pairs of one formula are measured, together with those of other ensembles.
PAIRED_ROWS = 64
LANDMARKS = 3
#: Moments below this, as those of atoms in a line, are taken for it.
LEAST_MOMENT = 1e-3
LOGS = ["log_a", "log_b", "log_c"]
PAYLOAD = ["xyz", "formula", *LOGS]


def shapes(atoms: DataFrame) -> DataFrame:
    """ensemble_id, conf_idx, xyz, formula and logarithms of the moments of each conformer."""
    logs = [F.log(F.greatest(F.col(f"moment_{n}"), F.lit(LEAST_MOMENT))).alias(f"log_{n}") for n in "abc"]
    return geometry.moments(atoms, geometry.listed()).select(*MEMBER, *geometry.listed_coordinates(), *logs)


def distances(metric: str, left: np.ndarray, right: np.ndarray, left_logs: np.ndarray, right_logs: np.ndarray) -> np.ndarray:
    """Distances of pairs: coordinates (pairs, atoms, 3) and logarithms of moments (pairs, 3)."""
    if metric == "rmsd":
        gap = left - left.mean(axis=1, keepdims=True) - right + right.mean(axis=1, keepdims=True)
        return np.sqrt((gap**2).sum(axis=(1, 2)) / left.shape[1])
    if metric == "moi":
        return np.abs(left_logs - right_logs).max(axis=1)
    turned = geometry.superposed_rmsd(left, right)
    return turned if metric == "rotcorr_rmsd" else (turned + np.abs(left_logs - right_logs).max(axis=1)) / 2


class _Shapes:
    """The rows of a frame as arrays per formula, to be measured against one or many."""

    def __init__(self, frame: pd.DataFrame, metric: str, prefix: str = "") -> None:
        self.metric = metric
        self.formula = frame[f"{prefix}formula"].to_numpy()
        self.logs = frame[[f"{prefix}{c}" for c in LOGS]].to_numpy(float)
        xyz = frame[f"{prefix}xyz"].to_numpy()
        self.length = np.fromiter(map(len, xyz), np.int64, len(xyz))
        self.start = np.cumsum(self.length) - self.length
        self.xyz = np.concatenate(xyz).astype(float, copy=False) if len(xyz) else np.zeros(0)

    def solid(self, rows: np.ndarray) -> np.ndarray:
        """The coordinates of rows with as many atoms each."""
        return self.xyz[self.start[rows][:, None] + np.arange(self.length[rows[0]])].reshape(len(rows), -1, 3)

    def measured(self, rows: np.ndarray, other: _Shapes, other_rows: np.ndarray) -> np.ndarray:
        """Distance of each of ``rows`` to the row of ``other`` beside it; infinite where formulas differ."""
        found = np.full(len(rows), np.inf)
        same = np.flatnonzero((self.formula[rows] == other.formula[other_rows]) & (self.length[rows] == other.length[other_rows]))
        for length in np.unique(self.length[rows[same]]):
            at = same[self.length[rows[same]] == length]
            found[at] = distances(self.metric, self.solid(rows[at]), other.solid(other_rows[at]), self.logs[rows[at]], other.logs[other_rows[at]])
        return found

    def from_one(self, one: int, rows: np.ndarray) -> np.ndarray:
        return self.measured(rows, self, np.full(len(rows), one))

    def beside(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        return self.measured(rows, self, others)


def searched(frame: pd.DataFrame, metric: str, cut: float) -> np.ndarray:
    """The lowest index of each row's cluster."""
    table, ids = _Shapes(frame, metric), frame["conf_idx"].to_numpy()
    everyone = np.arange(len(frame))
    marks = np.zeros((len(frame), LANDMARKS))
    for i, landmark in enumerate(np.random.default_rng(1).permutation(len(frame))[:LANDMARKS]):
        marks[:, i] = np.where((gap := table.from_one(landmark, everyone)) < np.inf, gap, 0)
    label = np.full(len(frame), -1)
    for start in np.argsort(ids, kind="stable"):
        if label[start] >= 0:
            continue
        label[start] = start
        queue = [start]
        while queue:
            one = queue.pop()
            rest = np.flatnonzero((label < 0) & (table.formula == table.formula[one]))
            rest = rest[(np.abs(marks[rest] - marks[one]) <= cut * (1 + 1e-9) + 1e-9).all(axis=1)]
            near = rest[table.from_one(one, rest) <= cut] if len(rest) else rest
            label[near] = start
            queue += list(near)
    return ids[label]


def searched_together(frame: pd.DataFrame, ensemble: np.ndarray, metric: str, cut: float) -> np.ndarray:
    """The row of the lowest index of each row's cluster, for all ensembles at once: small ones by all pairs of one formula."""
    label = np.arange(len(frame))
    order = np.lexsort((frame["conf_idx"].to_numpy(), ensemble))
    sizes = np.bincount(ensemble)
    for large in np.flatnonzero(sizes > PAIRED_ROWS):
        rows = order[ensemble[order] == large]
        ids = frame["conf_idx"].to_numpy()[rows]
        label[rows] = rows[np.searchsorted(ids, searched(frame.iloc[rows], metric, cut))]
    small = order[sizes[ensemble[order]] <= PAIRED_ROWS]
    table = _Shapes(frame, metric)
    kind = np.unique(table.formula[small].astype(str), return_inverse=True)[1]
    by_kind = np.lexsort((kind, ensemble[small]))  # members of one formula stand together, in order of their indexes
    small, kind = small[by_kind], kind[by_kind]
    group = np.cumsum(np.append(0, (kind[1:] != kind[:-1]) | (ensemble[small[1:]] != ensemble[small[:-1]])))[: len(small)]
    links = [np.zeros((0, 2), np.int64)]
    for step in range(1, np.bincount(group).max(initial=1)):
        at = np.flatnonzero(group[step:] == group[:-step])
        if metric in ("moi", "mix"):  # which the difference of moments alone may exceed
            apart = np.abs(table.logs[small[at]] - table.logs[small[at + step]]).max(axis=1)
            at = at[apart <= (cut if metric == "moi" else 2 * cut) * (1 + 1e-9) + 1e-9]
        at = at[table.beside(small[at], small[at + step]) <= cut]
        links.append(np.stack([at, at + step], axis=1))
    one, other = np.concatenate(links).T
    place = np.arange(len(small))
    while (place[one] != place[other]).any():  # the lower of both ends' first places becomes the first of both
        left, right = place[one], place[other]
        np.minimum.at(place, np.concatenate([left, right]), np.tile(np.minimum(left, right), 2))
        while (place[place] != place).any():
            place = place[place]
    label[small] = small[place]
    return label


def metric_clusters(points: DataFrame, cut: float, metric: str = "mix", task_rows: int | None = None) -> DataFrame:
    """ensemble_id, conf_idx, label of ``shapes``: clusters by single linkage at ``cut`` under a metric."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    points = cut_lineage(points.select(*MEMBER, *PAYLOAD), "shapes")  # counted first, then searched
    kinds = [points.schema[c].dataType.simpleString() for c in MEMBER]
    schema = f"ensemble_id {kinds[0]}, conf_idx {kinds[1]}, label {kinds[1]}"
    limit = task_rows or geometry.walk_limit(points, SEARCH_ROWS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ensemble in geometry.whole_ensembles(batches):
            label = searched_together(table.drop(["ensemble_id"]).to_pandas(), ensemble, metric, cut)
            ids, confs = (table[c].combine_chunks() for c in MEMBER)
            yield pa.RecordBatch.from_arrays([ids, confs, confs.take(pa.array(label))], names=[*MEMBER, "label"])

    def step(rows: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        if isinstance(groups, TaskGroups):
            return rows.repartition("ensemble_id").sortWithinPartitions("ensemble_id").mapInArrow(search, schema)
        return _by_net(rows, groups, cut, metric, limit)

    return plan_groups(points, ("ensemble_id",), limit).apply(points, step)


def _landmarked(rows: DataFrame, groups: SpreadGroups, metric: str) -> DataFrame:
    """``mark_0`` and so on: distances to a few conformers with the lowest digests of their indexes, 0 to other formulas."""
    order = [F.md5(F.col("conf_idx").cast("string").cast("binary")), F.col("conf_idx")]
    first = cut_lineage(groups.ordinal(rows.select(*MEMBER), "_mark", order).where(F.col("_mark") <= LANDMARKS), "landmarks")
    chosen = join_on(rows, first, MEMBER)
    listed = chosen.groupBy("ensemble_id").agg(F.sort_array(F.collect_list(F.struct("_mark", *PAYLOAD))).alias("marks"))
    joined = groups.attach(rows, cut_lineage(listed, "landmarks"))
    kept = rows.columns
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept], *[f"mark_{i} double" for i in range(LANDMARKS)]])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table, found = _Shapes(batch, metric), {}
            for i in range(LANDMARKS):
                marks = pd.DataFrame([m[min(i, len(m) - 1)] if not hasattr(m[0], "asDict") else m[min(i, len(m) - 1)].asDict() for m in batch["marks"]])
                gaps = table.measured(np.arange(len(batch)), _Shapes(marks, metric), np.arange(len(batch))) if len(batch) else np.zeros(0)
                found[f"mark_{i}"] = np.where(gaps < np.inf, gaps, 0.0)
            yield batch[kept].assign(**found)

    return cut_lineage(joined.mapInPandas(measure, schema), "landmarked")


def _measured_pairs(pairs: DataFrame, metric: str, most: float, keys: list[str]) -> DataFrame:
    """``keys`` and gap of the rows whose shapes ``l_*`` and ``r_*`` are at most ``most`` apart."""
    schema = ", ".join([*[f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys], "gap double"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.arange(len(batch))
            gap = _Shapes(batch, metric, "l_").measured(rows, _Shapes(batch, metric, "r_"), rows) if len(batch) else np.zeros(0)
            yield batch[keys].assign(gap=gap)[gap <= most]

    return pairs.select(*keys, *[f"{s}_{c}" for s in "lr" for c in PAYLOAD]).mapInPandas(measure, schema)


def _by_net(rows: DataFrame, groups: SpreadGroups, cut: float, metric: str, run_rows: int) -> DataFrame:
    marks = [f"mark_{i}" for i in range(LANDMARKS)]
    half, slack = cut / 2, 1 + 1e-9
    placed = _landmarked(rows, groups, metric)

    def keep_same(candidates: DataFrame) -> DataFrame:
        near = F.col("formula") == F.col("kept_formula")
        for mark in marks:
            near = near & (F.abs(F.col(mark) - F.col(f"kept_{mark}")) <= half * slack + 1e-9)
        shown = candidates.where(near).withColumn("kept_place", F.to_json("kept_place"))
        pairs = shown.select(*MEMBER, "kept_idx", "kept_place", *[F.col(c).alias(f"l_{c}") for c in PAYLOAD], *[F.col(f"kept_{c}").alias(f"r_{c}") for c in PAYLOAD])
        kind = candidates.schema["kept_place"].dataType
        return _measured_pairs(pairs, metric, half, [*MEMBER, "kept_idx", "kept_place"]).withColumn("kept_place", F.from_json("kept_place", kind))

    def same(frame: pd.DataFrame, kept: np.ndarray, others: np.ndarray) -> np.ndarray:
        table = _Shapes(frame, metric)
        place = frame[marks].to_numpy()
        near = (table.formula[others] == table.formula[kept]) & (np.abs(place[others] - place[kept]) <= half * slack + 1e-9).all(axis=1)
        rows = np.flatnonzero(near)
        if len(rows):
            near[rows] = table.beside(others[rows], kept[rows]) <= half
        return near

    # all are members of one walk in order of their indexes
    walked = placed.withColumn("energy_kcal", F.lit(None).cast("double"))
    net = geometry.greedy_duplicates(walked, [F.col(m) for m in marks], half * slack + 1e-9, keep_same, [*PAYLOAD, *marks], same, run_rows)
    led = cut_lineage(join_on(placed, net, MEMBER), "led")
    leaders = geometry.with_cells(led.where("conf_idx = kept_idx"), [F.col(m) for m in marks], 2 * cut * slack + 1e-9)
    leaders = cut_lineage(leaders, "leaders")
    cells = [f"cell_{i}" for i in range(LANDMARKS)]
    left = leaders.select("ensemble_id", F.col("conf_idx").alias("node"), *[F.col(c).alias(f"l_{c}") for c in [*PAYLOAD, *marks]],
                          F.explode(geometry.neighbour_cells(cells)).alias("c"))
    left = left.select("*", "c.*").drop("c")
    right = leaders.select("ensemble_id", F.col("conf_idx").alias("other"), *[F.col(c).alias(f"r_{c}") for c in [*PAYLOAD, *marks]], *cells)
    near = (F.col("node") < F.col("other")) & (F.col("l_formula") == F.col("r_formula"))
    for mark in marks:
        near = near & (F.abs(F.col(f"l_{mark}") - F.col(f"r_{mark}")) <= 2 * cut * slack + 1e-9)
    key = ["ensemble_id", "node", "other"]
    around = cut_lineage(_measured_pairs(join_on(left, right, ["ensemble_id", *cells]).where(near), metric, 2 * cut, key), "around")
    nodes = leaders.select("ensemble_id", F.col("conf_idx").alias("node"))
    sure = around.where(F.col("gap") <= cut).select(*key)
    labels = _labels(nodes, sure)
    # the rest: leaders of different clusters whose members may still be near each other
    for side in ("node", "other"):
        around = join_on(around, labels.select("ensemble_id", F.col("node").alias(side), F.col("label").alias(f"{side}_label")), ["ensemble_id", side])
    unsure = cut_lineage(around.where((F.col("gap") > cut) & (F.col("node_label") != F.col("other_label"))).select(*key), "unsure")
    if not unsure.isEmpty():
        blocks = led.withColumn("block", F.pmod(F.xxhash64("conf_idx"), F.lit(1 << 20)))
        sizes = led.groupBy("ensemble_id", "kept_idx").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        dealt = cut_lineage(join_on(blocks, sizes, ["ensemble_id", "kept_idx"]).withColumn("block", F.col("block") % F.col("blocks")), "dealt")
        ends = {}
        for side, name in (("node", "l"), ("other", "r")):
            counts = sizes.select("ensemble_id", F.col("kept_idx").alias(side), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(f"{name}_block"))
            unsure = join_on(unsure, counts, ["ensemble_id", side])
            ends[side] = dealt.select("ensemble_id", F.col("kept_idx").alias(side), F.col("block").alias(f"{name}_block"), *[F.col(c).alias(f"{name}_{c}") for c in [*PAYLOAD, *marks]])
        met = join_on(unsure, ends["node"], ["ensemble_id", "node", "l_block"])
        met = join_on(met, ends["other"], ["ensemble_id", "other", "r_block"])
        close = F.lit(True)
        for mark in marks:
            close = close & (F.abs(F.col(f"l_{mark}") - F.col(f"r_{mark}")) <= cut * slack + 1e-9)
        more = _measured_pairs(met.where(close), metric, cut, key).select(*key).distinct()
        labels = _labels(nodes, sure.unionByName(cut_lineage(more, "more_links")))
    named = labels.select("ensemble_id", F.col("node").alias("kept_idx"), "label")
    return join_on(led.select(*MEMBER, "kept_idx"), named, ["ensemble_id", "kept_idx"]).select(*MEMBER, "label")


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select("ensemble_id", F.col("other").alias("node"), F.col("node").alias("other")))
    return lowest_labels(nodes, cut_lineage(both.distinct(), "links"))
