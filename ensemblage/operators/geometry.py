"""Geometric descriptors and duplicate removal without ever forming all pairs of a group.

A conformer is a point of a few invariants; two duplicates differ by at most a tolerance in each. Cells of
that width hold a conformer's possible duplicates in the cell itself and its neighbours. The numeric
definitions (relative moment deviation, superposed RMSD) and their defaults are this library's own.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.functions import constants as K
from ensemblage.functions.scalars import named
from ensemblage.operators.groups import SpreadGroups, TaskGroups, join_on, plan_groups
from ensemblage.session import cut_lineage

MEMBER = ["ensemble_id", "conf_idx"]
MOMENT_TOLERANCE = 0.01
RMSD_TOLERANCE = 0.25
ENERGY_GATE_KCAL = 0.5
#: Conformers of an ensemble that one task walks through; larger ensembles go through in runs of as many.
WALK_ROWS = 20_000


def eigenvalues(xx: Column, yy: Column, zz: Column, xy: Column, xz: Column, yz: Column) -> list[Column]:
    """Ascending eigenvalues of a symmetric 3x3 matrix in closed form."""
    q = (xx + yy + zz) / 3
    off = xy * xy + xz * xz + yz * yz
    p = F.sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * off) / 6)
    a, b, c = xx - q, yy - q, zz - q
    det = a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz)
    r = F.when(p > 0, det / (2 * p * p * p)).otherwise(F.lit(1.0))
    phi = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))) / 3
    high = q + 2 * p * F.cos(phi)
    low = q + 2 * p * F.cos(phi + 2 * math.pi / 3)
    return [low, 3 * q - high - low, high]


def _scatter(mass: Column) -> list[Column]:
    axes = {"x": F.col("x"), "y": F.col("y"), "z": F.col("z")}
    sums = [F.sum(mass).alias("w"), F.count("*").alias("n_atoms")]
    sums += [F.sum(mass * v).alias(f"s{a}") for a, v in axes.items()]
    sums += [F.sum(mass * axes[a] * axes[b]).alias(f"s{a}{b}") for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")]
    return sums


def _central(a: str, b: str) -> Column:
    return F.col(f"s{a}{b}") - F.col(f"s{a}") * F.col(f"s{b}") / F.col("w")


def moments(atoms: DataFrame, *more: Column) -> DataFrame:
    """Principal moments of inertia per conformer, from sums in one aggregation; unknown elements count 0. ``more`` are further aggregates."""
    mass = F.coalesce(named(F.col("element"), K.ATOMIC_MASS), F.lit(0.0))
    sums = atoms.groupBy(*MEMBER).agg(*_scatter(mass), *more)
    xx, yy, zz = _central("x", "x"), _central("y", "y"), _central("z", "z")
    tensor = eigenvalues(yy + zz, xx + zz, xx + yy, -_central("x", "y"), -_central("x", "z"), -_central("y", "z"))
    return sums.select(*MEMBER, *[m.alias(f"moment_{n}") for n, m in zip("abc", tensor)], *sums.columns[len(sums.columns) - len(more):])


def spreads(atoms: DataFrame) -> DataFrame:
    """Singular values of the centred coordinates over sqrt(n): no two conformers of one molecule differ in
    them by more than their superposed RMSD, whichever way they are turned."""
    sums = atoms.groupBy(*MEMBER).agg(*_scatter(F.lit(1.0)))
    c = {p: _central(*p) / F.col("w") for p in ("xx", "yy", "zz", "xy", "xz", "yz")}
    values = eigenvalues(c["xx"], c["yy"], c["zz"], c["xy"], c["xz"], c["yz"])
    return sums.select(*MEMBER, *[F.sqrt(F.greatest(v, F.lit(0.0))).alias(f"spread_{n}") for n, v in zip("abc", values)])


def with_cells(points: DataFrame, coordinates: list[Column], width: float) -> DataFrame:
    return points.withColumns({f"cell_{i}": F.floor(c / width).cast("long") for i, c in enumerate(coordinates)})


def neighbour_cells(cells: list[str]) -> Column:
    """All cells that touch a cell, itself included."""
    steps = itertools.product((-1, 0, 1), repeat=len(cells))
    return F.array(*[F.struct(*[(F.col(c) + s).alias(c) for c, s in zip(cells, step)]) for step in steps])


#: Says which of the rows ``others`` of a frame are duplicates of the row of ``kept`` beside them.
Same = Callable[[pd.DataFrame, np.ndarray, np.ndarray], np.ndarray]


def greedy_duplicates(
    points: DataFrame,
    coordinates: list[Column],
    width: float,
    keep_same: Callable[[DataFrame], DataFrame],
    payload: list[str],
    same: Same,
    task_rows: int | None = None,
    prepare: Callable[[DataFrame, SpreadGroups], DataFrame] | None = None,
) -> DataFrame:
    """Walk each ensemble by energy (unknown last), then index; drop whoever has a kept duplicate before them.

    ``points`` has ``energy_kcal`` and the ``payload`` columns. Gives ``kept_idx`` per conformer, the first kept one that
    it duplicates, its own index where it is kept. An ensemble of up to ``task_rows`` conformers is walked through by one
    task, which compares each kept conformer with all that come after it at once (``same``), however many of them differ, and
    does so for all ensembles of a batch at once, so that small ones cost no call each. Larger ensembles go through in runs of that many conformers; ``prepare`` may add columns for their ``coordinates``,
    and ``keep_same`` reduces candidate rows.
    """
    points = points.select(*MEMBER, "energy_kcal", *[p for p in payload if p != "energy_kcal"])
    schema = "ensemble_id {0}, conf_idx {1}, kept_idx {1}".format(*[points.schema[c].dataType.simpleString() for c in MEMBER])
    task_rows = task_rows or WALK_ROWS

    def walked(table: pa.Table, ensemble: np.ndarray) -> pa.RecordBatch:
        frame = table.drop(["ensemble_id"]).to_pandas()
        energy, index = frame["energy_kcal"].to_numpy(float, na_value=np.nan), frame["conf_idx"].to_numpy()
        kept = np.full(len(frame), -1)
        rest = np.lexsort((index, energy, np.isnan(energy), ensemble))
        while len(rest):
            head = np.append(True, ensemble[rest[1:]] != ensemble[rest[:-1]])
            heads = rest[head]
            kept[heads] = heads
            beside, rest = heads[np.cumsum(head) - 1][~head], rest[~head]
            near = same(frame, beside, rest) if len(rest) else np.zeros(0, bool)
            kept[rest[near]] = beside[near]
            rest = rest[~near]
        ids, confs = (table[c].combine_chunks() for c in MEMBER)
        return pa.RecordBatch.from_arrays([ids, confs, confs.take(pa.array(kept))], names=[*MEMBER, "kept_idx"])

    def walk_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ensemble in whole_ensembles(batches):
            yield walked(table, ensemble)

    def walk(rows: DataFrame) -> DataFrame:
        return rows.repartition("ensemble_id").sortWithinPartitions("ensemble_id").mapInArrow(walk_sorted, schema)

    def step(rows: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        if isinstance(groups, TaskGroups):
            return walk(rows)
        ready = prepare(rows, groups) if prepare else rows
        return _in_runs(ready, groups, coordinates, width, keep_same, payload, task_rows, walk)

    return plan_groups(points, ("ensemble_id",), task_rows).apply(points, step)


def whole_ensembles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole ensembles out of batches sorted by ensemble, and the number of each row's ensemble in its table."""
    held: pa.Table | None = None  # the last ensemble may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        one = pa.Table.from_batches([batch])
        table = one if held is None else pa.concat_tables([held, one])
        ensemble = _numbers(table)
        start = int(np.searchsorted(ensemble, ensemble[-1]))
        held = table.slice(start)
        if start:
            yield table.slice(0, start), ensemble[:start]
    if held is not None:
        yield held, np.zeros(held.num_rows, np.int64)


def _numbers(table: pa.Table) -> np.ndarray:
    """Of each row the number of its ensemble, counted in the order of the rows, which are sorted by it."""
    return table["ensemble_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _gate(frame: pd.DataFrame, kept: np.ndarray, others: np.ndarray, max_gap_kcal: float | None) -> np.ndarray:
    if max_gap_kcal is None:
        return np.ones(len(others), bool)
    energy = frame["energy_kcal"].to_numpy(float, na_value=np.nan)
    gap = np.abs(energy[others] - energy[kept])
    return np.isnan(gap) | (gap <= max_gap_kcal)


def _in_runs(
    points: DataFrame, groups: SpreadGroups, coordinates: list[Column], width: float, keep_same: Callable[[DataFrame], DataFrame], payload: list[str],
    run_rows: int, walk: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The walk for large ensembles, in runs of ``run_rows`` conformers by energy, whatever they look like.

    Duplicates are at most ``width`` apart in every coordinate. A run first meets, in the cells around, the conformers
    that the runs before have kept, which differ from each other, so a cell holds few of them; ``keep_same`` gets candidate
    rows with the kept conformer's payload as ``kept_*``. What is left of the run is walked through by one task.
    """
    cells = [f"cell_{i}" for i in range(len(coordinates))]
    place = F.struct(F.col("energy_kcal").isNull().alias("unknown"), F.col("energy_kcal").alias("energy"), F.col("conf_idx").alias("conf"))
    columns = [*MEMBER, "energy_kcal", *[p for p in payload if p != "energy_kcal"]]
    numbered = groups.ordinal(points, "_n", [F.col("energy_kcal").asc_nulls_last(), F.col("conf_idx")])
    placed = with_cells(numbered, coordinates, width).withColumns({"place": place, "run": F.floor((F.col("_n") - 1) / run_rows)})
    placed = cut_lineage(placed.select(*columns, *cells, "place", "run"), "placed")
    runs = placed.agg(F.max("run")).first()[0] + 1
    kept: list[DataFrame] = []
    decided: list[DataFrame] = []
    for number in range(runs):
        rows = placed.where(F.col("run") == number)
        if kept:
            around = union(kept).select(
                "ensemble_id", F.col("conf_idx").alias("kept_idx"), F.col("place").alias("kept_place"), *[F.col(p).alias(f"kept_{p}") for p in payload],
                F.explode(neighbour_cells(cells)).alias("c"))
            around = around.select("ensemble_id", "kept_idx", "kept_place", *[f"kept_{p}" for p in payload], "c.*")
            candidates = join_on(rows, around, ["ensemble_id", *cells])
            dropped = keep_same(candidates).groupBy(*MEMBER).agg(F.min_by("kept_idx", "kept_place").alias("kept_idx"))
            dropped = cut_lineage(dropped, "dropped")
            decided.append(dropped)
            rows = join_on(rows, dropped, MEMBER, "left_anti")
        walked = cut_lineage(walk(rows.select(*columns)), "walked")
        decided.append(walked)
        own = walked.where("kept_idx = conf_idx").select(*MEMBER)
        kept.append(cut_lineage(join_on(placed.where(F.col("run") == number), own, MEMBER, "left_semi"), "kept"))
        if len(decided) >= 40:
            decided, kept = [cut_lineage(union(decided), "decided")], [cut_lineage(union(kept), "kept")]
    return union(decided)


def union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def energy_gate(max_gap_kcal: float | None) -> Column:
    """Energies at most the gate apart; without a gate, or where one is unknown, any pair may be duplicates."""
    if max_gap_kcal is None:
        return F.lit(True)
    return F.coalesce(F.abs(F.col("energy_kcal") - F.col("kept_energy_kcal")) <= max_gap_kcal, F.lit(True))


def moment_duplicates(points: DataFrame, tolerance: float = MOMENT_TOLERANCE, max_gap_kcal: float | None = ENERGY_GATE_KCAL) -> DataFrame:
    """Duplicates by principal moments: each ratio within 1 - tolerance, in an energy gate."""
    width = -math.log1p(-tolerance)
    names = ["moment_a", "moment_b", "moment_c"]
    logs = [f"log_{n}" for n in names]
    points = points.withColumns({f"log_{n}": F.log(F.greatest(F.col(n), F.lit(1e-9))) for n in names})
    points = cut_lineage(points.select(*MEMBER, "energy_kcal", *logs), "points")  # counted first, then walked through

    def same_rows(candidates: DataFrame) -> DataFrame:
        near = energy_gate(max_gap_kcal)
        for name in logs:
            near = near & (F.abs(F.col(name) - F.col(f"kept_{name}")) <= width)
        return candidates.where(near)

    def same(frame: pd.DataFrame, kept: np.ndarray, others: np.ndarray) -> np.ndarray:
        near = _gate(frame, kept, others, max_gap_kcal)
        for name in logs:
            values = frame[name].to_numpy()
            near &= np.abs(values[others] - values[kept]) <= width
        return near

    return greedy_duplicates(points, [F.col(n) for n in logs], width, same_rows, ["energy_kcal", *logs], same)


def listed() -> Column:
    """The atoms of a conformer by index, gathered beside other aggregates."""
    return F.sort_array(F.collect_list(F.struct("atom_index", "element", "x", "y", "z"))).alias("listed")


def listed_coordinates() -> list[Column]:
    """``xyz``, a conformer's coordinates as one array in atom order, and ``formula``, of its ``listed`` atoms.

    Repeated rows of an atom are reduced to one first, so the array is as long as the molecule has atoms,
    which came out of one frame of one file.
    """
    def single(index: Column) -> Column:
        rows = F.filter("listed", lambda a: a["atom_index"].eqNullSafe(index))
        return F.struct(index.alias("atom_index"), *[F.array_min(F.transform(rows, lambda a: a[c])).alias(c) for c in ("element", "x", "y", "z")])

    indexes = F.array_distinct("listed.atom_index")
    atoms = F.when(F.size(indexes) == F.size("listed"), F.col("listed")).otherwise(F.transform(indexes, single))
    return [F.flatten(F.transform(atoms, lambda a: F.array(a["x"], a["y"], a["z"]))).alias("xyz"),
            F.array_join(F.transform(atoms, lambda a: a["element"]), " ").alias("formula")]


def coordinate_lists(atoms: DataFrame) -> DataFrame:
    """``xyz`` and ``formula`` of each conformer."""
    return atoms.groupBy(*MEMBER).agg(listed()).select(*MEMBER, *listed_coordinates())


def superposed_rmsd(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """RMSD of pairs of conformers (pairs, atoms, 3) after the best translation and rotation."""
    left = left - left.mean(axis=1, keepdims=True)
    right = right - right.mean(axis=1, keepdims=True)
    u, s, vt = np.linalg.svd(np.einsum("pai,paj->pij", left, right))
    s[:, 2] *= np.sign(np.linalg.det(u) * np.linalg.det(vt))
    total = (left**2).sum(axis=(1, 2)) + (right**2).sum(axis=(1, 2)) - 2 * s.sum(axis=1)
    return np.sqrt(np.maximum(total, 0.0) / left.shape[1])


#: Conformers whose distances are the rings of a large ensemble, and bytes of coordinates that a task may hold.
PIVOTS = 3
WALK_BYTES = 256 << 20


def rings(rows: DataFrame, groups: SpreadGroups) -> DataFrame:
    """``ring_0`` and so on: superposed RMSD to a few conformers of the ensemble, 0 to those of other atoms.

    That RMSD obeys the triangle inequality, so two conformers of one formula differ in no ring by more than their own.
    The pivots are those whose indexes have the lowest digests, one short row per oversized ensemble.
    """
    order = [F.md5(F.col("conf_idx").cast("string").cast("binary")), F.col("conf_idx")]
    first = groups.ordinal(rows.select(*MEMBER), "_pivot", order).where(F.col("_pivot") <= PIVOTS)
    chosen = join_on(rows.select(*MEMBER, "xyz", "formula"), cut_lineage(first, "pivots"), MEMBER)
    pivots = chosen.groupBy("ensemble_id").agg(F.sort_array(F.collect_list(F.struct("_pivot", "formula", "xyz"))).alias("p"))
    pivots = cut_lineage(pivots.select("ensemble_id", F.col("p.xyz").alias("pivot_xyz"), F.col("p.formula").alias("pivot_formula")), "pivots")
    joined = groups.attach(rows, pivots)
    names = [f"ring_{i}" for i in range(PIVOTS)]
    kept = rows.columns
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept], *[f"{n} double" for n in names]])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.zeros((len(batch), PIVOTS))
            for i, (xyz, formula, pivot_xyz, pivot_formula) in enumerate(
                zip(batch["xyz"], batch["formula"], batch["pivot_xyz"], batch["pivot_formula"], strict=True)):
                for j, (other, name) in enumerate(zip(pivot_xyz, pivot_formula, strict=True)):
                    if name == formula:
                        found[i, j] = superposed_rmsd(np.asarray(xyz, float).reshape(1, -1, 3), np.asarray(other, float).reshape(1, -1, 3))[0]
            yield batch[kept].assign(**{n: found[:, j] for j, n in enumerate(names)})

    return cut_lineage(joined.mapInPandas(measure, schema), "ringed")


def walk_limit(points: DataFrame, most: int) -> int:
    """Conformers that one task may walk through: at most ``most``, and as many as their coordinates leave room for."""
    longest = points.agg(F.max(F.size("xyz"))).first()[0] or 1
    return max(1, min(most, WALK_BYTES // (8 * longest)))


def rmsd_duplicates(
    points: DataFrame, tolerance: float = RMSD_TOLERANCE, max_gap_kcal: float | None = ENERGY_GATE_KCAL, task_rows: int | None = None,
) -> DataFrame:
    """Duplicates by superposed RMSD of conformers with the same atoms in the same order, in an energy gate.

    ``points`` has the spreads, ``xyz`` and ``formula`` of each conformer. Large ensembles are keyed by rings of distances
    to a few of their conformers.
    """
    spread = ["spread_a", "spread_b", "spread_c"]
    ring = [f"ring_{i}" for i in range(PIVOTS)]
    reach = tolerance * (1 + 1e-9) + 1e-9

    def same_rows(candidates: DataFrame) -> DataFrame:
        near = energy_gate(max_gap_kcal) & (F.col("formula") == F.col("kept_formula"))
        for name in spread:
            near = near & (F.abs(F.col(name) - F.col(f"kept_{name}")) <= reach)
        wanted = candidates.where(near).select(*MEMBER, "kept_idx", "kept_place", "xyz", "kept_xyz")
        schema = wanted.drop("xyz", "kept_xyz").schema

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                near = np.zeros(len(batch), dtype=bool)
                lengths = batch["xyz"].map(len).to_numpy()
                for length in np.unique(lengths):
                    rows = np.flatnonzero(lengths == length)
                    pair = [np.stack(batch[c].iloc[rows].to_numpy()).reshape(len(rows), -1, 3) for c in ("xyz", "kept_xyz")]
                    near[rows] = superposed_rmsd(*pair) <= tolerance
                yield batch.loc[near, schema.names]

        return wanted.select(*MEMBER, "kept_idx", F.to_json("kept_place").alias("kept_place"), "xyz", "kept_xyz").mapInPandas(
            compare, "ensemble_id {}, conf_idx {}, kept_idx {}, kept_place string".format(
                *[schema[c].dataType.simpleString() for c in ("ensemble_id", "conf_idx", "kept_idx")])
        ).withColumn("kept_place", F.from_json("kept_place", schema["kept_place"].dataType))

    def same(frame: pd.DataFrame, kept: np.ndarray, others: np.ndarray) -> np.ndarray:
        near = _gate(frame, kept, others, max_gap_kcal) & (frame["formula"].to_numpy()[others] == frame["formula"].to_numpy()[kept])
        for name in spread:
            values = frame[name].to_numpy()
            near &= np.abs(values[others] - values[kept]) <= reach
        rows, xyz = np.flatnonzero(near), frame["xyz"].to_numpy()
        lengths = np.fromiter((len(x) for x in xyz[others[rows]]), int, len(rows))
        for length in np.unique(lengths):
            at = rows[lengths == length]
            pair = [np.stack(xyz[side[at]]).reshape(len(at), -1, 3) for side in (kept, others)]
            near[at] = superposed_rmsd(*pair) <= tolerance
        return near

    payload = ["energy_kcal", "xyz", "formula", *spread]
    points = cut_lineage(points.select(*MEMBER, *payload), "points")  # counted first, then walked through
    return greedy_duplicates(
        points, [F.col(r) for r in ring], reach, same_rows, payload, same, task_rows or walk_limit(points, WALK_ROWS), rings)


def accept_mask(duplicates: DataFrame) -> DataFrame:
    """Duplicates to a mask for the geometric screen."""
    return duplicates.select(*MEMBER, (F.col("kept_idx") == F.col("conf_idx")).alias("accepted"))


def prune(atoms: DataFrame, energies: DataFrame, use_moments: bool = True, use_rmsd: bool = True, max_gap_kcal: float | None = ENERGY_GATE_KCAL) -> DataFrame:
    """Moment stage, then RMSD stage on its survivors; gives the accept mask of the whole ensemble."""
    points = energies.select(*MEMBER, "energy_kcal")
    survivors = points
    if use_moments:
        mask = accept_mask(moment_duplicates(points.join(moments(atoms), MEMBER), max_gap_kcal=max_gap_kcal))
        survivors = cut_lineage(survivors.join(mask.where("accepted"), MEMBER, "left_semi"), "survivors")
    if use_rmsd:
        kept_atoms = atoms.join(survivors, MEMBER, "left_semi")
        shaped = survivors.join(spreads(kept_atoms), MEMBER).join(coordinate_lists(kept_atoms), MEMBER)
        mask = accept_mask(rmsd_duplicates(shaped, max_gap_kcal=max_gap_kcal))
        survivors = cut_lineage(survivors.join(mask.where("accepted"), MEMBER, "left_semi"), "survivors")
    kept = survivors.select(*MEMBER, F.lit(True).alias("accepted"))
    return points.select(*MEMBER).join(kept, MEMBER, "left").fillna(False, ["accepted"])
