"""Screens, duplicates and clusters against hand-made and brute-force results."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ensemblage.operators import clustering, geometry, screen
from ensemblage.operators.groups import plan_groups
from ensemblage.plans import geometry_queries


def conformers(spark, energies, ensemble="m"):
    rows = [(ensemble, i, e) for i, e in enumerate(energies, 1)]
    return spark.createDataFrame(rows, "ensemble_id string, conf_idx int, energy_kcal double")


@pytest.mark.parametrize(
    ("energies", "width", "kept"),
    [
        ([0.0, 2.0, 6.0], 5.0, [True, True, False]), ([0.0, 5.0], 5.0, [True, True]),
        ([0.0, 0.0, 0.0001, 1.0], 0.0, [True, True, False, False]), ([10.0, 0.0, 4.0, 100.0], 5.0, [False, True, True, False]),
        ([None, None, None], 5.0, [True, True, True]), ([0.0, None, 100.0], 5.0, [True, True, False]),
    ],
)
def test_energy_window(spark, energies, width, kept):
    got = screen.energy_window(conformers(spark, energies), width).orderBy("conf_idx").collect()
    assert [r.in_window for r in got] == kept


def test_negative_window_raises(spark):
    with pytest.raises(ValueError):
        screen.energy_window(conformers(spark, [0.0]), -1.0)


def test_mask_comes_before_the_window(spark):
    df = conformers(spark, [0.0, 2.0, 8.0])
    mask = spark.createDataFrame([("m", 1, True), ("m", 2, False), ("m", 3, True)], "ensemble_id string, conf_idx int, accepted boolean")
    got = screen.geometric_screen(df, mask, 5.0).orderBy("conf_idx").collect()
    assert [r.accepted for r in got] == [True, False, False]
    assert [r.rejected_reason for r in got] == [None, "pruned_by_prism_pruner", "above_energy_window"]
    assert [r.rel_energy_kcal for r in got] == [0.0, None, None]
    assert [r.conf_idx for r in screen.geometric_screen(df, mask, 5.0, keep_rejected=False).collect()] == [1]


def test_window_reference_is_the_lowest_survivor(spark):
    df = conformers(spark, [0.0, 6.0, 10.0])
    mask = spark.createDataFrame([("m", 1, False), ("m", 2, True), ("m", 3, True)], "ensemble_id string, conf_idx int, accepted boolean")
    got = screen.geometric_screen(df, mask, 5.0).orderBy("conf_idx").collect()
    assert [r.accepted for r in got] == [False, True, True]


def test_incomplete_mask_accepts_all_and_small_ensembles_bypass(spark):
    df = conformers(spark, [0.0, 1.0, 2.0]).unionByName(conformers(spark, [0.0, 1.0], "small"))
    mask = spark.createDataFrame(
        [("m", 1, False), ("m", 2, False), ("small", 1, False), ("small", 2, False)], "ensemble_id string, conf_idx int, accepted boolean")
    got = screen.geometric_screen(df, mask, 5.0).collect()
    assert all(r.accepted for r in got)
    failed = screen.mask_failures(df, mask).collect()
    assert [(r.ensemble_id, r.n_input, r.n_mask) for r in failed] == [("m", 3, 2)]


def test_masks_that_are_too_long_accept_all(spark):
    df = conformers(spark, [0.0, 1.0, 2.0])
    rows = [("m", 1, False), ("m", 2, True), ("m", 3, False)]
    for more in ([("m", 4, True)], [("m", 1, False)]):
        mask = spark.createDataFrame(rows + more, "ensemble_id string, conf_idx int, accepted boolean")
        got = screen.geometric_screen(df, mask, 5.0).collect()
        assert len(got) == 3 and all(r.accepted and not r.mask_ok for r in got)
        assert [(r.n_input, r.n_mask) for r in screen.mask_failures(df, mask).collect()] == [(3, 4)]
    small = conformers(spark, [0.0, 1.0])
    assert screen.mask_failures(small, mask).count() == 0


def test_required_energies_and_labels(spark):
    df = conformers(spark, [0.0, None, 2.0])
    mask = spark.createDataFrame([("m", i, True) for i in (1, 2, 3)], "ensemble_id string, conf_idx int, accepted boolean")
    labels = spark.createDataFrame([("m", i, 1, 0.1 * i) for i in (1, 2, 3)], "ensemble_id string, conf_idx int, label int, distance double")
    for got in (screen.geometric_screen(df, mask, 5.0, "true").collect(), screen.cluster_screen(df, labels, 5.0, "true").collect()):
        assert [(r.accepted, r.rejected_reason) for r in got] == [(False, "use_energies_required_but_unavailable")] * 3
    missing = labels.where("conf_idx <> 2")
    got = screen.cluster_screen(df, missing, 5.0).orderBy("conf_idx").collect()
    assert [(r.accepted, r.cluster_id) for r in got] == [(True, 0), (True, 1), (True, 2)]
    assert [(r.n_labelled, r.n_input) for r in screen.label_failures(df, missing).collect()] == [(2, 3)]


def test_clusters_keep_one_centre(spark):
    df = conformers(spark, [0.0, 1.0, 2.0, 3.0, 50.0])
    labels = spark.createDataFrame(
        [("m", 1, 7, 0.0), ("m", 2, 7, 0.4), ("m", 3, 9, 0.3), ("m", 4, 9, 0.0), ("m", 5, 9, 0.1)],
        "ensemble_id string, conf_idx int, label int, distance double")
    got = screen.cluster_screen(df, labels, 10.0).orderBy("conf_idx").collect()
    assert [r.accepted for r in got] == [True, False, False, True, False]
    assert [r.rejected_reason for r in got] == [None, "cluster_dup", "cluster_dup", None, "above_energy_window"]
    assert [r.cluster_id for r in got] == [0, 0, 1, 1, None]
    assert [r.cluster_distance for r in got] == [0.0, 0.4, 0.3, 0.0, None]
    best = screen.best_conformer(screen.cluster_screen(df, labels, 10.0)).collect()
    assert [(r.conf_idx, r.best_chosen_by) for r in best] == [(1, "lowest_rel_energy_kcal")]


def test_best_of_array_needs_a_geometry(spark):
    energies = spark.createDataFrame([("a", 1, -2.0), ("a", 2, -1.0), ("b", 1, -1.0)], "ensemble_id string, conf_idx int, energy_eh double")
    shapes = spark.createDataFrame([("a", 2), ("b", 1)], "ensemble_id string, conf_idx int")
    assert [tuple(r) for r in screen.best_of_array(energies, shapes).collect()] == [("b", 1)]


@pytest.mark.parametrize("limit", [10_000, 40])
def test_partner_counts_match_brute_force(spark, limit):
    draw = random.Random(3)
    rows = [(0 if i % 3 == 0 else i % 9, i, draw.choice([None, round(draw.random() * 4, 1)])) for i in range(300)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, energy_kcal double")
    got = {tuple(r)[:2]: r.n_partners for r in screen.partner_counts(df, 0.55, plan_groups(df, ("ensemble_id",), limit)).collect()}
    want = {
        (e, i): sum(1 for f, j, y in rows if f == e and j != i and y is not None and x - 0.55 <= y <= x + 0.55)
        for e, i, x in rows if x is not None
    }
    assert got == want


def brute_force(rows, same):
    kept, out = {}, {}
    for row in sorted(rows, key=lambda r: (r[0], r[2] is None, r[2] or 0.0, r[1])):
        before = [k for k in kept.setdefault(row[0], []) if same(row, k)]
        if not before:
            kept[row[0]].append(row)
        out[row[:2]] = not before
    return out


def test_moment_duplicates_match_brute_force(spark):
    draw = random.Random(11)
    rows = []
    for i in range(400):  # half of the rows in one ensemble, many of them copies or near copies
        base = draw.choice([10.0, 10.05, 10.12, 11.0, 14.0])
        jitter = draw.choice([1.0, 1.0, 1.004, 1.011])
        energy = draw.choice([None, 0.0, 0.3, 0.9, 2.0])
        rows.append((0 if i % 2 else i % 7, i, energy, base * jitter, 20.0 * jitter, 30.0))
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, energy_kcal double, moment_a double, moment_b double, moment_c double")
    width = -np.log1p(-0.01)

    def same(a, b):
        near = a[2] is None or b[2] is None or abs(a[2] - b[2]) <= 0.5
        return near and all(abs(np.log(a[k]) - np.log(b[k])) <= width for k in (3, 4, 5))

    got = {(r.ensemble_id, r.conf_idx): r for r in geometry.moment_duplicates(df).collect()}
    want = brute_force(rows, same)
    assert {k: r.kept_idx == k[1] for k, r in got.items()} == want
    by_key = {r[:2]: r for r in rows}
    for key, r in got.items():
        target = (key[0], r.kept_idx)
        assert want[target] and (target == key or same(by_key[key], by_key[target]))


def test_moments_match_numpy(spark):
    rng = np.random.default_rng(5)
    xyz = rng.normal(size=(6, 3))
    elements = ["C", "H", "O", "N", "H", "Cl"]
    masses = np.array([12.011, 1.008, 15.999, 14.007, 1.008, 35.45])
    rows = [("m", 1, i, e, *map(float, p)) for i, (e, p) in enumerate(zip(elements, xyz))]
    df = spark.createDataFrame(rows, "ensemble_id string, conf_idx int, atom_index int, element string, x double, y double, z double")
    centred = xyz - (masses[:, None] * xyz).sum(0) / masses.sum()
    tensor = sum(m * ((p @ p) * np.eye(3) - np.outer(p, p)) for m, p in zip(masses, centred))
    got = geometry.moments(df).first()
    assert [got.moment_a, got.moment_b, got.moment_c] == pytest.approx(np.linalg.eigvalsh(tensor))
    plain = xyz - xyz.mean(0)
    spread = geometry.spreads(df).first()
    want = sorted(np.linalg.svd(plain, compute_uv=False) / np.sqrt(6))
    assert [spread.spread_a, spread.spread_b, spread.spread_c] == pytest.approx(want)


def rotation(rng):
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    return q * np.sign(np.linalg.det(q))


def test_small_ensembles_are_walked_together(spark):
    """No call per ensemble, and ensembles that go on in the next batch stay whole."""
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(40)]), i, draw.choice([None, 0.0, 0.3, 0.9]), draw.choice([10.0, 10.05, 10.12]), 20.0, 30.0) for i in range(300)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, energy_kcal double, moment_a double, moment_b double, moment_c double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = geometry.moment_duplicates(df)
        got = {r.conf_idx: r.kept_idx for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "FlatMapGroups" not in found._jdf.queryExecution().toString()
    want, kept = {}, {}
    for ensemble, conf, energy, a, _, _ in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0.0, r[1])):
        mine = kept.setdefault(ensemble, [])
        near = [c for c, e, m in mine if (e is None or energy is None or abs(e - energy) <= 0.5) and abs(np.log(m / a)) <= -np.log1p(-0.01)]
        want[conf] = near[0] if near else conf
        if not near:
            mine.append((conf, energy, a))
    assert got == want


def test_rmsd_duplicates_ignore_rotation(spark):
    rng = np.random.default_rng(9)
    shapes = [rng.normal(size=(5, 3)) * 2 for _ in range(4)]
    rows, coordinates = [], {}
    for i in range(24):
        shape = shapes[i % 4] @ rotation(rng) + rng.normal(size=3) + rng.normal(size=(5, 3)) * 0.01
        coordinates[i] = shape
        rows += [("m", i, a, "C", *map(float, p)) for a, p in enumerate(shape)]
    atoms = spark.createDataFrame(rows, "ensemble_id string, conf_idx int, atom_index int, element string, x double, y double, z double")
    energies = spark.createDataFrame([("m", i, 0.01 * i) for i in range(24)], "ensemble_id string, conf_idx int, energy_kcal double")
    kept = sorted(r.conf_idx for r in geometry.prune(atoms, energies, use_moments=False).where("accepted").collect())
    assert kept == [0, 1, 2, 3]
    pairs = list(itertools.combinations(range(8), 2))
    left, right = (np.stack([coordinates[p[k]] for p in pairs]) for k in (0, 1))
    measured = geometry.superposed_rmsd(left, right)
    assert all((value < 0.25) == (i % 4 == j % 4) for value, (i, j) in zip(measured, pairs))


def test_large_ensembles_walk_in_runs_to_the_same_end(spark):
    rng = np.random.default_rng(12)
    shapes, rows = [rng.normal(size=(6, 3)) for _ in range(12)], []
    for i in range(150):
        n = 5 if i % 10 == 0 else 6  # some of another formula
        shape = (shapes[i % 12] @ rotation(rng) + rng.normal(size=(6, 3)) * rng.choice([0.02, 0.1]))[:n]
        rows += [(None if i % 3 else 2, i, a, "C", *map(float, p)) for a, p in enumerate(shape)]
    atoms = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, atom_index int, element string, x double, y double, z double")
    energies = [(None if i % 3 else 2, i, None if i % 17 == 0 else float(i % 5)) for i in range(150)]
    points = geometry.spreads(atoms).withColumnRenamed("ensemble_id", "e").join(
        geometry.coordinate_lists(atoms).withColumnRenamed("ensemble_id", "f").drop("e"), "conf_idx").join(
        spark.createDataFrame(energies, "ensemble_id int, conf_idx int, energy_kcal double"), "conf_idx").drop("e", "f").persist()
    results = [sorted(map(tuple, geometry.rmsd_duplicates(points, 0.25, 1.5, limit).select("conf_idx", "kept_idx").collect())) for limit in (None, 20)]
    assert results[0] == results[1] and len(results[0]) == 150
    assert 12 < sum(i == k for i, k in results[0]) < 150


def test_large_ensembles_by_moments_in_runs(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(0, i, draw.choice([None, 0.0, 0.4, 3.0]), *[b * draw.choice([1.0, 1.004, 1.02]) for b in (10.0, 20.0, 30.0)]) for i in range(200)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, energy_kcal double, moment_a double, moment_b double, moment_c double")
    whole = sorted(map(tuple, geometry.moment_duplicates(df).collect()))
    monkeypatch.setattr(geometry, "WALK_ROWS", 30)
    assert sorted(map(tuple, geometry.moment_duplicates(df).collect())) == whole


def test_mirror_images_are_not_duplicates():
    shape = np.random.default_rng(2).normal(size=(1, 6, 3))
    assert geometry.superposed_rmsd(shape, shape * np.array([1, 1, -1]))[0] > 0.1


def test_kmeans_finds_separate_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(e, i, [float(v) for v in rng.normal(size=2) * 0.1 + 10 * (i % 2)]) for e in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, features array<double>")
    for result in (clustering.kmeans(df, 2, 2), clustering.kmeans_auto(df, 2, 4)):
        for ensemble in (1, 2):
            labels = {r.conf_idx: r.label for r in result.where(F.col("ensemble_id") == ensemble).collect()}
            assert len(labels) == 40
            assert len({labels[i] for i in range(0, 40, 2)}) == 1 and labels[0] != labels[1]


def test_registered_kmeans_searches_the_whole_range(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(1, i, [float(v) for v in rng.normal(size=64) * 0.1 + 10 * (np.arange(64) % 5 == i % 5)]) for i in range(50)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, features array<double>")
    monkeypatch.setattr(geometry_queries.Given, "embedding_points", lambda self: df)
    auto = geometry_queries.kmeans_auto(spark, "").collect()
    assert len(auto) == 50 and {(r.k_least, r.k_most) for r in auto} == {(2, 8)}
    assert {r.k for r in auto} <= set(range(4, 9)) and all(r.converged and r.rounds > 0 for r in auto)
    plain = geometry_queries.kmeans(spark, "").collect()
    assert len(plain) == 50 and all(r.converged and r.rounds > 0 for r in plain)


def test_threshold_clusters_match_brute_force(spark):
    draw = random.Random(6)
    rows = [(i % 3, i, draw.random() * 12, draw.random() * 12) for i in range(150)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, u double, v double")
    got = {(r.ensemble_id, r.conf_idx): r.label for r in clustering.threshold_clusters(df, ["u", "v"], 1.0).collect()}
    assert got == linked_by_distance(rows, 1.0, 1)
    dense = {(r.ensemble_id, r.conf_idx): r.label for r in clustering.threshold_clusters(df, ["u", "v"], 1.0, 4).collect()}
    assert dense == linked_by_distance(rows, 1.0, 4)
    assert len(set(dense.values())) > len(set(got.values()))


def linked_by_distance(rows, cut, min_members):
    """Cores, what reaches them, and the rest, by comparing every two members of an ensemble."""
    near = {(e, i): {(f, j) for f, j, a, b in rows if f == e and (a - u) ** 2 + (b - v) ** 2 <= cut * cut} for e, i, u, v in rows}
    cores = {k for k, around in near.items() if len(around) >= min_members}
    label = {k: k[1] for k in cores}
    for _ in range(len(rows)):
        label = {k: min(label[o] for o in near[k] & cores) for k in cores}
    return {k: label[k] if k in cores else min((label[o] for o in near[k] & cores), default=k[1]) for k in near}


def test_full_cells_are_halved_until_settled(spark, monkeypatch):
    monkeypatch.setattr(clustering, "DIRECT", 4)
    draw = random.Random(8)
    rows = [(0, i, 5 * (i % 2) * 0.31 + draw.random() * 0.7, draw.random() * 0.7) for i in range(60)] + [(0, 60 + i, 2.0, 0.1) for i in range(40)]
    df = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, u double, v double")
    for cut in (0.3, 0.86, 1.0):
        got = {(r.ensemble_id, r.conf_idx): r.label for r in clustering.threshold_clusters(df, ["u", "v"], cut).collect()}
        assert got == linked_by_distance(rows, cut, 1)


def test_molecules_of_two_atoms_differ_by_half_their_lengths():
    """Two bonds laid over each other differ by half of what their lengths differ, to all digits: no noise of a flat covariance."""
    left = np.array([[[31.113957, 5.0185655, 0.9713137], [19.7055061, 4.0148524, 0.9713137]]])
    right = np.array([[[7.2599233, 6.0222786, 2.9139411], [19.7055061, 1.0037131, 1.9426274]]])
    long, short = (np.linalg.norm(x[0, 0] - x[0, 1]) for x in (right, left))
    assert geometry.superposed_rmsd(left, right)[0] == pytest.approx((long - short) / 2, abs=1e-9) == pytest.approx(1.0009609633, abs=1e-9)
