"""Dendrograms and k-means: the ways for ordinary and for large ensembles against brute force and each other."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ensemblage.operators import clustering, linkage, metric
from ensemblage.operators.groups import plan_groups

SPOTS = "ensemble_id long, conf_idx long, u double, v double, merge string"


def spots(n=260, seed=3):
    """Many ties, equal points, an ensemble without a name and one of one member."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, None, 0, 0, 0, 1]), i, round(rng.gauss(0, 1), 1), round(rng.gauss(0, 1) + rng.choice([0, 30]), 1), "x") for i in range(n)]
    return [*rows, (9, 5_000, 1.0, 1.0, "x")]


def kruskal(rows):
    """(ensemble, merge): left, right, height, size."""
    found = {}
    for ensemble in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == ensemble]
        edges = sorted((((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2), min(a[1], b[1]), max(a[1], b[1])) for a, b in itertools.combinations(mine, 2))
        name, size, n = {r[1]: r[1] for r in mine}, {r[1]: 1 for r in mine}, 0

        def top(x):
            while name[x] != x:
                x = name[x]
            return x

        for square, a, b in edges:
            left, right = sorted((top(a), top(b)))
            if left != right:
                n += 1
                name[right] = left
                size[left] += size[right]
                found[ensemble, n] = (left, right, round(square**0.5, 9), size[left])
    return found


def collected(merges):
    return {(r["ensemble_id"], r["merge"]): (r["left"], r["right"], round(r["height"], 9), r["size"]) for r in merges.collect()}


@pytest.mark.parametrize("way", ["task", "rounds"])
def test_dendrogram_against_all_pairs(spark, monkeypatch, way):
    monkeypatch.setattr(linkage, "BLOCK_ROWS", 16)
    rows = spots()
    df = spark.createDataFrame(rows, SPOTS)
    limits = {} if way == "task" else {"task_rows": 60, "at_once": 50}
    assert collected(linkage.dendrogram(df, ["u", "v"], **limits)) == kruskal(rows)


@pytest.mark.parametrize("limits", [{}, {"task_rows": 8}])
def test_members_in_one_place_are_one_node_of_the_tree(spark, monkeypatch, limits):
    """Places are counted, not members, so copies neither make a tree quadratic nor send it through rounds."""
    sizes = []
    monkeypatch.setattr(linkage, "_boruvka", lambda *_: pytest.fail("eight places went through rounds"))
    monkeypatch.setattr(linkage, "plan_groups", lambda df, keys, limit: sizes.append(df.count()) or plan_groups(df, keys, limit))
    rows = [(0, (i * 7) % 240, float(i % 4), -0.0 if i % 3 else 0.0 + 5 * (i % 2), "x") for i in range(240)]
    found = collected(linkage.dendrogram(spark.createDataFrame(rows, SPOTS), ["u", "v"], **limits))
    assert found == kruskal(rows) and sizes[0] <= 8


def test_cuts_are_components_and_counts(spark):
    rows = spots(seed=8)
    df = spark.createDataFrame(rows, SPOTS)
    merges = linkage.dendrogram(df, ["u", "v"]).persist()
    usual = df.where("ensemble_id IS NOT NULL")
    near = {(r.ensemble_id, r.conf_idx): r.label for r in clustering.threshold_clusters(usual, ["u", "v"], 0.35).collect()}
    by_distance = {(r.ensemble_id, r.conf_idx): r.label for r in linkage.cut(merges, df, distance=0.35).collect()}
    assert len(by_distance) == len(rows) and {k: v for k, v in by_distance.items() if k[0] is not None} == near
    for k in (1, 2, 7):
        counts = linkage.cut(merges, df, n_clusters=k).groupBy("ensemble_id").agg(F.countDistinct("label").alias("n")).collect()
        assert {r.ensemble_id: r.n for r in counts} == {None: k, 0: k, 1: k, 9: 1}
    with pytest.raises(ValueError):
        linkage.cut(merges, df, n_clusters=0)


def test_dendrogram_of_nothing(spark):
    assert linkage.dendrogram(spark.createDataFrame([], SPOTS), ["u", "v"]).count() == 0


def groups_of_points(spark):
    rng = np.random.default_rng(5)
    rows = [(e, i, [float(x) for x in rng.normal(size=3) * 0.3 + 9 * (i % n)]) for e, n in ((1, 4), (None, 3), (2, 2)) for i in range(45)]
    rows += [(3, 0, [1.0, 1.0, 1.0]), (4, 0, [1.0, 1.0, 1.0]), (4, 1, [1.0, 1.0, 1.0])]
    return spark.createDataFrame(rows, "ensemble_id int, conf_idx int, features array<double>")


def plainly_chosen(rows):
    """(ensemble, k) of the highest mean silhouette, member by member."""
    chosen = set()
    for ensemble in {r[0] for r in rows}:
        mine = sorted((hashlib.md5(str(r[1]).encode()).hexdigest(), r[1], r[2]) for r in rows if r[0] == ensemble)
        points = np.array([r[2] for r in mine])
        scores = []
        for k in range(2, 9):
            if k > max(len(points), 2):
                continue
            centres = points[:k]
            for _ in range(100):
                labels = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
                centres = np.stack([points[labels == c].mean(axis=0) if (labels == c).any() else centres[c] for c in range(len(centres))])
            gaps, score = ((points[:, None] - points[None]) ** 2).sum(axis=2), []
            for i, label in enumerate(labels):
                own = (labels == label) & (np.arange(len(points)) != i)
                others = [gaps[i, labels == other].mean() for other in set(labels) - {label}]
                a, b = (gaps[i, own].mean(), min(others)) if own.any() and others else (0.0, 0.0)
                score.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
            scores.append((-round(float(np.mean(score)), 9), k))
        chosen.add((ensemble, min(scores)[1]))
    return chosen


def test_numbers_of_clusters_by_silhouette_both_ways(spark):
    df = groups_of_points(spark)
    results = []
    for task_rows in (None, 20):
        rows = clustering.kmeans_auto(df, 3, task_rows=task_rows).collect()
        assert {(r.ensemble_id, r.k) for r in rows} == plainly_chosen([tuple(r) for r in df.collect()])
        results.append(sorted(((r.ensemble_id, r.conf_idx, r.label, round(r.distance, 9), round(r.silhouette, 8), r.converged, r.rounds) for r in rows), key=repr))
    assert results[0] == results[1] and len(results[0]) == 138


def test_silhouettes_against_all_pairs():
    rng = np.random.default_rng(6)
    for k in (1, 2, 5):
        points, labels = rng.normal(size=(40, 4)), rng.integers(0, k, 40)
        labels[0] = 77  # alone
        gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
        want = []
        for i, label in enumerate(labels):
            own = (labels == label) & (np.arange(40) != i)
            others = [gaps[i, labels == other].mean() for other in set(labels) - {label}]
            a, b = gaps[i, own].mean() if own.any() else 0.0, min(others)
            want.append((b - a) / max(a, b) if own.any() else 0.0)
        assert np.allclose(clustering._silhouettes(points, labels), want)


def shape_rows():
    """Conformers of two formulas around a few shapes, chains of small steps among them."""
    rng = np.random.default_rng(14)
    bases, rows = [rng.normal(size=(5, 3)) for _ in range(4)], []
    for i in range(120):
        shape = bases[i % 4] + 0.02 * (i // 4) * rng.normal(size=(5, 3)) * rng.choice([0, 1, 3])
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        if i % 3:
            shape = shape @ (q * np.sign(np.linalg.det(q)))
        rows += [(None if i % 5 else 1, i, a, "O" if i % 7 == 0 and a == 2 else "C", *map(float, p)) for a, p in enumerate(shape)]
    return rows


@pytest.mark.parametrize("name", metric.METRICS)
def test_clusters_by_metric_against_all_pairs(spark, monkeypatch, name):
    monkeypatch.setattr(metric, "BLOCK_ROWS", 5)
    atoms = spark.createDataFrame(shape_rows(), "ensemble_id int, conf_idx int, atom_index int, element string, x double, y double, z double")
    shapes = metric.shapes(atoms).persist()
    table = shapes.toPandas().sort_values("conf_idx").reset_index(drop=True)
    measured, ensembles = metric._Shapes(table, name), [None if e != e else e for e in table["ensemble_id"]]
    cut, ids = (0.35 if name == "moi" else 0.5), table["conf_idx"].to_numpy()
    label = {(e, i): i for e, i in zip(ensembles, ids, strict=True)}
    gaps = np.stack([measured.from_one(i, np.arange(len(table))) for i in range(len(table))])
    for _ in range(len(ids)):
        for i in range(len(ids)):
            near = [j for j in range(len(ids)) if gaps[i, j] <= cut and ensembles[i] == ensembles[j]]
            least = min(label[ensembles[j], ids[j]] for j in near)
            for j in near:
                label[ensembles[j], ids[j]] = least
        if all(label[e, label[e, i]] == label[e, i] for e, i in label):
            break
    for task_rows in (None, 25):
        found = {(r.ensemble_id, r.conf_idx): r.label for r in metric.metric_clusters(shapes, cut, name, task_rows).collect()}
        assert found == label
    assert 2 < len(set(label.items()) & {((e, i), i) for e, i in label}) < 110


@pytest.mark.parametrize("name", metric.METRICS)
def test_small_ensembles_are_searched_together(monkeypatch, name):
    """All pairs of many ensembles at once give what each ensemble alone gives, whatever its size."""
    rng, rows = np.random.default_rng(3), []
    for ensemble, members in enumerate((1, 2, 40, 3, 90, 25)):
        bases = rng.normal(size=(4, 3, 3))
        for i in rng.permutation(members):
            atoms = 3 - (i % 5 == 0)
            xyz = (bases[i % 4] + 0.2 * rng.normal(size=(3, 3)))[:atoms]
            rows.append((ensemble, int(i), xyz.ravel(), "C" * atoms if i % 7 else "O C", *rng.normal(size=3)))
    frame = metric.pd.DataFrame(rows, columns=["ensemble_id", "conf_idx", *metric.PAYLOAD])
    ensemble, ids = frame.pop("ensemble_id").to_numpy(), frame["conf_idx"].to_numpy()
    for paired in (0, 64, 1_000):
        monkeypatch.setattr(metric, "PAIRED_ROWS", paired)
        label = metric.searched_together(frame, ensemble, name, 0.6)
        for one in np.unique(ensemble):
            mine = np.flatnonzero(ensemble == one)
            assert (ids[label[mine]] == metric.searched(frame.iloc[mine], name, 0.6)).all() and (ensemble[label[mine]] == one).all()


def test_shapes_are_gathered_once_and_repeated_atoms_are_one(spark):
    rows = [(1, 1, 2, "H", 1.0, 0.0, 0.0), (1, 1, 1, "O", 0.5, 3.0, 0.0), (1, 1, 1, "C", 0.7, 2.0, 1.0), (1, 2, 1, "C", 0.0, 0.0, 0.0)]
    atoms = spark.createDataFrame(rows, "ensemble_id int, conf_idx int, atom_index int, element string, x double, y double, z double")
    shapes = metric.shapes(atoms)
    assert "Join" not in shapes._jdf.queryExecution().optimizedPlan().toString()
    found = {r.conf_idx: (list(r.xyz), r.formula) for r in shapes.collect()}
    assert found == {1: ([0.5, 2.0, 0.0, 1.0, 0.0, 0.0], "C H"), 2: ([0.0, 0.0, 0.0], "C")}


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        metric.metric_clusters(spark.createDataFrame([], "ensemble_id int, conf_idx int, xyz array<double>, formula string, log_a double, log_b double, log_c double"), 1.0, "x")
