"""NMR averages, equivalence, monitoring, lineage, rules and the registered queries."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from ensemblage.functions import scalars
from ensemblage.operators import audit, equivalence, lineage, monitor, nmr
from ensemblage.plans import catalog
from ensemblage.plans.scalar_queries import unique_names


def weights(spark, *values):
    return spark.createDataFrame([("m", i, w) for i, w in enumerate(values, 1)], "ensemble_id string, conf_idx int, weight double")


def shieldings(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "ensemble_id string, conf_idx int, atom_index int, element string, sigma_iso_ppm double")


def pairs(spark, rows):
    return spark.createDataFrame(
        [("m", *r) for r in rows], "ensemble_id string, conf_idx int, i int, elem_i string, j int, elem_j string, j_total_hz double")


def test_shift_and_coupling_predictions(spark):
    sigma = shieldings(spark, [(c, a, e, s) for c in (1, 2) for a, e, s in ((1, "H", 29.7051), (2, "H", 30.1), (0, "C", 61.238), (3, "O", 5.0))])
    j = pairs(spark, [(c, 1, "H", 2, "H", 7.5) for c in (1, 2)] + [(1, 0, "C", 1, "H", 145.0)])
    table = nmr.calibration_table(spark)
    shift, coupling = nmr.nmr_tables(weights(spark, 0.5, 0.5), sigma, j, table)
    shifts = {r.atom_index: r for r in shift.collect()}
    assert shifts[1].delta_ppm == pytest.approx(2.0, abs=1e-3) and shifts[0].delta_ppm == pytest.approx(120.0, abs=1e-3)
    assert shifts[3].delta_ppm is None and shifts[3].cal_source == "" and shifts[3].cal_solvent == "CHCl3"
    got = {(r.i, r.j): r for r in coupling.collect()}
    assert got[(1, 2)].j_predicted_hz == pytest.approx(7.5 * 0.9105 + 0.21) and got[(1, 2)].n_used == 2
    assert got[(0, 1)].j_predicted_hz is None and got[(0, 1)].j_avg_hz == 145.0
    summary = nmr.nmr_summary(shift, coupling, table).first()
    assert (summary.n_atoms, summary.n_h_atoms, summary.n_hh_pairs, summary.cal_j_used) == (4, 2, 1, True)


def test_partial_and_repeated_atoms(spark):
    sigma = shieldings(spark, [(1, 1, "H", 10.0), (2, 1, "H", 20.0), (2, 1, "H", 30.0), (2, 2, "H", 5.0), (3, 1, "H", 99.0)])
    got = {r.atom_index: r for r in nmr.average_shieldings(sigma, weights(spark, 0.5, 0.25, None)).collect()}
    assert got[1].sigma_avg_ppm == pytest.approx((0.5 * 10 + 0.25 * 20 + 0.25 * 30) / 1.0)
    assert got[2].sigma_avg_ppm == pytest.approx(5.0) and got[1].n_used == 2


def test_couplings_without_totals_still_count_as_used(spark):
    j = pairs(spark, [(1, 1, "H", 2, "H", None), (2, 1, "H", 2, "H", 4.0), (1, 3, "H", 4, "H", None)])
    got = nmr.average_couplings(j, weights(spark, 0.5, 0.5)).collect()
    assert [(r.i, r.j, r.j_avg_hz, r.n_used) for r in got] == [(1, 2, 4.0, 2)]


def test_calibration_names_ignore_case_and_blanks(spark):
    keyed = spark.createDataFrame(
        [("  wB97x-d ", "6-31g(d,p)", "chcl3", "13C"), ("none", "6-31G(d,p)", "CHCl3", "13C")], "functional string, basis string, solvent string, nucleus string")
    got = {r.functional.strip(): r.slope for r in nmr.join_calibration(keyed, nmr.calibration_table(spark)).collect()}
    assert got == {"wB97x-d": -1.0501, "none": None}


def test_overrides_win(spark):
    own = spark.createDataFrame([("wp04", "6-311++G(2d,p)", "chcl3", "1H", -2.0, 30.0, "own", None, None)], nmr.CALIBRATION_SCHEMA)
    means = nmr.average_shieldings(shieldings(spark, [(1, 1, "H", 28.0)]), weights(spark, 1.0))
    got = nmr.predict_shifts(means, nmr.calibration_table(spark, own)).first()
    assert got.delta_ppm == pytest.approx(1.0) and got.cal_source == "own"


def test_nmr_failures(spark):
    none = spark.createDataFrame([("x", 1, None), ("y", 1, 1.0), ("z", 1, 1.0)], "ensemble_id string, conf_idx int, weight double")
    sigma = spark.createDataFrame([("z", 1, a, "H", 1.0) for a in (1, 2)], "ensemble_id string, conf_idx int, atom_index int, element string, sigma_iso_ppm double")
    j = pairs(spark, []).where("false")
    files = spark.createDataFrame([("z", 1)], "ensemble_id string, conf_idx int")
    got = sorted((r.ensemble_id, r.error) for r in nmr.nmr_failures(none, sigma, j, files).collect())
    assert got == [("x", "no_finite_weights"), ("y", "no_shielding_data_in_any_conformer"), ("z", "coupling_parse_empty"), ("z", "no_hh_couplings_parsed")]


def molecule(spark, classes, shifts, edges):
    atoms = [("m", a, "H", c, shifts[a]) for c, members in enumerate(classes) for a in members]
    atoms_df = spark.createDataFrame(atoms, "ensemble_id string, atom_index int, element string, class_id int, ppm double")
    edges_df = spark.createDataFrame([("m", i, j, v) for (i, j), v in edges.items()], "ensemble_id string, i int, j int, hz double")
    members = equivalence.equivalence(atoms_df, edges_df)
    found = equivalence.groups(members).orderBy("label").collect()
    links = {(r.label, r.other_label): r.j_hz for r in equivalence.group_couplings(members, edges_df).collect()}
    return [(r.label, r.tier, r.n_atoms, round(r.shift_ppm, 4)) for r in found], links


def test_ethanol(spark):
    edges = {(a, b): 7.0 for a in (3, 4, 5) for b in (6, 7)}
    found, links = molecule(spark, [[3, 4, 5], [6, 7], [8]], {3: 1.2, 4: 1.2, 5: 1.2, 6: 3.7, 7: 3.7, 8: 2.5}, edges)
    assert found == [("A", "hard", 3, 1.2), ("B", "hard", 2, 3.7), ("C", "none", 1, 2.5)]
    assert links == {("A", "B"): 7.0, ("B", "A"): 7.0}


def test_dichlorobenzene_is_soft(spark):
    edges = {(1, 2): 8.0, (1, 3): 1.0, (2, 4): 1.0, (3, 4): 8.0}
    found, _ = molecule(spark, [[1, 4], [2, 3]], {1: 7.41, 4: 7.39, 2: 7.2, 3: 7.2}, edges)
    assert [f[1:] for f in found] == [("soft", 1, 7.4), ("soft", 1, 7.2), ("soft", 1, 7.2), ("soft", 1, 7.4)]


def test_spread_shifts_split_a_class_and_unknown_ones_leave_a_label_gap(spark):
    found, _ = molecule(spark, [[1, 2], [3], [4]], {1: 1.4, 2: 1.75, 3: None, 4: 2.0}, {(1, 4): 1.0})
    assert found == [("A", "none", 1, 1.4), ("B", "none", 1, 1.75), ("D", "none", 1, 2.0)]


def test_labels_are_bijective(spark):
    df = spark.createDataFrame([(i,) for i in (0, 25, 26, 51, 52, 701, 702, 18277, 18278)], "n long")
    got = [r[0] for r in df.orderBy("n").select(equivalence.letters(F.col("n"))).collect()]
    assert got == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "ZZZ", "AAAA"]


def test_topological_classes_of_ethanol(spark):
    elements = "CCOHHHHHH"
    bonds = [(0, 1), (1, 2), (0, 3), (0, 4), (0, 5), (1, 6), (1, 7), (2, 8), (8, 2)]
    atoms = spark.createDataFrame([("m", i, e) for i, e in enumerate(elements)], "ensemble_id string, atom_index int, element string")
    links = spark.createDataFrame([("m", *b) for b in bonds], "ensemble_id string, a int, b int")
    got = {r.atom_index: r.class_id for r in equivalence.topological_classes(atoms, links).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 6, 7: 6, 8: 8}


def brute_orbits(elements, bonds):
    edges = {frozenset(b) for b in bonds if b[0] != b[1]}
    first = list(range(len(elements)))
    for to in itertools.permutations(range(len(elements))):
        if all(elements[i] == elements[t] for i, t in enumerate(to)) and {frozenset(to[x] for x in e) for e in edges} == edges:
            first = [min(f, to.index(i), to[i]) for i, f in enumerate(first)]
    return [min(first[j] for j in range(len(elements)) if first[j] == f) for f in first]


def test_orbits_against_all_permutations():
    rng = random.Random(8)
    two_triangles = [(0, 1), (1, 2), (2, 0), (3, 4), (4, 5), (5, 3)]
    prism_less = [(0, 1), (1, 2), (2, 0), (0, 3), (3, 4), (4, 5), (5, 3), (1, 4), (2, 5)]
    assert equivalence.orbits_of(["C"] * 6, two_triangles) == [0] * 6 and equivalence.orbits_of(["C"] * 6, prism_less) == [0] * 6
    for _ in range(60):
        n = rng.randint(1, 6)
        elements = [rng.choice("CCCO") for _ in range(n)]
        bonds = [(a, b) for a in range(n) for b in range(a) if rng.random() < rng.choice([0.3, 0.6])]
        assert equivalence.orbits_of(elements, bonds) == brute_orbits(elements, bonds)
    # a cage of eight atoms with three bonds each: refinement sees one class, there are three
    cage = [(0, 1), (0, 2), (1, 2), (0, 3), (1, 4), (2, 5), (3, 4), (3, 6), (4, 7), (5, 6), (5, 7), (6, 7)]
    assert equivalence.orbits_of(["C"] * 8, cage) == brute_orbits(["C"] * 8, cage) and len(set(equivalence.orbits_of(["C"] * 8, cage))) > 1


def test_molecules_are_refined_in_rows_as_in_rounds(spark, monkeypatch):
    draw = random.Random(11)
    atoms = [(m, i, draw.choice(["C", "H", "", None])) for m in [None, *range(40)] for i in range(draw.randrange(1, 9))]
    bonds = [(m, draw.randrange(9), draw.randrange(9)) for m in [None, *range(40)] for _ in range(draw.randrange(9))]
    atoms = spark.createDataFrame(atoms, "ensemble_id long, atom_index int, element string")
    bonds = spark.createDataFrame(bonds, "ensemble_id long, a int, b int")
    monkeypatch.setattr(equivalence, "ROW_ATOMS", 1)
    rounds = equivalence.topological_classes(atoms, bonds)
    want = sorted(map(tuple, rounds.select("ensemble_id", "atom_index", "element", "class_id").collect()), key=repr)
    monkeypatch.setattr(equivalence, "ROW_ATOMS", 2000)
    monkeypatch.setattr(equivalence, "_by_rounds", None)  # small molecules need none
    rows = equivalence.topological_classes(atoms, bonds)
    assert sorted(map(tuple, rows.select("ensemble_id", "atom_index", "element", "class_id").collect()), key=repr) == want


def test_symmetry_classes(spark, monkeypatch):
    cage = [(0, 1), (0, 2), (1, 2), (0, 3), (1, 4), (2, 5), (3, 4), (3, 6), (4, 7), (5, 6), (5, 7), (6, 7)]
    shift = 10  # indexes need not start at 0
    atoms = spark.createDataFrame([("cage", i + shift, "C") for i in range(8)] + [(None, 1, "H"), (None, 2, "H"), ("one", 1, "C")],
                                  "ensemble_id string, atom_index int, element string")
    bonds = spark.createDataFrame([("cage", a + shift, b + shift) for a, b in cage] + [(None, 1, 2), ("cage", 10, 99)], "ensemble_id string, a int, b int")
    found = {(r.ensemble_id, r.atom_index): (r.class_id, r.exact) for r in equivalence.symmetry_classes(atoms, bonds).collect()}
    want = equivalence.orbits_of(["C"] * 8, cage)
    assert found == {**{("cage", i + shift): (want[i] + shift, True) for i in range(8)}, (None, 1): (1, True), (None, 2): (1, True), ("one", 1): (1, True)}
    monkeypatch.setattr(equivalence, "ORBIT_ATOMS", 5)
    assert {r.class_id for r in equivalence.symmetry_classes(atoms, bonds).where("ensemble_id = 'cage' AND NOT exact").collect()} == {10}


def test_symmetry_classes_do_not_depend_on_the_size_of_a_molecule(spark):
    """Cages that refinement sees as one class, in a molecule beyond the limit, on a chain of rings and beside chains without rings."""
    cage = [(0, 1), (0, 2), (1, 2), (0, 3), (1, 4), (2, 5), (3, 4), (3, 6), (4, 7), (5, 6), (5, 7), (6, 7)]
    copies = equivalence.ORBIT_ATOMS // 8 + 1
    atoms = [("large", i, "C") for i in range(8 * copies)] + [("small", i, "C") for i in range(8)]
    bonds = [("large", a + 8 * k, b + 8 * k) for k in range(copies) for a, b in cage] + [("small", *b) for b in cage]
    atoms = spark.createDataFrame(atoms, "ensemble_id string, atom_index int, element string")
    bonds = spark.createDataFrame(bonds, "ensemble_id string, a int, b int")
    found = {(r.ensemble_id, r.atom_index): r.class_id for r in equivalence.symmetry_classes(atoms, bonds, whole=True).where("exact").collect()}
    want = equivalence.orbits_of(["C"] * 8, cage)
    assert found == {**{("large", i): want[i % 8] for i in range(8 * copies)}, **{("small", i): want[i] for i in range(8)}}


def test_orbits_of_large_chains_of_rings():
    """A chain of 80 rings that can each be turned over, with branches: pairs by turning, and ends by reversing the chain."""
    rings, bonds, n = 80, [], 0
    for k in range(rings):
        bonds += [(n + x, n + (x + 1) % 6) for x in range(6)] + ([(n - 5, n)] if k else [])  # para to para
        n += 8
        bonds += [(n - 2, n - 7), (n - 1, n - 3)]  # a branch on either side
    found = equivalence.orbits_of(["C"] * n, bonds)
    assert all(found[8 * k + 1] == found[8 * k + 5] and found[8 * k + 6] == found[8 * k + 7] for k in range(rings))


def test_orbits_with_trees_against_all_permutations():
    rng = random.Random(21)
    for _ in range(60):
        n = rng.randint(3, 7)
        bonds = [(i, rng.randrange(i)) for i in range(1, n) if rng.random() < 0.85] + [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([0, 0, 1, 2]))]
        elements = [rng.choice("CCCCO") for _ in range(n)]
        assert equivalence.orbits_of(elements, bonds) == brute_orbits(elements, bonds)


def test_names_are_never_given_twice(spark):
    names = ["a", "a", "a_2", "a", "b", "a_2_2", "b_1"]
    rows = spark.createDataFrame(list(enumerate(names)), "n int, name string")
    found = [r["name"] for r in unique_names(rows, "n").orderBy("n").collect()]
    assert len(set(found)) == len(names) and found[0] == "a" and found[1] == "a_2" and found[4:5] + found[6:] == ["b", "b_1"]


def test_progress(spark):
    events = [(1, "started"), (1, "done_success"), (2, "done_failed"), (2, "started"), (3, "started"), (9, "started")]
    df = spark.createDataFrame([("j", t, s) for t, s in events], "job_id string, task_idx int, signal string")
    sizes = spark.createDataFrame([("j", 5), ("idle", 2)], "job_id string, n_tasks int")
    got = {r.job_id: tuple(r)[1:] for r in monitor.progress(monitor.task_states(df), sizes).collect()}
    assert got == {"j": (5, 3, 1, 1, 2, 1, 3), "idle": (2, 0, 0, 0, 0, 0, 2)}


def test_accounting_failures(spark):
    roster = spark.createDataFrame([("1234", t) for t in (1, 2, 3, 4, 5)], "job_id string, task_idx int")
    states = spark.createDataFrame(
        [("1234_1", "COMPLETED", "0:0"), ("1234_2", "FAILED", "1:0"), ("1234_3", "CANCELLED", "0:0"), ("1234_4", "COMPLETED", None)],
        "job_id_raw string, state string, exit_code string")
    assert sorted(r.task_idx for r in monitor.accounting_failures(roster, states).collect()) == [2, 3, 4]


def test_chain_and_loop(spark):
    rows = [("r0", None, True)] + [(f"r{i}", f"r{i - 1}", i != 2) for i in range(1, 9)] + [("s", "gone", True)]
    df = spark.createDataFrame(rows, "run string, upstream string, ok boolean")
    got = {r.run: (r.depth, r.root, r.failed, r.failed_depth) for r in lineage.upstream_chain(df).collect()}
    assert got["r8"] == (8, "r0", "r2", 6) and got["r2"] == (2, "r0", None, None) and got["s"] == (0, "s", None, None)
    loop = spark.createDataFrame([("a", "b", True), ("b", "a", True), ("c", "a", True), ("d", None, True), ("e", "d", True)], df.schema)
    found = {r.run: (r.in_loop, r.depth, r.root) for r in lineage.upstream_chain(loop).collect()}
    assert found == {"a": (True, None, None), "b": (True, None, None), "c": (True, None, None), "d": (False, 0, "d"), "e": (False, 1, "d")}


GOOD = {
    "ok": True, "failures": [], "inputs": {"method": "own", "n_input": 2, "n_accepted": 1, "n_rejected": 1, "best_chosen_by": "x"},
    "artifacts": {
        "accepted": [{"index": 1, "path_abs": "/a", "sha256": "s"}],
        "rejected": [{"index": 2, "path_abs": "/b", "sha256": "s", "rejected_reason": "r"}],
        "xyz_ensemble": [{"label": "accepted_ensemble", "path_abs": "/e", "sha256": "s"}],
        "xyz": [{"label": "best", "path_abs": "/x", "sha256": "s"}],
    },
}


@pytest.mark.parametrize(
    ("path", "value", "expected"),
    [
        (None, None, []),
        (("inputs", "n_input"), True, [("inputs", "n_input", "wrong_type")]),
        (("inputs", "n_rejected"), 4, [("inputs", "n_rejected", "disagrees_with_bucket")]),
        (("artifacts", "accepted", 0, "index"), 0, [("accepted[0]", "index", "below_one")]),
        (("artifacts", "accepted", 0, "sha256"), None, [("accepted[0]", "sha256", "wrong_type")]),
        (("artifacts", "rejected", 0, "rel_energy_kcal"), 1.0, [("rejected[0]", "rel_energy_kcal", "only_for_accepted")]),
        (("artifacts", "xyz"), [], [("artifacts", "xyz", "missing")]),
        (("artifacts", "xyz_ensemble", 0, "label"), "y", [("xyz_ensemble[0]", "label", "wrong_label")]),
        (("artifacts",), 3, [("manifest", "artifacts", "missing")]),
    ],
)
def test_screen_contract(spark, path, value, expected):
    document = json.loads(json.dumps(GOOD))
    if path:
        place = document
        for step in path[:-1]:
            place = place[step]
        place[path[-1]] = value
    df = spark.createDataFrame([("/m", json.dumps(document))], "manifest_path string, text string")
    assert [(r.place, r.field, r.problem) for r in audit.screen_problems(df).collect()] == expected


def test_config_tokens(spark):
    df = spark.createDataFrame([(["a=1", " b = x=y", "a=2"],), (['{"k": 3}'],), (["bad"],)], "tokens array<string>")
    got = [r[0] for r in df.select(scalars.config_map(F.col("tokens"))).collect()]
    assert got == [{"a": "2", "b": "x=y"}, {"k": "3"}, None]


def test_every_oracle_belongs_to_a_query_and_the_flagship_runs(spark):
    catalog.load()
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and len(catalog.QUERIES) > 120
    got = catalog.QUERIES["thm_table"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["ensemble_id", "conf_idx", "e_high_eh", "g_composite_eh", "delta_g_kcal", "weight", "cum_weight"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


@pytest.mark.parametrize("name", ["thm_table", "win_ordinal", "agg_renormalize", "join_pair_candidates", "eqv_labels", "fn_safe_name"])
def test_queries_give_the_same_with_every_group_oversized(spark, name):
    catalog.load()
    folder = "/root/testdata/sf0.001"
    usual = sorted(map(repr, catalog.QUERIES[name](spark, folder).collect()))
    spark.conf.set("spark.ensemblage.maxGroupRows", "3")
    try:
        spread = sorted(map(repr, catalog.QUERIES[name](spark, folder).collect()))
    finally:
        spark.conf.unset("spark.ensemblage.maxGroupRows")
    assert usual == spread


def test_tiers_derive_the_refined_atoms_once(spark):
    catalog.load()
    found = catalog.QUERIES["eqv_tier"](spark, "/root/testdata/sf0.001")
    assert "Window" not in found._jdf.queryExecution().analyzed().toString()
