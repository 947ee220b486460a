"""Group strategies and thermochemistry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ensemblage.functions import constants as K
from ensemblage.operators import screen, thermo
from ensemblage.operators.groups import SpreadGroups, TaskGroups, plan_groups
from ensemblage.plans import catalog

KEYS = ("ensemble_id",)


def skewed(spark, n=600):
    """One ensemble holds half of all rows; many ties in the order column."""
    draw = random.Random(7)
    rows = [(0 if i % 2 else draw.randrange(1, 40), i, float(draw.randrange(12))) for i in range(n)]
    return spark.createDataFrame(rows, "ensemble_id long, conf_idx long, energy_kcal double").repartition(7)


def collected(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("nameless", [False, True])
@pytest.mark.parametrize("step", ["aggs", "running", "ordinal", "previous", "attach"])
def test_both_strategies_agree(spark, step, nameless):
    df = skewed(spark)
    if nameless:  # the largest group has no key
        df = df.withColumn("ensemble_id", F.nullif("ensemble_id", F.lit(0)))
    order = [F.col("energy_kcal"), F.col("conf_idx")]

    def run(groups):
        if step == "aggs":
            return groups.with_aggs(df, low=F.min("energy_kcal"), n=F.count("*"))
        if step == "running":
            return groups.running_sum(df, "out", F.lit(1), order, where=F.col("energy_kcal") > 2)
        if step == "ordinal":
            return groups.ordinal(df, "out", order)
        if step == "attach":
            return groups.attach(df, df.groupBy("ensemble_id").agg(F.max("energy_kcal").alias("out")))
        return groups.previous(df, "out", F.col("energy_kcal"), order)

    assert collected(run(TaskGroups(KEYS))) == collected(run(SpreadGroups(KEYS)))


def test_plan_splits_only_oversized_groups(spark):
    df = skewed(spark)
    assert plan_groups(df, KEYS, limit=1000).oversized is None
    plan = plan_groups(df, KEYS, limit=100)
    assert [r[0] for r in plan.oversized.collect()] == [0]
    spread = collected(screen.ordinals(df, plan=plan))
    assert spread == collected(screen.ordinals(df)) and len(spread) == 600


def thermo_rows(spark, gibbs, ensemble="m"):
    rows = [(ensemble, i, g, None, g) for i, g in enumerate(gibbs, 1)]
    schema = "ensemble_id string, conf_idx int, e_high_eh double, g_minus_eel_low_eh double, g_low_eh double"
    return spark.createDataFrame(rows, schema)


def test_composite_prefers_high_level_energy(spark):
    rows = [("m", 1, -1.0, 0.25, -9.0), ("m", 2, None, 0.25, -9.0), ("m", 3, -1.0, None, None)]
    df = spark.createDataFrame(rows, thermo_rows(spark, [0.0]).schema)
    assert [r[0] for r in df.orderBy("conf_idx").select(thermo.composite_gibbs()).collect()] == [-0.75, -9.0, None]
    assert [tuple(r) for r in thermo.thermo_failures(df).collect()] == [("m", 3, "missing_thermochem_or_energy_for_G")]


def test_relative_energies_and_standard_state(spark):
    df = thermo_rows(spark, [-76.500, -76.501, -76.502])
    plain = thermo.populations(df).orderBy("conf_idx").collect()
    molar = thermo.populations(df, standard_state="1M").orderBy("conf_idx").collect()
    assert [r.delta_g_kcal for r in plain] == pytest.approx([0.002 * 627.509474, 0.001 * 627.509474, 0.0])
    assert [b.delta_g_kcal - a.delta_g_kcal for a, b in zip(plain, molar)] == pytest.approx([1.8941975683244532] * 3)
    assert [r.weight for r in plain] == pytest.approx([r.weight for r in molar])
    assert sum(r.weight for r in plain) == pytest.approx(1.0)
    assert plain[0].cum_weight == pytest.approx(1.0)


def test_null_free_energy_stays_null(spark):
    got = thermo.populations(thermo_rows(spark, [-76.5, None, -76.502])).orderBy("conf_idx").collect()
    assert got[1].weight is None and got[1].cum_weight is None
    assert got[0].weight + got[2].weight == pytest.approx(1.0)


def test_equal_energies_share_equally(spark):
    got = thermo.populations(thermo_rows(spark, [-1.0] * 4)).collect()
    assert [r.weight for r in got] == pytest.approx([0.25] * 4)


def test_overflowing_sum_gives_null_and_stable_does_not(spark):
    df = spark.createDataFrame([("m", 1, -1e6), ("m", 2, 0.0)], "ensemble_id string, conf_idx int, delta_g_kcal double")
    assert [r.weight for r in thermo.boltzmann_weights(df, TaskGroups(KEYS), 298.15).collect()] == [None, None]
    stable = thermo.boltzmann_weights(df, TaskGroups(KEYS), 298.15, stable=True).orderBy("conf_idx").collect()
    assert [r.weight for r in stable] == pytest.approx([1.0, 0.0])


def test_bad_settings_raise(spark):
    with pytest.raises(ValueError):
        thermo.populations(thermo_rows(spark, [0.0]), temperature_k=0.0)
    with pytest.raises(ValueError):
        thermo.standard_state_shift("2atm", 298.15)


def test_populations_do_not_depend_on_the_strategy(spark):
    df = skewed(spark).select(
        "ensemble_id", "conf_idx", (F.col("energy_kcal") / K.HARTREE_TO_KCAL).alias("g_low_eh"),
        F.lit(None).cast("double").alias("e_high_eh"), F.lit(None).cast("double").alias("g_minus_eel_low_eh"),
    )
    columns = ["ensemble_id", "conf_idx", "weight", "cum_weight"]
    usual = thermo.populations(df).select(columns).orderBy(*columns[:2]).collect()
    spread = thermo.populations(df, plan=plan_groups(df, KEYS, limit=50)).select(columns).orderBy(*columns[:2]).collect()
    for a, b in zip(usual, spread, strict=True):
        assert tuple(a)[:2] == tuple(b)[:2] and tuple(a)[2:] == pytest.approx(tuple(b)[2:])


def test_cover_is_the_smallest_set(spark):
    rows = thermo.populations(thermo_rows(spark, [0.0, 0.0005, 0.001, 0.02]))
    kept = [r.conf_idx for r in thermo.population_cover(rows).orderBy("conf_idx").collect()]
    weights = [r.weight for r in rows.orderBy("conf_idx").collect()]
    assert sum(weights[i - 1] for i in kept) >= 0.9 > sum(weights[i - 1] for i in kept[:-1])


def test_renormalize(spark):
    rows = [("a", 1, 0.2), ("a", 2, None), ("a", 3, 0.6), ("b", 1, None), ("c", 1, 0.0)]
    df = spark.createDataFrame(rows, "ensemble_id string, conf_idx int, weight double")
    got = {(r.ensemble_id, r.conf_idx): r.weight for r in thermo.renormalize(df).collect()}
    assert got[("a", 1)] == pytest.approx(0.25) and got[("a", 3)] == pytest.approx(0.75)
    assert got[("a", 2)] is None and got[("b", 1)] is None and got[("c", 1)] is None
    assert math.isclose(thermo.standard_state_shift("1mol", 298.15), 1.8941975683244532)


def test_summary_rounds_sums_that_end_just_below_a_half(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    catalog.load()
    rows = [(4, 1, "F", 300650.0), (5, 1, "O", 300651.0), (8, 2, "P", 17.5), (9, 3, "P", 1.0)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    want = duckdb.connect().execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'").execute(
        catalog.ORACLES["sink_summary_json"]).fetchall()
    got = [tuple(r) for r in catalog.QUERIES["sink_summary_json"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    assert '"Gmin_eh":-75.962607,' in dict(got)[1]
