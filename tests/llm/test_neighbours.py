"""Groups from buckets against all pairs."""

import random

import pytest

from ensemblage.llm import neighbours


def brute(buckets, linked):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for members in buckets:
        for a in members:
            for b in members:
                if a < b and (a, b) in linked:
                    low, high = sorted((top(a), top(b)))
                    root[high] = low
    return {x: top(x) for pair in linked for x in pair if x in root}


def found(spark, buckets, linked, **options):
    rows = [(key, i, i % 7) for key, members in enumerate(buckets) for i in members]
    stored = neighbours.shared_buckets(spark.createDataFrame(rows, "key bigint, id bigint, mark bigint"))
    held = spark.createDataFrame(sorted(linked), "a bigint, b bigint")
    groups = neighbours.groups_of(stored, lambda pairs: pairs.join(held, ["a", "b"], "left_semi"), **options)
    return {r["id"]: r["root"] for r in groups.collect()}


def test_links_among_many_unlike_members(spark):
    linked = {(0, 1), (2, 3), (4, 9), (9, 11)}  # far below the members that lead
    assert found(spark, [range(60)], linked) == brute([range(60)], linked)


def test_link_between_members_of_two_led_groups(spark):
    linked = {(i, 59) for i in range(10, 30)} | {(i, 58) for i in range(30, 50)} | {(12, 33)}
    assert found(spark, [range(60)], linked) == brute([range(60)], linked)


@pytest.mark.parametrize("block", [5, 1_000])
def test_random_links(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = random.Random(block)
    buckets = [rng.sample(range(120), n) for n in (70, 40, 17, 16, 9, 2)]
    linked = {(a, b) for a, b in ((rng.randrange(120), rng.randrange(120)) for _ in range(60)) if a < b}
    assert found(spark, buckets, linked) == brute(buckets, linked)
    same = {(a, b) for a, b in linked if a % 7 == b % 7}
    assert found(spark, buckets, linked, possible=lambda a, b: a["mark"] == b["mark"]) == brute(buckets, same)
    assert found(spark, buckets, same) == brute(buckets, same)


@pytest.mark.parametrize("edges", [10, 200_000])
def test_few_edges_are_followed_by_one_task(spark, monkeypatch, edges):
    written, cut = [], neighbours.cut_lineage
    monkeypatch.setattr(neighbours, "cut_lineage", lambda df, *rest, **options: written.append(1) or cut(df, *rest, **options))
    monkeypatch.setattr(neighbours, "EDGES", edges)
    chain = [(str(i).encode(), str(i + 1).encode()) for i in range(10, 50)]
    roots = {bytes(r["id"]): bytes(r["root"]) for r in neighbours.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert roots == {str(i).encode(): b"10" for i in range(10, 51)}
    assert len(written) == 2 or edges < 40
