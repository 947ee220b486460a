"""From buckets of candidates to links and connected groups, without all pairs of a large bucket.

A bucket of at most ``SMALL`` members is compared pair by pair. In a larger one a leader is compared with every
member: the member that shares the most and largest buckets, which among copies is the one changed least. What the
leader isn't linked to, directly or through others, gets the best of the rest as its next leader, which is again
compared with all members of other groups; a bucket is finished when nothing is left or a leader finds no link.
Each round is linear in the members, no members are left out, and nothing is capped. What leaders leave apart is then
compared pair by pair, or by finer buckets where the caller has some.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.session import cut_lineage

SMALL = 16
#: Members of a block, of which two are compared in one go.
BLOCK = 1_000
#: Edges per task where their number is known.
EDGES = 200_000


def _mark(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1])


def components(edges: DataFrame, followed: bool = True) -> DataFrame:
    """id and root (the least id of its group) of every id in ``edges`` (a, b).

    Edges that fit a task are followed by one, in Python, unless ``followed`` is false. More alternate two steps until they fit or nothing changes: all larger
    neighbours of a node move to its least neighbour, then a node and its smaller neighbours do. The number of rounds
    grows with the logarithm of a group's size.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut_lineage(e, "edges")
    mark = _mark(e)
    while not followed or mark[0] > EDGES:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select("a", F.col("m").alias("b")))
        tasks = max(1, -(-mark[0] // EDGES))  # edges never become more
        following = cut_lineage(small.where(F.col("a") != F.col("b")).distinct().coalesce(tasks), "edges", replaces=e)
        e, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    if followed and mark[0] <= EDGES:
        e = cut_lineage(e.coalesce(1).mapInArrow(_followed, e.schema), "edges", replaces=e)
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One edge to the least id of its group from every other id of at most ``EDGES`` edges (a, b)."""
    root: dict[Any, Any] = {}

    def top(x: Any) -> Any:
        while (above := root.setdefault(x, x)) != x:
            root[x] = root[above]  # halves the path
            x = above
        return x

    kind = None
    for batch in batches:
        kind = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    if kind is not None:
        ends = [(x, top(x)) for x in list(root)]
        columns = list(zip(*[(x, least) for x, least in ends if x != least], strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind.field(i).type) for i, c in enumerate(columns)], schema=kind)


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Stored rows (key, id, size) of the keys that several ids have; rows are distinct (key, id)."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    return cut_lineage(rows.join(sizes, "key"), "buckets")


def groups_of(
    buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], possible: Callable[[Column, Column], Column] | None = None,
    finer: Callable[[DataFrame], tuple[DataFrame, Callable[[Column, Column], Column]]] | None = None, followed: bool = True,
) -> DataFrame:
    """id and root of the members of stored ``buckets`` (key, id, size and others) that have links.

    ``verify`` gets distinct candidate pairs (a, b) and returns those that hold. ``possible`` tells from two rows of
    a bucket, as structs, whether they can hold; pairs that can't are never made. ``finer`` gets the ids of members that
    leaders leave apart, and returns stored buckets (key, id and others) in which all that hold among them meet, with
    a ``possible`` of their own; without it they are compared pair by pair. ``followed`` is for ``components``.
    """
    values = [name for name in buckets.columns if name not in ("key", "size")]
    member = F.struct(*values)

    def paired(met: DataFrame, possible: Callable[[Column, Column], Column] | None = possible) -> DataFrame:
        """a and b of the rows whose members left and right may be linked."""
        met = met if possible is None else met.where(possible(F.col("left"), F.col("right")))
        return met.select(F.least("left.id", "right.id").alias("a"), F.greatest("left.id", "right.id").alias("b"))

    few = buckets.where(F.col("size") <= SMALL)
    pairs = few.select("key", member.alias("left")).join(few.select("key", member.alias("right")), "key")
    pairs = paired(pairs.where(F.col("left.id") < F.col("right.id")))
    large = buckets.where(F.col("size") > SMALL)
    if large.isEmpty():
        return components(cut_lineage(verify(cut_lineage(pairs.distinct(), "pairs")), "links"), followed)
    score = buckets.groupBy("id").agg(F.sum("size").alias("score"))
    large = cut_lineage(large.select("key", *values).join(score, "id"), "large")
    best = F.max_by(member, F.struct("score", "id")).alias("leader")
    leaders = cut_lineage(large.groupBy("key").agg(best), "leaders")

    def with_members(chosen: DataFrame, members: DataFrame) -> DataFrame:
        met = members.select("key", member.alias("left")).join(chosen.select("key", F.col("leader").alias("right")), "key")
        return paired(met.where(F.col("left.id") != F.col("right.id")))

    tested = cut_lineage(pairs.unionByName(with_members(leaders, large)).distinct(), "pairs")
    links = cut_lineage(verify(tested), "links")
    active = leaders.select("key")
    while True:
        groups = components(links, followed)
        members = large.join(active, "key", "left_semi").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
        members = cut_lineage(members, "members")
        led = members.join(leaders.select("key", F.col("leader.id").alias("id")), ["key", "id"]).select("key", "root").distinct()
        following = cut_lineage(members.join(led, ["key", "root"], "left_anti").groupBy("key").agg(best), "next_leaders")
        if following.isEmpty():
            break
        own = members.join(following.select("key", F.col("leader.id").alias("id")), ["key", "id"]).select("key", F.col("root").alias("own"))
        others = members.join(own, "key").where(F.col("root") != F.col("own"))
        pairs = cut_lineage(with_members(following, others).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        found = cut_lineage(verify(pairs), "links")
        if found.isEmpty():
            break
        ends = found.select(F.col("a").alias("leader")).unionByName(found.select(F.col("b").alias("leader"))).distinct()
        active = cut_lineage(following.select("key", F.col("leader.id").alias("leader")).join(ends, "leader", "left_semi").select("key"), "active")
        leaders = cut_lineage(leaders.unionByName(following), "leaders")
        links = cut_lineage(links.unionByName(found), "links")
        tested = cut_lineage(tested.unionByName(pairs), "pairs")
    tested = tested.unionByName(pairs)
    if finer is not None:
        rooted = _rooted(large, groups)
        fine, possible = finer(rooted.join(_mixed(rooted), "key", "left_semi").select("id").distinct())
        large, values = fine.drop("size"), [name for name in fine.columns if name not in ("key", "size")]
        # each member meets the first of every bucket, so that copies are in one group before pairs are made
        rooted = _rooted(large, groups)
        members = rooted.select("key", F.struct(*values).alias("left"), F.col("root").alias("_left_root"))
        first = rooted.groupBy("key").agg(F.min_by(F.struct(F.struct(*values).alias("right"), F.col("root").alias("_right_root")), F.struct(*values)).alias("first"))
        met = members.join(first.select("key", "first.*"), "key").where(F.col("_left_root") != F.col("_right_root"))
        pairs = cut_lineage(paired(met, possible).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        found = cut_lineage(verify(pairs), "links")
        tested, links = tested.unionByName(pairs), links.unionByName(found)
        groups = groups if found.isEmpty() else components(links, followed)
    pairs = cut_lineage(paired(_across(large, groups, values), possible).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
    found = cut_lineage(verify(pairs), "links")
    return groups if found.isEmpty() else components(links.unionByName(found), followed)


def _rooted(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))


def _mixed(rooted: DataFrame) -> DataFrame:
    """key and number of members of the buckets whose members are not all in one group."""
    return rooted.groupBy("key").agg(F.count("*").alias("members"), (F.min("root") != F.max("root")).alias("mixed")).where("mixed")


def _across(large: DataFrame, groups: DataFrame, values: list[str]) -> DataFrame:
    """Members left and right of each pair in a bucket of ``large`` that isn't in one group.

    A bucket is dealt into blocks by hash, and each pair of blocks is joined by itself, so that it is spread.
    """
    rooted = _rooted(large, groups)
    mixed = _mixed(rooted)
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = rooted.join(mixed, "key").select("key", "root", F.struct(*values).alias("member"), parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("block"))
    dealt = cut_lineage(dealt, "dealt")
    left = dealt.select("key", F.col("block").alias("p"), F.explode(F.sequence("block", F.col("parts") - 1)).alias("q"), F.col("member").alias("left"), F.col("root").alias("_left_root"))
    right = dealt.select("key", F.explode(F.sequence(F.lit(0), "block")).alias("p"), F.col("block").alias("q"), F.col("member").alias("right"), F.col("root").alias("_right_root"))
    once = (F.col("p") < F.col("q")) | (F.col("left.id") < F.col("right.id"))
    return left.join(right, ["key", "p", "q"]).where(once & (F.col("_left_root") != F.col("_right_root")))
