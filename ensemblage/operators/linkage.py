"""Single-linkage dendrograms of many ensembles, and their cuts at a distance or a number of clusters.

The dendrogram comes from the minimum spanning tree of each ensemble. Edges are ordered by (distance, lower index, higher
index), so the tree is unique, whichever way it is found. An ensemble that fits a task grows its tree member by member
there. Members in one place are joined to the lowest of them, which stands for them all: that is what the order of edges
asks for, as no edge is shorter. Larger ensembles, by their places, go through Borůvka's rounds: each component finds its nearest other component, first inside blocks of
members that are close in space, which bounds how far it has to look; then only blocks whose boxes are within that bound
of each other meet. Components at least halve in every round. Blocks, not members, are compared box by box.

Merge number m joins the cluster called ``right`` to the one called ``left``; a cluster's name is its lowest index, so
every member but the lowest stops being a name at exactly one merge. A cut follows these names through the merges that it
allows, halving the remaining way in each round, and needs neither distances nor trees.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.operators.groups import SpreadGroups, TaskGroups, join_on, plan_groups
from ensemblage.session import cut_lineage

MEMBER = ["ensemble_id", "conf_idx"]
#: Places of an ensemble whose tree one task grows, in time quadratic in them; larger ensembles go through rounds.
TREE_ROWS = 40_000
#: Members of a block, and merges that one task turns into clusters at once.
BLOCK_ROWS = 1_024
MERGES_AT_ONCE = 1_000_000


def _squares(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    total = np.zeros(len(points))
    for axis in range(points.shape[1]):  # in this order everywhere, so that equal distances are equal
        gap = points[:, axis] - one[axis]
        total += gap * gap
    return total


def grown_tree(ids: np.ndarray, points: np.ndarray) -> list[tuple[int, int, float]]:
    """(a, b, square) of the edges of the least spanning tree, a < b."""
    edges: list[tuple[int, int, float]] = []
    ids, points = ids.copy(), np.array(points, order="F")
    square, near = np.full(len(ids), np.inf), np.full(len(ids), ids[0])
    at = 0
    for n in range(len(ids) - 1, 0, -1):
        mine, here = ids[at], points[at].copy()
        for values in (ids, points, square, near):  # the first n stay outside the tree
            values[at] = values[n]
        seen = _squares(points[:n], here)
        better, ties = seen < square[:n], np.flatnonzero(seen == square[:n])
        if len(ties):
            low, high = np.minimum(mine, ids[ties]), np.maximum(mine, ids[ties])
            old_low, old_high = np.minimum(near[ties], ids[ties]), np.maximum(near[ties], ids[ties])
            better[ties] = (low < old_low) | ((low == old_low) & (high < old_high))
        np.copyto(square[:n], seen, where=better)
        near[:n][better] = mine
        least = np.flatnonzero(square[:n] == square[:n].min())
        a, b, at = min((min(near[i], ids[i]), max(near[i], ids[i]), i) for i in least)
        edges.append((int(a), int(b), float(square[at])))
    return edges


def spanning_tree(points: DataFrame, coordinates: list[str], task_rows: int | None = None) -> DataFrame:
    """ensemble_id, a, b (a < b), square: the edges of each ensemble's least spanning tree, one fewer than its members."""
    kinds = [points.schema[c].dataType.simpleString() for c in MEMBER]
    schema = f"ensemble_id {kinds[0]}, a {kinds[1]}, b {kinds[1]}, square double"
    rows = points.select(*MEMBER, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(coordinates)])
    xs = [f"x{i}" for i in range(len(coordinates))]

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        found = grown_tree(frame["conf_idx"].to_numpy(), frame[xs].to_numpy())
        tree = pd.DataFrame(found, columns=["a", "b", "square"])
        tree.insert(0, "ensemble_id", frame["ensemble_id"].iloc[0])
        return tree

    def step(part: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        if isinstance(groups, TaskGroups):
            return part.groupBy("ensemble_id").applyInPandas(grow, schema)
        return _boruvka(part, xs, groups, schema)

    places = cut_lineage(rows.groupBy("ensemble_id", *xs).agg(F.min("conf_idx").alias("conf_idx")), "places")
    tree = plan_groups(places, ("ensemble_id",), task_rows or TREE_ROWS).apply(places.select(rows.columns), step)
    first = places.withColumnRenamed("conf_idx", "first")
    copies = join_on(rows, first, ["ensemble_id", *xs]).where("conf_idx <> first")
    return tree.unionByName(copies.select("ensemble_id", F.col("first").alias("a"), F.col("conf_idx").alias("b"), F.lit(0.0).alias("square")))


def _z_order(xs: list[str], low: list[Column], high: list[Column]) -> Column:
    """Interleaved bits of the coordinates' places between the ensemble's ends."""
    bits = max(1, 60 // len(xs))
    steps = [
        F.least(F.lit(2**bits - 1), F.floor(F.when(h > a, (F.col(x) - a) / (h - a)).otherwise(F.lit(0.0)) * 2**bits)).cast("long")
        for x, a, h in zip(xs, low, high, strict=True)
    ]
    total: Column = F.lit(0).cast("long")
    for bit in range(bits):
        for i, step in enumerate(steps):
            total = total.bitwiseOR(F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(xs) + i))
    return total


EDGE = "struct<square:double,a:bigint,b:bigint,other:bigint>"


def _boruvka(rows: DataFrame, xs: list[str], groups: SpreadGroups, schema: str) -> DataFrame:
    ends = {f"{end}_{x}": f(F.col(x)) for x in xs for end, f in (("low", F.min), ("high", F.max))}
    placed = groups.with_aggs(rows, **ends)
    placed = placed.withColumn("z", _z_order(xs, [F.col(f"low_{x}") for x in xs], [F.col(f"high_{x}") for x in xs])).select(*MEMBER, *xs, "z")
    numbered = groups.ordinal(placed, "n", [F.col("z"), F.col("conf_idx")])
    blocks = numbered.select(*MEMBER, *xs, F.floor((F.col("n") - 1) / BLOCK_ROWS).cast("long").alias("block"))
    members = cut_lineage(blocks.withColumn("part", F.col("conf_idx").cast("long")), "members")
    kind = rows.schema["ensemble_id"].dataType.simpleString()
    found_schema = f"ensemble_id {kind}, part bigint, square double, a bigint, b bigint, other bigint"

    def nearest(ensemble: object, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Per component of ``left`` the least edge to another component's members in ``right``."""
        points, ids, parts = right[xs].to_numpy(), right["conf_idx"].to_numpy(), right["part"].to_numpy()
        best: dict[int, tuple[float, int, int, int]] = {}
        for mine, part, one in zip(left["conf_idx"].to_numpy(), left["part"].to_numpy(), left[xs].to_numpy(), strict=True):
            away = np.flatnonzero(parts != part)
            if len(away):
                squares = _squares(points[away], one)
                close = away[squares == squares.min()]
                edge = min((float(squares.min()), int(min(mine, ids[i])), int(max(mine, ids[i])), int(parts[i])) for i in close)
                best[part] = min(best.get(part, edge), edge)
        table = pd.DataFrame([(ensemble, part, *edge) for part, edge in best.items()], columns=["ensemble_id", "part", "square", "a", "b", "other"])
        return table

    def inside(frame: pd.DataFrame) -> pd.DataFrame:
        return nearest(frame["ensemble_id"].iloc[0], frame, frame)

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        one, two = frame[frame["block"] == frame["left"]], frame[frame["block"] == frame["right"]]
        ensemble = frame["ensemble_id"].iloc[0]
        return pd.concat([nearest(ensemble, one, two), nearest(ensemble, two, one)])

    edges: list[DataFrame] = []
    while True:
        near = cut_lineage(members.groupBy("ensemble_id", "block").applyInPandas(inside, found_schema), "near")
        bounds = near.groupBy("ensemble_id", "part").agg(F.min("square").alias("bound"))
        parts = members.groupBy("ensemble_id", "block", "part").agg(
            *[f(x).alias(f"{end}_{x}") for x in xs for end, f in (("low", F.min), ("high", F.max))])
        boxes = join_on(parts, bounds, ["ensemble_id", "part"], "left").groupBy("ensemble_id", "block").agg(
            F.max(F.coalesce("bound", F.lit(float("inf")))).alias("bound"), F.min("part").alias("least"), F.max("part").alias("most"),
            *[f(f"{end}_{x}").alias(f"{end}_{x}") for x in xs for end, f in (("low", F.min), ("high", F.max))])
        boxes = cut_lineage(boxes, "boxes")
        pairs = _block_pairs(boxes, xs)
        if pairs is None:
            found = near
        else:
            ends_of = pairs.select("ensemble_id", "left", "right", F.explode(F.array("left", "right")).alias("block"))
            met = join_on(ends_of, members, ["ensemble_id", "block"]).groupBy("ensemble_id", "left", "right").applyInPandas(across, found_schema)
            found = near.unionByName(met)
        best = found.groupBy("ensemble_id", "part").agg(F.min(F.struct("square", "a", "b", "other")).alias("edge"))
        best = cut_lineage(best.select("ensemble_id", "part", "edge.*"), "best")
        if best.isEmpty():
            break
        edges.append(best.select("ensemble_id", "a", "b", "square").distinct())
        members = cut_lineage(join_on(members, _roots(best), ["ensemble_id", "part"], "left").withColumn(
            "part", F.coalesce("root", "part")).drop("root"), "members", replaces=members)
    tree = edges[0] if edges else members.select("ensemble_id", *[F.col("conf_idx").alias(c) for c in "ab"], F.lit(0.0).alias("square")).limit(0)
    for more in edges[1:]:
        tree = tree.unionByName(more)
    names = [column.split(" ")[1] for column in schema.split(", ")]
    return tree.select("ensemble_id", F.col("a").cast(names[1]).alias("a"), F.col("b").cast(names[2]).alias("b"), "square")


def _block_pairs(boxes: DataFrame, xs: list[str]) -> DataFrame | None:
    """Pairs of blocks that may hold a component's nearest: boxes within the bound of one of the two, not of one component."""
    sides = [boxes.select("ensemble_id", *[F.col(c).alias(f"{side}_{c}") for c in boxes.columns if c != "ensemble_id"]) for side in "ij"]
    met = join_on(sides[0], sides[1], ["ensemble_id"]).where("i_block <> j_block")
    pure = (F.col("i_least") == F.col("i_most")) & (F.col("j_least") == F.col("j_most")) & (F.col("i_least") == F.col("j_least"))
    met = met.where(~pure)
    gap = [F.greatest(F.col(f"i_low_{x}") - F.col(f"j_high_{x}"), F.col(f"j_low_{x}") - F.col(f"i_high_{x}"), F.lit(0.0)) for x in xs]
    span = [F.greatest(F.col(f"i_high_{x}") - F.col(f"j_low_{x}"), F.col(f"j_high_{x}") - F.col(f"i_low_{x}")) for x in xs]
    least, most = (sum((d * d for d in ds), F.lit(0.0)) * (1 + sign * 1e-12) for ds, sign in ((gap, -1), (span, 1)))
    met = met.select("ensemble_id", "i_block", "j_block", "i_least", "i_bound", "j_bound", least.alias("least"), most.alias("most"))
    # a component without an edge inside its blocks is no farther from others than the far ends of some block of another one
    far = met.where(F.col("i_bound") == float("inf")).groupBy("ensemble_id", "i_least").agg(F.min("most").alias("far"))
    bounded = join_on(met, far, ["ensemble_id", "i_least"], "left").withColumn("bound", F.least("i_bound", F.coalesce("far", F.lit(float("inf")))))
    pairs = cut_lineage(bounded.where(F.col("least") <= F.col("bound")).select(
        "ensemble_id", F.least("i_block", "j_block").alias("left"), F.greatest("i_block", "j_block").alias("right")).distinct(), "block_pairs")
    return None if pairs.isEmpty() else pairs


def _roots(best: DataFrame) -> DataFrame:
    """ensemble_id, part, root: components joined along their least edges, which form no ring but of two."""
    back = best.select("ensemble_id", F.col("part").alias("other"), F.col("other").alias("back"))
    hooked = join_on(best.select("ensemble_id", "part", "other"), back, ["ensemble_id", "other"], "left")
    mutual = (F.col("back") == F.col("part")) & (F.col("part") < F.col("other"))
    return follow(hooked.select("ensemble_id", F.col("part").alias("name"), F.when(mutual, F.col("part")).otherwise(F.col("other")).alias("root"))
                  ).withColumnRenamed("name", "part")


def follow(pointers: DataFrame) -> DataFrame:
    """ensemble_id, name, root: where the pointers from ``name`` to ``root`` lead in the end; each round halves the way."""
    pointers = cut_lineage(pointers.select("ensemble_id", "name", "root"), "pointers")
    while True:
        further = pointers.select("ensemble_id", F.col("name").alias("root"), F.col("root").alias("next"))
        moved = join_on(pointers, further, ["ensemble_id", "root"], "left").select(
            "ensemble_id", "name", F.coalesce("next", "root").alias("root"),
            (F.col("next").isNotNull() & (F.col("next") != F.col("root"))).alias("moved"))
        moved = cut_lineage(moved, "pointers", replaces=pointers)
        if moved.where("moved").isEmpty():
            return moved.select("ensemble_id", "name", "root")
        pointers = moved


def dendrogram(points: DataFrame, coordinates: list[str], task_rows: int | None = None, at_once: int | None = None) -> DataFrame:
    """ensemble_id, merge (from 1), left, right, height, size: the merges of single linkage by (height, lower, higher index)."""
    tree = cut_lineage(spanning_tree(points, coordinates, task_rows), "tree")
    at_once = at_once or MERGES_AT_ONCE
    plan = plan_groups(tree, ("ensemble_id",), at_once)
    kinds = [points.schema[c].dataType.simpleString() for c in MEMBER]
    schema = f"ensemble_id {kinds[0]}, merge bigint, left {kinds[1]}, right {kinds[1]}, height double, size bigint"
    order = [F.col("square"), F.col("a"), F.col("b")]

    def merges(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("merge")
        name: dict[int, int] = {}
        size: dict[int, int] = dict(zip([*frame["a"], *frame["b"]], [*frame["a_size"], *frame["b_size"]], strict=True))

        def top(x: int) -> int:
            while (up := name.get(x, x)) != x:
                name[x] = name.get(up, up)
                x = up
            return x

        out = []
        for number, a, b, square in zip(frame["merge"], frame["a"], frame["b"], frame["square"], strict=True):
            left, right = sorted((top(a), top(b)))
            name[right] = left
            size[left] += size[right]
            out.append((number, left, right, np.sqrt(square), size[left]))
        table = pd.DataFrame(out, columns=["merge", "left", "right", "height", "size"])
        table.insert(0, "ensemble_id", frame["ensemble_id"].iloc[0])
        return table

    def step(part: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        numbered = groups.ordinal(part, "merge", order).withColumn("merge", F.col("merge").cast("long"))
        if isinstance(groups, TaskGroups):
            one = [F.lit(1).cast("long").alias(f"{e}_size") for e in "ab"]
            return numbered.select("*", *one).groupBy("ensemble_id").applyInPandas(merges, schema)
        # runs of merges one after the other: each starts from the clusters that the runs before have made
        numbered = cut_lineage(numbered, "numbered_edges")
        last = numbered.agg(F.max("merge")).first()[0]
        done: DataFrame | None = None
        for start in range(0, last, at_once):
            run = numbered.where((F.col("merge") > start) & (F.col("merge") <= start + at_once))
            for e in "ab":
                if done is None:
                    run = run.withColumn(f"{e}_size", F.lit(1).cast("long"))
                    continue
                names = cut(done, merges_until=start).select("ensemble_id", F.col("conf_idx").alias(e), F.col("label").alias(f"{e}_name"))
                sizes = done.groupBy("ensemble_id", F.col("left").alias(f"{e}_name")).agg(F.max("size").alias(f"{e}_size"))
                run = join_on(run, names, ["ensemble_id", e], "left").withColumn(e, F.coalesce(f"{e}_name", e)).drop(f"{e}_name")
                run = join_on(run, sizes.withColumnRenamed(f"{e}_name", e), ["ensemble_id", e], "left").fillna(1, [f"{e}_size"])
            made = cut_lineage(run.groupBy("ensemble_id").applyInPandas(merges, schema), "merges")
            done = made if done is None else done.unionByName(made)
        return done

    return plan.apply(tree, step)


def cut(
    merges: DataFrame, points: DataFrame | None = None, n_clusters: int | None = None, distance: float | None = None, merges_until: int | None = None,
) -> DataFrame:
    """ensemble_id, conf_idx, label: clusters of a dendrogram, named by their lowest index.

    Stops before the last ``n_clusters`` - 1 merges of each ensemble, at a ``distance`` (which still joins), or at a merge's
    number. With ``points``, members of ensembles of one member are listed too; without, only those that some merge names.
    """
    if n_clusters is not None:
        if n_clusters < 1:
            raise ValueError(f"n_clusters must be at least 1, got {n_clusters}")
        counts = merges.groupBy("ensemble_id").agg((F.max("merge") - (n_clusters - 1)).alias("_until"))
        allowed = join_on(merges, counts, ["ensemble_id"]).where(F.col("merge") <= F.col("_until"))
    elif distance is not None:
        allowed = merges.where(F.col("height") <= distance)
    else:
        allowed = merges.where(F.col("merge") <= merges_until)
    ends = follow(allowed.select("ensemble_id", F.col("right").alias("name"), F.col("left").alias("root")))
    named = ends.select("ensemble_id", F.col("name").alias("conf_idx"), F.col("root").alias("label"))
    if points is None:
        return named
    return join_on(points.select(*MEMBER), named, MEMBER, "left").withColumn("label", F.coalesce("label", "conf_idx"))
