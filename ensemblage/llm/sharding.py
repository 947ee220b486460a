"""Sharding by a K-d tree over metadata, with leaves of nearly equal bytes.

Each node is split along the dimension in which its rows lie widest, at the weighted median of its bytes (or at
the quantile that suits an odd number of leaves), until a leaf holds the target bytes. Medians are found on
Spark: bytes are summed by node and bin before the shuffle, the bin that holds the median is opened in two
finer steps, and rows of equal coordinates are told apart by a hash, so a hot value is split like any other.
The driver holds one row per node, of which there are at most twice as many as shards.

Coordinates lie between 0 and 1: numbers by their range, other values by a hash of their text.

Defined results: null dimensions count as 0 or as the empty text, null sizes as 0; equal rows may part; an empty
table gives no rows; columns that clash with shard and slot are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from ensemblage.llm.common import ordinal, small
from ensemblage.session import cut_lineage

#: Bins of the three steps: twice along the dimension, then along the hash.
BINS = (1024, 1024, 4096)


@dataclass(frozen=True)
class Node:
    leaves: int
    first: int  # the shard of its first leaf


def _coordinates(rows: DataFrame, dims: Sequence[str]) -> dict[str, Column]:
    numbers = [d for d in dims if isinstance(rows.schema[d].dataType, NumericType)]
    bounds: dict[str, float] = {}
    if numbers:
        row = rows.agg(*[f(F.col(d).cast("double")).alias(f"{k}_{d}") for d in numbers for k, f in (("low", F.min), ("high", F.max))]).first()
        bounds = {k: v or 0.0 for k, v in row.asDict().items()} if row else {}
    found = {}
    for d in dims:
        if d in numbers:
            low, width = bounds[f"low_{d}"], bounds[f"high_{d}"] - bounds[f"low_{d}"]
            found[d] = F.coalesce((F.col(d).cast("double") - low) / (width or 1.0), F.lit(0.0))
        else:
            found[d] = F.pmod(F.xxhash64(F.coalesce(F.col(d).cast("string"), F.lit(""))), F.lit(1 << 52)) / float(1 << 52)
    return found


def _medians(rows: DataFrame, goals: dict[int, float], nodes: DataFrame) -> dict[int, int]:
    """Per node the place p, so that the bytes at places up to p come closest to its goal."""
    placed = rows.join(small(nodes), "_node").withColumn("_part", (F.col("_x") - F.col("low")) / F.col("width"))
    scaled = F.least(F.floor(F.col("_part") * (BINS[0] * BINS[1])), F.lit(BINS[0] * BINS[1] - 1))
    placed = placed.withColumn("_place", (scaled * BINS[2] + F.col("_tie")).cast("long")).select("_node", "_place", "_size")
    spark = rows.sparkSession
    base = {node: 0 for node in goals}
    before = {node: 0 for node in goals}
    width = BINS[0] * BINS[1] * BINS[2]
    for step, bins in enumerate(BINS):
        finer = width // bins
        opened = small(spark.createDataFrame([(n, base[n], float(goals[n] - before[n])) for n in goals], "_node int, base long, goal double"))
        within = placed.join(opened, "_node").where((F.col("_place") >= F.col("base")) & (F.col("_place") < F.col("base") + width))
        sums = within.groupBy("_node", F.floor((F.col("_place") - F.col("base")) / finer).alias("bin")).agg(F.sum("_size").alias("size"), F.first("goal").alias("goal"))
        upto = Window.partitionBy("_node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("upto", F.sum("size").over(upto)).withColumn("off", F.abs(F.col("upto") - F.col("goal")))
        if step < len(BINS) - 1:
            # the first bin that reaches the goal is opened
            chosen = run.where(F.col("upto") >= F.col("goal")).groupBy("_node").agg(F.min_by(F.struct("bin", F.col("upto") - F.col("size")), "bin").alias("at"))
            for r in chosen.collect():
                base[r["_node"]] += r["at"][0] * finer
                before[r["_node"]] += r["at"][1]
        else:
            chosen = run.groupBy("_node").agg(F.min_by(F.struct("bin", "off"), F.struct("off", "bin")).alias("at"))
            for r in chosen.collect():
                node = r["_node"]
                # nothing of this bin may be closer still
                base[node] += r["at"][0] if r["at"][1] <= abs(goals[node] - before[node]) else -1
        width = finer
    return base


def kd_shards(rows: DataFrame, dims: Sequence[str], size: str, *, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """Add ``shard`` to stored rows: ceil(all bytes / target_bytes) shards, or ``shards`` of them."""
    rows = rows.drop("shard")
    # the tie decides among rows with equal coordinates; rows that are equal in all columns go together
    hashed = F.pmod(F.xxhash64(*rows.columns), F.lit(BINS[2])).cast("int")
    table = cut_lineage(rows.select(
        F.struct(*rows.columns).alias("_row"), F.lit(0).alias("_node"), F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("_size"),
        hashed.alias("_tie"), F.array(*_coordinates(rows, dims).values()).alias("_at"),
    ), "kd")
    total = table.agg(F.sum("_size")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes)) if target_bytes else 1
    spark = rows.sparkSession
    nodes = {0: Node(shards, 0)}
    while any(n.leaves > 1 for n in nodes.values()):
        inner = [k for k, n in nodes.items() if n.leaves > 1]
        split = table.where(F.col("_node").isin(inner)) if len(inner) <= 64 else table
        ranges = split.groupBy("_node").agg(
            F.sum("_size").alias("bytes"), *[f(F.get("_at", F.lit(i))).alias(f"{k}{i}") for i in range(len(dims)) for k, f in (("low", F.min), ("high", F.max))]
        ).collect()  # a row per node
        choice, goals = [], {}
        for r in ranges:
            node = r["_node"]
            if nodes[node].leaves < 2:
                continue
            widest = max(range(len(dims)), key=lambda i: (r[f"high{i}"] - r[f"low{i}"], -i))
            choice.append((node, widest, r[f"low{widest}"], (r[f"high{widest}"] - r[f"low{widest}"]) or 1.0))
            goals[node] = r["bytes"] * (nodes[node].leaves // 2) / nodes[node].leaves
        axes = spark.createDataFrame(choice, "_node int, dim int, low double, width double")
        along = split.join(small(axes.select("_node", "dim")), "_node").select("_node", F.get("_at", F.col("dim")).alias("_x"), "_tie", "_size")
        cuts = _medians(along, goals, axes.drop("dim"))
        following: dict[int, Node] = {}
        moves = []
        for k, n in nodes.items():
            if n.leaves == 1:
                following[k] = n
            elif k in cuts:
                following[2 * k + 1] = Node(n.leaves // 2, n.first)
                following[2 * k + 2] = Node(n.leaves - n.leaves // 2, n.first + n.leaves // 2)
                _, dim, low, width = next(c for c in choice if c[0] == k)
                moves.append((k, dim, low, width, cuts[k]))
        cut_table = small(spark.createDataFrame(moves, "_node int, dim int, low double, width double, cut long"))
        x = (F.get("_at", F.col("dim")) - F.col("low")) / F.col("width")
        place = F.least(F.floor(x * (BINS[0] * BINS[1])), F.lit(BINS[0] * BINS[1] - 1)) * BINS[2] + F.col("_tie")
        moved = table.join(cut_table, "_node", "left").withColumn(
            "_node", F.when(F.col("cut").isNull(), F.col("_node")).when(place <= F.col("cut"), 2 * F.col("_node") + 1).otherwise(2 * F.col("_node") + 2)
        )
        table = cut_lineage(moved.select(*table.columns), "kd", replaces=table)
        nodes = following
    names = small(spark.createDataFrame([(k, n.first) for k, n in nodes.items()] or [(0, 0)], "_node int, shard int"))
    return table.join(names, "_node").select("_row.*", "shard")


def with_slots(sharded: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``slot``, the place in the shard from 0 without gaps."""
    return ordinal(cut_lineage(sharded.drop("slot"), "sharded"), "slot", ["shard"], order)


def write_shards(docs: DataFrame, places: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write documents below ``path``, a folder per shard, with rows in order of slot inside each file."""
    joined = docs.join(places.select(key, "shard", "slot"), key)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
