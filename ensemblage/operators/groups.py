"""Per-group statistics that hold when one group owns a large share of all rows.

Most ensembles are small: a window over one hash exchange answers everything about them. An ensemble
whose rows exceed the per-task limit never enters such a window. Its aggregates are pre-aggregated on
the map side and joined back from a table with one row per oversized key, and its ordered sums run over
range partitions whose offsets are added afterwards. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ensemblage.session import cut_lineage, group_limit


@dataclass(frozen=True)
class TaskGroups:
    """Groups that each fit one task."""

    keys: tuple[str, ...]

    def with_aggs(self, df: DataFrame, **aggs: Column) -> DataFrame:
        window = Window.partitionBy(*self.keys)
        return df.withColumns({name: agg.over(window) for name, agg in aggs.items()})

    def running_sum(
        self, df: DataFrame, name: str, value: Column, order: Sequence[Column], where: Column | None = None
    ) -> DataFrame:
        where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        window = (
            Window.partitionBy(*self.keys)
            .orderBy(where.desc(), *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.withColumn(name, F.when(where, F.sum(F.when(where, value)).over(window)))

    def ordinal(self, df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
        window = Window.partitionBy(*self.keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window))

    def previous(self, df: DataFrame, name: str, value: Column, order: Sequence[Column]) -> DataFrame:
        window = Window.partitionBy(*self.keys).orderBy(*order)
        return df.withColumn(name, F.lag(value).over(window))

    def attach(self, df: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        """Join a table that has one row per key."""
        return join_on(df, table, self.keys, how)


@dataclass(frozen=True)
class SpreadGroups:
    """Oversized groups: there are at most (all rows / limit) of them, so one row per key is broadcast."""

    keys: tuple[str, ...]
    oversized: DataFrame | None = None
    ranges: int = 0

    def with_aggs(self, df: DataFrame, **aggs: Column) -> DataFrame:
        stats = df.groupBy(*self.keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
        renamed = stats.select(*[F.col(k).alias(f"_of_{k}") for k in self.keys], *aggs)
        return df.join(F.broadcast(renamed), _same(df, renamed, self.keys), "left").drop(*[f"_of_{k}" for k in self.keys])

    def attach(self, df: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        """Join a table that has one row per key, of which only the oversized keys are broadcast."""
        if self.oversized is not None:
            table = join_on(table, F.broadcast(self.oversized), self.keys, "left_semi")
        return join_on(df, F.broadcast(table), self.keys, how)

    def _ranged(self, df: DataFrame, order: Sequence[Column]) -> DataFrame:
        # Written out so that both readers see the same range bounds; no range holds much more than a task may.
        parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), self.ranges)
        ranged = df.repartitionByRange(parts, *[F.col(k) for k in self.keys], *order)
        return cut_lineage(ranged.withColumn("_range", F.spark_partition_id()), "ranged")

    def running_sum(
        self, df: DataFrame, name: str, value: Column, order: Sequence[Column], where: Column | None = None
    ) -> DataFrame:
        where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        tagged = df.withColumns({"_where": where, "_value": F.when(where, value)})
        ranged = self._ranged(tagged, [F.col("_where").desc(), *order])
        cells = [*self.keys, "_range"]
        before = Window.partitionBy(*self.keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            ranged.groupBy(*cells)
            .agg(F.sum("_value").alias("_total"))
            .select(*cells, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
        )
        inside = (
            Window.partitionBy(*cells)
            .orderBy(F.col("_where").desc(), *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        # offsets: one row per oversized key and range partition
        return (
            join_on(ranged, F.broadcast(offsets), cells, "left")
            .withColumn(name, F.when(F.col("_where"), F.sum("_value").over(inside) + F.col("_offset")))
            .drop("_where", "_value", "_range", "_offset")
        )

    def ordinal(self, df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
        summed = self.running_sum(df, name, F.lit(1), order)
        return summed.withColumn(name, F.col(name).cast("int"))

    def previous(self, df: DataFrame, name: str, value: Column, order: Sequence[Column]) -> DataFrame:
        ranged = self._ranged(df.withColumn("_value", value), order)
        cells = [*self.keys, "_range"]
        upto = Window.partitionBy(*self.keys).orderBy("_range")
        edges = (
            ranged.groupBy(*cells)
            .agg(F.max_by("_value", F.struct(*order)).alias("_edge"))
            .select(*cells, F.lag("_edge").over(upto).alias("_edge"))
        )
        inside = Window.partitionBy(*cells).orderBy(*order)
        return (
            join_on(ranged, F.broadcast(edges), cells, "left")
            .withColumn("_first", F.row_number().over(inside) == 1)
            .withColumn(name, F.when(F.col("_first"), F.col("_edge")).otherwise(F.lag("_value").over(inside)))
            .drop("_value", "_range", "_edge", "_first")
        )


@dataclass(frozen=True)
class GroupPlan:
    """How the groups of a table are to be processed, after their sizes were checked."""

    keys: tuple[str, ...]
    oversized: DataFrame | None
    ranges: int = 0

    def apply(self, df: DataFrame, step: Callable[[DataFrame, TaskGroups | SpreadGroups], DataFrame]) -> DataFrame:
        """Run ``step`` on the ordinary groups and, where there are any, on the oversized ones."""
        if self.oversized is None:
            return step(df, TaskGroups(self.keys))
        renamed = self.oversized.select(*[F.col(k).alias(f"_of_{k}") for k in self.keys])
        oversized, same = F.broadcast(renamed), _same(df, renamed, self.keys)
        usual = step(df.join(oversized, same, "left_anti"), TaskGroups(self.keys))
        spread = step(df.join(oversized, same, "left_semi"), SpreadGroups(self.keys, self.oversized, self.ranges))
        return usual.unionByName(spread)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL, with one column per key. ``how``: inner, left, left_semi or left_anti."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    joined = left.join(renamed, _same(left, renamed, keys), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_of_{k}" for k in keys])


def _same(df: DataFrame, renamed: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, where NULL equals NULL: a large group may be the one without a key."""
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"_of_{k}"]) for k in keys])


def plan_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> GroupPlan:
    """Count rows per key (a scan of the key columns only) and list the keys beyond ``limit``."""
    limit = group_limit(df.sparkSession) if limit is None else limit
    oversized = cut_lineage(df.groupBy(*keys).count().where(F.col("count") > limit), "oversized")
    rows = oversized.agg(F.sum("count")).first()[0]
    if rows is None:
        return GroupPlan(tuple(keys), None)
    return GroupPlan(tuple(keys), oversized.select(*keys), -(-rows // limit))
