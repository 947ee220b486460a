"""Small fixed tables whose size the optimizer can see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table with a ``position`` column; it is small by construction and joins by broadcast."""
    fields = T.StructType.fromDDL(schema).fields

    def entry(row: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])

    listed = spark.range(1).select(F.posexplode(F.array(*[entry(r) for r in rows])).alias("position", "row"))
    return listed.select("row.*", F.col("position").cast("long").alias("position"))


def word_map(words: dict[str, object]) -> Column:
    """A literal map column."""
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
