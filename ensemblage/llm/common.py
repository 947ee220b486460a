"""What several operators share: reading tables, words, and ordinals of large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The white space between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[ \t\n\x0B\f\r]"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Everything in ASCII that is not a digit or a lower-case letter becomes a space; other bytes stay.
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
PLAIN_WORDS = bytes(b if b in _KEEP else 32 for b in _PLAIN)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain_words(text: str | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN_WORDS).split()


def blank_words(text: Column) -> Column:
    """Words between blanks as an array; none of a null or blank text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, BLANK_CLASS + "+"))


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A stored table of short rows, to be broadcast if it has at most ``most`` of them; else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ordinal(df: DataFrame, name: str, group: Sequence[str], order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    Rows are dealt to buckets by a hash of ``order``; each bucket is numbered alone and starts where the
    buckets before it end. ``df`` is read twice, so it should be a stored table.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = [*group, "_bucket"]
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*cells).count()
        .select(*cells, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*cells).orderBy(*order)
    numbered = dealt.withColumn("_inside", F.row_number().over(inside).cast("long") - 1)
    return (
        numbered.join(starts, cells)
        .withColumn(name, F.col("_inside") + F.col("_start"))
        .drop("_bucket", "_inside", "_start")
    )
