"""The exact histogram of encoded lengths, and what its sums say for every context limit.

Documents are counted by length (summed before the shuffle), so a row per distinct length remains; sums over
the lengths from a length on then give totals, quantiles and truncated totals exactly. Running sums go over
spans of lengths first, so no task sees more than one span's lengths and the list of spans.

Defined results: a null or empty text is one token, its end id; repeated rows count each; null lengths are left
out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Lengths per span of the two-step running sums.
SPAN = 4096


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """n_tokens and n_docs."""
    return lengths.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def context_limits(counts: DataFrame) -> DataFrame:
    """For each length L of a histogram:

    docs_from and tokens_from: documents of length L or more and their tokens (suffix sums); truncated_total:
    tokens kept if every document is cut at L; docs_cut: documents longer than L; tokens_cut: tokens lost;
    padded_total: n * L if all are also filled up to L; rank_low and rank_high: the ranks (from 1) in order of
    length that have this length, so quantile q is the L with rank_low <= ceil(q * n) <= rank_high; share_upto.
    """
    spans = counts.withColumn("_span", F.floor(F.col("n_tokens") / SPAN)).withColumn("_tokens", F.col("n_tokens") * F.col("n_docs"))
    later = Window.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        spans.groupBy("_span").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
        .select("_span", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs_later"), F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens_later"),
                F.sum("_d").over(everything).alias("total_docs"), F.sum("_t").over(everything).alias("total_tokens"))
    )
    inside = Window.partitionBy("_span").orderBy(F.desc("n_tokens"))
    rows = spans.withColumns({"_docs_in": F.sum("n_docs").over(inside), "_tokens_in": F.sum("_tokens").over(inside)}).join(offsets, "_span")
    limit, n = F.col("n_tokens"), F.col("total_docs")
    rows = rows.withColumns({"docs_from": F.col("_docs_in") + F.col("_docs_later"), "tokens_from": F.col("_tokens_in") + F.col("_tokens_later")})
    rows = rows.withColumns({
        "truncated_total": F.col("total_tokens") - F.col("tokens_from") + limit * F.col("docs_from"),
        "docs_cut": F.col("docs_from") - F.col("n_docs"),
        "rank_low": n - F.col("docs_from") + 1,
        "rank_high": n - F.col("docs_from") + F.col("n_docs"),
    })
    return rows.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", "truncated_total", "docs_cut",
        (F.col("total_tokens") - F.col("truncated_total")).alias("tokens_cut"), (n * limit).alias("padded_total"),
        "rank_low", "rank_high", (F.col("rank_high") / n).alias("share_upto"), "total_docs", "total_tokens",
    )
