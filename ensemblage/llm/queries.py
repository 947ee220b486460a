"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.llm import bagminhash, bpe, chat, cotraining, decontaminate, fuzzylines, lengths, packing, pitmanyor, repair, rules, sharding, tokens, vectorcodes
from ensemblage.llm.common import table
from ensemblage.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes, by source, language and length."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), "source", "lang", "n_chars"
    )
    sharded = sharding.kd_shards(rows, ["source", "lang", "n_chars"], "size", shards=8)
    return sharding.with_slots(sharded, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query
def op2_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, by a model of those whose remainder isn't 2."""
    train = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    return pitmanyor.score(table(spark, folder, "documents"), train)


@_query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Chance of a bad document by content, by metadata and by both, and the verdict, for all documents."""
    docs = table(spark, folder, "documents")
    return cotraining.score(docs, cotraining.fit(docs, table(spark, folder, "labels")))


@_query
def op4_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, quantile ranks and truncated totals for every encoded length of all documents."""
    counts = lengths.histogram(tokens.encoded_lengths(table(spark, folder, "documents")))
    return lengths.context_limits(cut_lineage(counts, "lengths"))


@_query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents inside windows of benchmark items, and the items they are from."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op6_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return bagminhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


@_query
def op7_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of every document that go, and the documents that keep an occurrence of them."""
    return fuzzylines.line_report(table(spark, folder, "documents"))


@_query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    pieces = tokens.encoded_pieces(table(spark, folder, "documents"), 2048)
    stored = cut_lineage(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(stored, 2048)


@_query
def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted and read back."""
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(conversations.unionByName(tricky)))


@_query
def op10_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and divergence verdict of all documents."""
    return rules.judge(table(spark, folder, "documents")).drop("js_classes", "js_words")


@_query
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations damaged in a fixed way, and their cheapest repairs."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repair.report(repair.damaged(conversations), conversations)


@_query
def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return bpe.round_trips(table(spark, folder, "documents"))


@_query
def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings, and the codebooks fitted to them."""
    return vectorcodes.report(table(spark, folder, "embeddings"))
