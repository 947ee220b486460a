"""Quality rules by distribution divergence, with built-in functions only.

A document's histogram of character classes and of its language's most common words is compared with the
language's own reference by the Jensen-Shannon distance (base 2, 0 to 1). References come from all given
documents of a language: summed character classes and the ``common`` most frequent words.

Defined results: a null text has no words and fails the base rules; a null language is a language of its own;
a repeated row gets its own result; columns beyond doc_id, text and lang are ignored; an empty table gives no
rows. A language with fewer than ``min_reference_words`` words gives no verdict, nor does a text with fewer
than ``min_words`` words (which the base rules fail anyway).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ensemblage.llm.common import BLANK_CLASS, blank_words, small
from ensemblage.session import cut_lineage

#: Each class is taken out of what the classes before it left; the rest is "other" (outside ASCII).
CLASSES = (
    ("lower", "[a-z]+"), ("blank", BLANK_CLASS + "+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"),
    ("symbol", "[#*$%&|<>]+"), ("mark", r"[\x00-\x7F]+"),
)
CLASS_NAMES = (*[name for name, _ in CLASSES], "other")
MIN_WORDS = 50
COMMON = 30
CHARACTER_LIMIT = 0.30
WORD_LIMIT = 0.45
MIN_REFERENCE_WORDS = 2_000


def _class_counts(df: DataFrame) -> DataFrame:
    """Count the characters of each class in _text into n_<class>."""
    df = df.withColumn("_left", F.col("_text"))
    for name, pattern in CLASSES:
        df = df.withColumn("_next", F.regexp_replace("_left", pattern, ""))
        df = df.withColumn(f"n_{name}", (F.length("_left") - F.length("_next")).cast("long"))
        df = df.drop("_left").withColumnRenamed("_next", "_left")
    return df.withColumn("n_other", F.length("_left").cast("long")).drop("_left")


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("_text"), F.coalesce("lang", F.lit("")).alias("_lang")
    ).withColumn("_words", blank_words(F.col("_text")))


def _covered(df: DataFrame) -> DataFrame:
    """n_repeat_words: words that stand in a window of three words found twice or more.

    Only texts in which some window repeats have their windows sorted; equal ones are then neighbours.
    """
    words = F.col("_words")
    hashes = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_hashes", hashes)
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    windows = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_windows", F.when(repeats, windows)).drop("_hashes")
    others = F.size("_windows") - 1
    equal = F.filter(
        F.zip_with(
            F.slice("_windows", F.lit(1), others), F.slice("_windows", F.lit(2), others),
            lambda a, b: F.when(a["h"] == b["h"], F.struct(a["i"].alias("a"), b["i"].alias("b"))),
        ),
        lambda pair: pair.isNotNull(),
    )
    df = df.withColumn("_equal", F.when(F.col("_windows").isNotNull(), equal)).drop("_windows")
    at = F.array_sort(F.array_distinct(F.concat(
        F.transform("_equal", lambda x: x["a"]), F.transform("_equal", lambda x: x["b"])
    )))
    df = df.withColumn("_at", at).drop("_equal")
    steps = F.zip_with(
        "_at", F.concat(F.array(F.lit(-3)), F.slice("_at", F.lit(1), F.size("_at") - 1)),
        lambda here, before: F.least(F.lit(3), here - before),
    )
    covered = F.when(F.col("_at").isNotNull(), F.aggregate(steps, F.lit(0), lambda total, step: total + step)).otherwise(0)
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("_at")


def common_words(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """One row per language: its most frequent words over all documents, as the array ref_words."""
    counts = _prepared(docs).select("_lang", F.explode_outer("_words").alias("word")).groupBy("_lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("count"), "word"))
    return (
        counts.where(F.col("word").isNotNull()).withColumn("_rank", rank).where(F.col("_rank") <= common)
        .groupBy("_lang").agg(F.array_sort(F.collect_list("word")).alias("ref_words"))
    )


def histograms(docs: DataFrame, words: DataFrame) -> DataFrame:
    """Per document: the base counts, the counts of character classes, and those of its language's common words."""
    df = _class_counts(_prepared(docs))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    df = df.withColumns({"_lines": lines, "n_words": F.size("_words").cast("long")})
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines", "_text")
    df = _covered(df).join(small(words), "_lang", "left")
    df = df.withColumn("_known", F.filter("_words", lambda w: F.array_contains("ref_words", w))).drop("_words")
    counts = F.transform("ref_words", lambda w: (F.size("_known") - F.size(F.array_remove("_known", w))).cast("long"))
    return df.select(
        "doc_id", "_lang", "n_words", "n_dup_lines", "n_repeat_words",
        sum(F.col(f"n_{c}") for c in CLASS_NAMES if c != "blank").alias("word_chars"), F.col("n_symbol").alias("n_symbols"),
        F.array(*[f"n_{c}" for c in CLASS_NAMES]).alias("classes"),
        F.concat(counts, F.array(F.col("n_words") - F.size("_known"))).alias("common"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / ((a + b) / 2))).otherwise(0.0)

    cells = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(cells, F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))


def _sum(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)


def _shares(name: str) -> Column:
    return F.transform(name, lambda c: c / F.col(f"{name}_total"))


def language_references(rows: DataFrame, common: int = COMMON) -> DataFrame:
    """Sums of both histograms over all documents of each language."""
    cells = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASS_NAMES))]
    cells += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(common + 1)]
    kept = F.filter(F.array(*[f"w{i}" for i in range(common + 1)]), lambda c: c.isNotNull())
    return rows.groupBy("_lang").agg(*cells).select(
        "_lang", F.array(*[f"c{i}" for i in range(len(CLASS_NAMES))]).alias("ref_classes"), kept.alias("ref_common")
    )


def judge(
    docs: DataFrame, *, common: int = COMMON, min_words: int = MIN_WORDS, min_reference_words: int = MIN_REFERENCE_WORDS,
    character_limit: float = CHARACTER_LIMIT, word_limit: float = WORD_LIMIT,
) -> DataFrame:
    """Base counts, both distances and the verdict of every document.

    js_classes and js_words are null where a guard holds; ``reason`` names the first rule that fails. Texts are
    read twice: for the common words, and for the histograms, which are stored.
    """
    rows = cut_lineage(histograms(docs, cut_lineage(common_words(docs, common), "common_words")), "histograms")
    df = rows.join(small(cut_lineage(language_references(rows, common), "references")), "_lang", "left")
    pairs = ("classes", "ref_classes", "common", "ref_common")
    df = df.withColumns({f"{name}_total": _sum(F.col(name)) for name in pairs})
    df = df.withColumns({f"{name}_share": _shares(name) for name in pairs})
    total = F.col("n_words")
    guarded = (total >= min_words) & (F.col("ref_common_total") >= min_reference_words)
    df = df.withColumns({
        "js_classes": F.when(guarded, js_distance(F.col("classes_share"), F.col("ref_classes_share"))),
        "js_words": F.when(guarded, js_distance(F.col("common_share"), F.col("ref_common_share"))),
        "base_failed": (total < min_words) | (100 * F.col("n_repeat_words") > 50 * total),
    })
    reason = (
        F.when(total < min_words, "short").when(F.col("base_failed"), "repeats")
        .when(F.col("js_classes") > character_limit, "characters").when(F.col("js_words") > word_limit, "words")
    )
    return df.withColumn("reason", reason).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("reason").isNull().alias("kept"), "js_classes", "js_words", "reason",
    )
