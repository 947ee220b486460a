"""Near-duplicate documents by BagMinHash signatures of word shingles with their counts.

A document is a bag of shingles of five words. For each shingle and each strip of weight, (0,1], (1,2], (2,4],
(4,8] and so on, a Poisson process with the strip's width as its rate throws points at the signature's slots;
a strip that the count fills in part takes the points whose weight level it covers. Each slot keeps its
earliest point, so two slots agree with the chance of the bags' weighted Jaccard similarity. Only points before a
time that fills all slots almost surely are made, and more where a slot stayed empty, so the result is that of
the full processes.

Documents that share a band of the signature are candidates; their bags are then compared exactly.
Defined results: equal texts are one class, named by its least doc_id, null if it has none; texts of any length are compared
as whole bags; a null text or one without words is a class of its own; a text of
fewer than five words is one shingle; a repeated row gets the same class; columns beyond doc_id and text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.llm.common import plain_words
from ensemblage.llm.neighbours import groups_of, shared_buckets
from ensemblage.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
SLOTS = BANDS * ROWS
#: Characters whose documents are signed at once, and words whose hashes a worker remembers.
AT_ONCE, REMEMBERED = 2_000_000, 300_000
#: Counters by which shingles are put in order, rare ones first; any order finds the same, this one meets few others.
COUNTERS = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # the finaliser of splitmix64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _nth(number: int) -> np.uint64:
    """number steps of the golden ratio, modulo 2^64."""
    return np.uint64(int(_STEP) * number % (1 << 64))


def _unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from the upper bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def bag(words: list[bytes], hashes: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, sorted, and how often each occurs."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    coded = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    shingles = np.full(n, np.uint64(size))
    for i in range(size):
        shingles = _mixed(shingles * _STEP + coded[i : i + n])
    return np.unique(shingles, return_counts=True)


def overlap(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(left[1][a], right[1][b]).sum())
    total = int(left[1].sum() + right[1].sum()) - common
    return common / total if total else 0.0


def _strips(elements: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per element and strip of weight: seed, lower end, width, the element's count, and the owner."""
    seeds, lows, widths, upto, whose = [], [], [], [], []
    low, width, level = 0, 1, 0
    while len(elements):
        seeds.append(_mixed(elements + _nth(level + 1)))
        lows.append(np.full(len(elements), low))
        widths.append(np.full(len(elements), width))
        upto.append(counts)
        whose.append(owners)
        low, width, level = low + width, low + width, level + 1
        more = counts > low
        elements, counts, owners = elements[more], counts[more], owners[more]
    return tuple(np.concatenate(x) for x in (seeds, lows, widths, upto, whose))


def signatures_of(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """A row of ``slots`` 64-bit values per bag; zeros for an empty bag."""
    sizes = np.array([len(b[0]) for b in bags])
    weights = np.array([int(b[1].sum()) for b in bags], np.float64)
    values = np.zeros((len(bags), slots), np.uint64)
    open_bags = np.flatnonzero(sizes)
    span = np.log(slots) + 5.0
    while len(open_bags):
        elements = np.concatenate([bags[i][0] for i in open_bags])
        counts = np.concatenate([bags[i][1] for i in open_bags]).astype(np.int64)
        owners = np.repeat(np.arange(len(open_bags)), sizes[open_bags])
        seeds, low, width, upto, whose = _strips(elements, counts, owners)
        until = (slots * span / weights[open_bags])[whose]
        times = np.zeros(len(seeds))
        keys, at, marks = [], [], []
        number = 0
        while len(seeds):
            number += 1
            raw = _mixed(seeds + _nth(number))
            times = times - np.log(_unit(raw)) / width
            alive = times <= until
            seeds, low, width, upto, whose, until, times, raw = (x[alive] for x in (seeds, low, width, upto, whose, until, times, raw))
            place = _mixed(raw ^ _STEP)
            level = low + np.ceil(_unit(_mixed(place + _STEP)) * width)
            counted = level <= upto
            keys.append(whose[counted] * slots + (place[counted] % np.uint64(slots)).astype(np.int64))
            at.append(times[counted])
            marks.append(raw[counted])
        key, time, mark = np.concatenate(keys), np.concatenate(at), np.concatenate(marks)
        latest_first = np.lexsort((mark, -time))
        found = np.zeros(len(open_bags) * slots, np.uint64)
        filled = np.zeros(len(open_bags) * slots, bool)
        found[key[latest_first]] = mark[latest_first]
        filled[key] = True
        full = filled.reshape(-1, slots).all(axis=1)
        values[open_bags[full]] = found.reshape(-1, slots)[full]
        open_bags = open_bags[~full]
        span *= 2
    return values


def _digest(text: str = "text"):  # type: ignore[no-untyped-def]
    return F.unhex(F.md5(F.col(text)))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), n_words and signature (empty without words) of each document with a text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            start = 0
            texts = batch.column(2).to_pylist()
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and size < AT_ONCE:
                    size += len(texts[stop])
                    stop += 1
                words = [plain_words(t) for t in texts[start:stop]]
                values = signatures_of([bag(w, hashes) for w in words])
                lengths = np.array([SLOTS if w else 0 for w in words])
                flat = values[lengths > 0].ravel().view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat))
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(w) for w in words], pa.int64()), lists],
                    names=["doc_id", "digest", "n_words", "signature"],
                )
                start = stop
                if len(hashes) > REMEMBERED:
                    hashes.clear()

    rows = docs.where(F.col("text").isNotNull()).select("doc_id", _digest().alias("digest"), "text")
    return rows.mapInArrow(sign, f"doc_id {kind}, digest binary, n_words bigint, signature array<bigint>")


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose bags are similar enough; texts are stored (id, text)."""
    both = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            keep = []
            last, held = None, None
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                left = left.as_py()
                if left != last:  # rows of a leader follow each other
                    last, held = left, bag(plain_words(left), hashes)
                keep.append(overlap(held, bag(plain_words(right.as_py()), hashes)) >= similarity)
            if len(hashes) > REMEMBERED:
                hashes.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(compare, "a binary, b binary")


def _tokens(text: str, hashes: dict[bytes, int]) -> np.ndarray:
    """A hash for each shingle of a bag, and for each time that it comes again another."""
    shingles, counts = bag(plain_words(text), hashes)
    again = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(np.repeat(shingles, counts) + again.astype(np.uint64) * _STEP)


def _rare_tokens(texts: DataFrame, similarity: float) -> DataFrame:
    """Stored rows (key, at, n, id, size) of the rarest tokens of texts (id, text) that another text has among its own.

    Bags that are similar share one of the first n - similarity * n + 1 of their n tokens in any common order.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = _Hashes(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column(1):
                total += np.bincount((_tokens(text.as_py(), hashes) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            if len(hashes) > REMEMBERED:
                hashes.clear()
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(total[slots])], names=["slot", "n"])

    found = texts.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most COUNTERS rows
    table = np.zeros(COUNTERS, np.int64)
    table[found.column(0).to_numpy()] = found.column(1).to_numpy()
    frequent = texts.sparkSession.sparkContext.broadcast(table)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _Hashes(), frequent.value
        for batch in batches:
            keys, sizes = [np.empty(0, np.uint64)], []
            for text in batch.column(1):
                tokens = _tokens(text.as_py(), hashes)
                order = np.lexsort((tokens, counts[(tokens % np.uint64(COUNTERS)).astype(np.int64)]))
                keys.append(tokens[order[: len(tokens) - int(np.ceil(similarity * len(tokens) - 1e-9)) + 1]])
                sizes.append((len(keys[-1]), len(tokens)))
            if len(hashes) > REMEMBERED:
                hashes.clear()
            taken = np.array(sizes, np.int64).reshape(-1, 2)
            rows = np.repeat(np.arange(len(taken)), taken[:, 0])
            at = np.arange(len(rows)) - np.repeat(np.cumsum(taken[:, 0]) - taken[:, 0], taken[:, 0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(at), pa.array(taken[rows, 1]), batch.column(0).take(pa.array(rows))],
                names=["key", "at", "n", "id"],
            )

    return shared_buckets(texts.mapInArrow(rarest, "key bigint, at bigint, n bigint, id binary"))


def _may_share(left: Column, right: Column, similarity: float) -> Column:
    """Whether bags that share no token before this one can have enough in common."""
    common = F.least(left["n"] - left["at"], right["n"] - right["at"])
    return common >= (left["n"] + right["n"]) * (similarity / (1 + similarity)) - 1e-9


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, digest and class_id (the least doc_id of its class) of each document.

    Work is done once per different text. The corpus is shuffled once by digest, to fetch the texts of candidates.
    """
    signed = cut_lineage(
        signatures(docs).select("doc_id", "digest", "n_words", F.when(F.col("n_words") > 0, F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("signature", i * ROWS + 1, F.lit(ROWS)))
        )).alias("bands")), "signed",
    )
    different = signed.where(F.col("n_words") > 0).select(F.col("digest").alias("id"), "bands").dropDuplicates(["id"])
    buckets = shared_buckets(different.select(F.explode("bands").alias("key"), "id").distinct())
    wanted = buckets.select("id").distinct()
    found = docs.where(F.col("text").isNotNull()).select(_digest().alias("id"), "text").join(wanted, "id", "left_semi")
    texts = cut_lineage(found.dropDuplicates(["id"]), "texts")
    groups = groups_of(
        buckets, lambda pairs: _similar(pairs, texts, similarity),
        finer=lambda ids: (_rare_tokens(texts.join(ids, "id", "left_semi").select("id", "text"), similarity), lambda left, right: _may_share(left, right, similarity)),
    )
    placed = signed.join(groups.withColumnRenamed("id", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    placed = placed.select("doc_id", "digest", F.when(F.col("n_words") > 0, F.col("root")).alias("root"))
    placed = cut_lineage(placed, "placed")
    first = placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    grouped = placed.where(F.col("root").isNotNull()).join(first, "root").select("doc_id", "digest", "class_id", "class_size")
    alone = placed.where(F.col("root").isNull()).select("doc_id", "digest").unionByName(
        docs.where(F.col("text").isNull()).select("doc_id", F.lit(None).cast("binary").alias("digest"))
    ).select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return grouped.unionByName(alone)


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with the least doc_id of their class, each once; documents without text or words all stay.

    A document without doc_id goes if its class has one with a doc_id; of equal texts without any doc_id one stays.
    """
    classes = near_duplicates(docs, similarity).where(F.col("digest").isNotNull() & F.col("class_id").isNotNull())
    dropped = classes.where(~F.col("doc_id").eqNullSafe(F.col("class_id")))
    dropped = cut_lineage(dropped.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_gone")).distinct(), "dropped")
    marked = docs.withColumn("_digest", _digest())
    kept = marked.join(dropped, marked["doc_id"].eqNullSafe(dropped["_doc"]) & (marked["_digest"] == dropped["_gone"]), "left_anti")
    worded = F.col("text").isNotNull() & F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]")
    return kept.where(worded).dropDuplicates(["doc_id", "_digest"]).unionByName(kept.where(~F.coalesce(worded, F.lit(False)))).drop("_digest")
