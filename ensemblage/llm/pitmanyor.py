"""A hierarchical Pitman-Yor language model over words: every context of one word is a restaurant, and all of
them share one parent, whose own parent is uniform.

Words are counted in blocks of documents, and a few packed arrays per block and partition travel instead of a row
per word:

1. Blocks send their words to partitions by a hash of the word, which count them over all blocks, number them by
   falling count, and send numbers and counts back.
2. Blocks send their pairs of neighbouring words to partitions by context. There the customers of each context are
   seated by Gibbs sampling: the tables of a dish are drawn given all others, sweep by sweep. A context with
   more than ``HOT`` customers is spread over several partitions by its words.
3. Tables go to the word's partition as the customers of the parent restaurant, which is seated in the same way.
4. Blocks get counts, tables and parent probabilities of just the words and pairs they hold, and score their
   documents.

What a partition holds grows with the corpus divided by the number of partitions; the driver holds sums only.
Predictive probabilities are averaged over the kept sweeps of both levels. In the first level the parent's
probabilities are the words' training frequencies; they are exact in the scores.

Words are told apart by 64-bit hashes. Defined results: a null text is empty and has its end token only; repeated
rows are documents of their own, all counted; an empty table gives no rows; other columns are ignored; with no
training token every word is as likely as any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ensemblage.session import cut_lineage

#: Tokens per block, and customers of a context per partition.
BLOCK_TOKENS, HOT = 2_000_000, 250_000
#: Discount and strength of the contexts and of the parent.
DISCOUNT, STRENGTH = 0.85, 20.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.5, 10.0
BURN_IN, SWEEPS = 2, 3
#: Dishes with at most so many customers draw their tables from the exact conditional; others are seated one by one.
EXACT = 32
_END = b"\n"  # no word holds a blank

Arrays = tuple[np.ndarray, ...]
MESSAGE = "dest bigint, kind int, src bigint, payload binary"
_FIELDS = [("dest", pa.int64()), ("kind", pa.int32()), ("src", pa.int64()), ("payload", pa.binary())]


# -- packed arrays -----------------------------------------------------------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, byte planes apart."""
    press = zstandard.ZstdCompressor(level=1)
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b""
        body = press.compress(planes)
        parts.append(a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + len(body).to_bytes(8, "little") + body)
    return b"".join(parts)


def unpacked(payload: bytes) -> Arrays:
    found, at = [], 0
    press = zstandard.ZstdDecompressor()
    while at < len(payload):
        dtype = np.dtype(payload[at : at + 4].decode().strip())
        n, size = (int.from_bytes(payload[at + i : at + i + 8], "little") for i in (4, 12))
        at += 20
        planes = press.decompress(payload[at : at + size], max_output_size=max(n * dtype.itemsize, 1))
        at += size
        found.append(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, -1).T.copy().view(dtype).ravel() if n else np.empty(0, dtype))
    return tuple(found)


def _small(a: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as they need."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def exchanged(messages: DataFrame, partitions: int, work: Callable[[int, list[tuple[int, int, bytes]]], Iterator[tuple[int, int, int, bytes]]]) -> DataFrame:
    """Send messages to their ``dest`` and let ``work(dest, [(kind, src, payload)])`` answer with messages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: int | None = None
        held: list[tuple[int, int, bytes]] = []
        for batch in batches:
            for dest, kind, src, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if dest != here and held:
                    for row in work(here, held):  # type: ignore[arg-type]
                        yield _batch([row])
                    held = []
                here = dest
                held.append((kind, src, payload))
        if held:
            for row in work(here, held):  # type: ignore[arg-type]
                yield _batch([row])

    dealt = messages.repartition(partitions, "dest").sortWithinPartitions("dest", "kind", "src")
    return dealt.mapInArrow(run, MESSAGE)


# -- blocks ------------------------------------------------------------------------------------------------


@dataclass
class Block:
    docs: np.ndarray  # row numbers within the block have their doc_id in the block's table
    lengths: np.ndarray  # tokens with the end
    train: np.ndarray
    tokens: np.ndarray  # numbers of words within the block
    words: np.ndarray  # their hashes


def _blocks(docs: DataFrame) -> DataFrame:
    """block, doc_ids and payload: the tokens of runs of documents."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 24
        numbers: dict[bytes, int] = {}
        doc_ids: list[Any] = []
        lengths: list[int] = []
        train: list[bool] = []
        tokens: list[np.ndarray] = []
        held = made = 0

        def block() -> pa.RecordBatch:
            nonlocal numbers, doc_ids, lengths, train, tokens, held, made
            local = np.concatenate(tokens)
            order = np.argsort(-np.bincount(local, minlength=len(numbers)), kind="stable")  # frequent words get small numbers
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))[order]
            payload = packed(_small(np.array(lengths, np.uint64)), np.array(train, np.uint8), rank[local], hashes)
            row = pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([doc_ids], pa.list_(kind_arrow)), pa.array([payload], pa.binary())], names=["block", "doc_ids", "payload"]
            )
            numbers, doc_ids, lengths, train, tokens, held, made = {}, [], [], [], [], 0, made + 1
            return row

        for batch in batches:
            for doc_id, text, is_train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                words.append(_END)
                known = numbers
                for word in set(words).difference(known):
                    known[word] = len(known)
                tokens.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                doc_ids.append(doc_id)
                lengths.append(len(words))
                train.append(bool(is_train))
                held += len(words)
                if held >= BLOCK_TOKENS:
                    yield block()
        if held:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_type

    kind_arrow = to_arrow_type(docs.schema["doc_id"].dataType)
    return docs.select("doc_id", "text", "train").mapInArrow(read, f"block bigint, doc_ids array<{kind}>, payload binary")


def _block(payload: bytes) -> Block:
    lengths, train, tokens, words = unpacked(payload)
    return Block(np.arange(len(lengths)), lengths.astype(np.int64), train.astype(bool), tokens.astype(np.int64), words)


def _parts(words: np.ndarray, parts: int) -> list[np.ndarray]:
    """The block's words by partition, in order of their hash."""
    owner = (words % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((words, owner))
    cuts = np.searchsorted(owner[order], np.arange(parts + 1))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@dataclass
class Pairs:
    """The different pairs of a block in order of (context, word) by their numbers, and each token's pair."""

    contexts: np.ndarray
    words: np.ndarray
    counts: np.ndarray  # in training
    of_token: np.ndarray


def _pairs(block: Block, ids: np.ndarray) -> Pairs:
    n = len(block.words)
    end = int(block.tokens[-1])  # every document ends with the end token, which also stands before its first word
    before = np.concatenate([[end], block.tokens[:-1]])
    order = np.argsort(ids)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    codes, inverse = np.unique(place[before] * n + place[block.tokens], return_inverse=True)
    train = np.repeat(block.train, block.lengths)
    counts = np.bincount(inverse, weights=train, minlength=len(codes)).astype(np.int64)
    return Pairs(order[codes // n], order[codes % n], counts, inverse)


def _destinations(contexts: np.ndarray, words: np.ndarray, customers: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of pairs: by context, and by the word too where a context has many customers."""
    spread = (customers // HOT).astype(np.uint64) + np.uint64(1)
    key = contexts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (words.astype(np.uint64) % spread) * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    return (key % np.uint64(parts)).astype(np.int64)


# -- restaurants -------------------------------------------------------------------------------------------


def _stirling(discount: float) -> list[np.ndarray]:
    """log of the generalised Stirling numbers S(c, t) for t = 1..c, for c up to EXACT."""
    rows = [np.zeros(1)] * 2
    for c in range(1, EXACT):
        now = np.full(c + 1, -np.inf)
        now[:-1] = rows[c] + np.log(c - np.arange(1, c + 1) * discount)
        now[1:] = np.logaddexp(now[1:], rows[c])
        rows.append(now)
    return rows


def seat(
    restaurant: np.ndarray, customers: np.ndarray, parent: np.ndarray, others: np.ndarray, discount: float, strength: float,
    rng: np.random.Generator, sweeps: int = SWEEPS, burn_in: int = BURN_IN,
) -> np.ndarray:
    """Tables of each dish, summed over the kept sweeps.

    A dish has its restaurant's number, its customers and the parent's probability of it. ``others`` are per
    restaurant the times that its tables must be counted, where only a part of its dishes is here.
    """
    tables = np.ones(len(customers), np.int64)
    total = np.zeros(len(customers), np.int64)
    logs = _stirling(discount)
    log_parent = np.log(parent)
    several = [(c, np.flatnonzero(customers == c)) for c in range(2, EXACT + 1)]
    many = np.flatnonzero(customers > EXACT)
    for sweep in range(burn_in + sweeps):
        for c, at in [*several, (0, many)]:
            if not len(at):
                continue
            rest = np.bincount(restaurant, weights=tables, minlength=len(others)) * others
            rest = rest[restaurant[at]] - tables[at]
            if c:
                opened = np.log(strength + discount * (rest[:, None] + np.arange(c)))
                score = logs[c] + np.cumsum(opened, axis=1) + log_parent[at][:, None] * np.arange(1, c + 1)
                tables[at] = 1 + np.argmax(score + rng.gumbel(size=score.shape), axis=1)
            else:
                tables[at] = _one_by_one(customers[at], rest, parent[at], discount, strength, rng)
        if sweep >= burn_in:
            total += tables
    return total


def _one_by_one(customers: np.ndarray, rest: np.ndarray, parent: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Seat the customers of each dish in turn, given the tables of other dishes.

    The customer after i, with t tables, opens one with chance a / (a + i - discount * t), a growing with t. The
    first EXACT customers are seated singly; then the next opening is drawn at once from the chance that none of
    the customers up to j opens a table, ((i + s) / (j + s))^a, which the products approach as i grows.
    """
    tables = np.ones(len(customers), np.float64)
    for i in range(1, EXACT):
        a = (strength + discount * (rest + tables)) * parent
        tables += rng.random(len(tables)) * (a + i - discount * tables) < a
    at = np.full(len(customers), float(EXACT))
    open_dishes = np.arange(len(customers))
    while len(open_dishes):
        a = (strength + discount * (rest[open_dishes] + tables[open_dishes])) * parent[open_dishes]
        shift = a / 2 - discount * tables[open_dishes]
        jump = np.exp(np.minimum(-np.log1p(-rng.random(len(a))) / a, 60.0))
        at[open_dishes] = np.floor((at[open_dishes] + shift) * jump - shift) + 1
        still = at[open_dishes] <= customers[open_dishes]
        open_dishes = open_dishes[still]
        tables[open_dishes] += 1
    return tables.astype(np.int64)


# -- the whole model ---------------------------------------------------------------------------------------

WORDS, PAIRS, TABLES, BLOCK = 1, 2, 3, 0


def score(docs: DataFrame, train: Any, *, seed: int = 11) -> DataFrame:
    """Learn from the documents for which the column ``train`` is true, and score all.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score, both log10.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = cut_lineage(_blocks(docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))), "blocks")

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = _block(payload)
                counts = np.bincount(block.tokens, weights=np.repeat(block.train, block.lengths), minlength=len(block.words)).astype(np.uint64)
                for part, at in enumerate(_parts(block.words, parts)):
                    if len(at):
                        yield _batch([(part, WORDS, number, packed(block.words[at], _small(counts[at])))])

    def count_words(part: int, held: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        found = [(src, *unpacked(payload)) for _, src, payload in held]
        words, inverse = np.unique(np.concatenate([w for _, w, _ in found]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([c for _, _, c in found])).astype(np.int64)
        order = np.argsort(-counts, kind="stable")
        ids = np.empty(len(words), np.int64)
        ids[order] = np.arange(len(words)) * parts + part
        at = 0
        for src, asked, _ in found:
            mine = inverse[at : at + len(asked)]
            at += len(asked)
            yield src, WORDS, part, packed(_small(ids[mine]), _small(counts[mine]))
        yield -1, WORDS, part, packed(np.array([counts.sum(), (counts > 0).sum()], np.int64))

    numbered = cut_lineage(exchanged(blocks.select("block", "payload").mapInArrow(ask_words, MESSAGE), parts, count_words), "words")
    sums = [unpacked(bytes(r["payload"]))[0] for r in numbered.where("dest = -1").select("payload").collect()]  # a row per partition
    n_train, n_words = int(sum(s[0] for s in sums)), int(sum(s[1] for s in sums))
    answers = numbered.where("dest >= 0")
    as_messages = blocks.select(F.col("block").alias("dest"), F.lit(BLOCK).alias("kind"), F.lit(0).cast("bigint").alias("src"), "payload")

    def of_block(held: list[tuple[int, int, bytes]]) -> tuple[Block, np.ndarray, np.ndarray]:
        """The block, and its words' numbers and counts."""
        block = _block(held[0][2])
        at = _parts(block.words, parts)
        ids, counts = np.zeros(len(block.words), np.int64), np.zeros(len(block.words), np.int64)
        for kind_, src, payload in held:
            if kind_ == WORDS:
                some = unpacked(payload)
                ids[at[src]], counts[at[src]] = some[0], some[1]
        return block, ids, counts

    def ask_pairs(number: int, held: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        block, ids, counts = of_block(held)
        pairs = _pairs(block, ids)
        dest = _destinations(ids[pairs.contexts], ids[pairs.words], counts[pairs.contexts], parts)
        order = np.argsort(dest, kind="stable")  # stays in order of (context, word)
        cuts = np.searchsorted(dest[order], np.arange(parts + 1))
        size = np.minimum(np.round(8 * np.log2(counts + 1.0)), 255).astype(np.uint8)
        for part in range(parts):
            at = order[cuts[part] : cuts[part + 1]]
            if len(at):
                contexts, starts = np.unique(pairs.contexts[at], return_index=True)
                by_start = np.argsort(starts)
                contexts, starts = contexts[by_start], starts[by_start]
                yield part, PAIRS, number, packed(
                    _small(np.diff(ids[contexts], prepend=0)), _small(counts[contexts]), _small(np.diff(np.append(starts, len(at)))),
                    _small(ids[pairs.words[at]]), _small(pairs.counts[at]), size[pairs.words[at]],
                )

    def seat_contexts(part: int, held: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        context, customers_of, word, count, size, lengths = [], [], [], [], [], []
        for _, _, payload in held:
            gaps, totals, runs, words, counts, sizes = unpacked(payload)
            context.append(np.repeat(np.cumsum(gaps.astype(np.int64)), runs))
            customers_of.append(np.repeat(totals.astype(np.int64), runs))
            word.append(words.astype(np.int64))
            count.append(counts.astype(np.int64))
            size.append(sizes)
            lengths.append(len(words))
        contexts, u = np.unique(np.concatenate(context), return_inverse=True)
        words, w = np.unique(np.concatenate(word), return_inverse=True)
        _, first, inverse = np.unique(u * len(words) + w, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate(count)).astype(np.int64)
        u, w = u[first], w[first]
        parent = (2.0 ** (np.concatenate(size)[first] / 8.0)) / (n_train + n_words + 1)
        seen = np.flatnonzero(counts)
        # a spread context has about as many tables in each of its parts
        times = np.ones(len(contexts), np.int64)
        times[u] = np.concatenate(customers_of)[first] // HOT + 1
        tables = np.zeros(len(counts), np.int64)
        rng = np.random.default_rng([seed, part])
        tables[seen] = seat(u[seen], counts[seen], parent[seen], times, DISCOUNT, STRENGTH, rng)
        at = 0
        for (_, src, _), n in zip(held, lengths, strict=True):
            mine = inverse[at : at + n]
            at += n
            yield src, PAIRS, part, packed(_small(counts[mine]), _small(tables[mine]))
        as_dish = np.bincount(w, weights=tables, minlength=len(words)).astype(np.int64)
        as_context = np.bincount(u, weights=tables, minlength=len(contexts)).astype(np.int64)
        both = np.union1d(words, contexts)
        dish, restaurant = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
        dish[np.searchsorted(both, words)] = as_dish
        restaurant[np.searchsorted(both, contexts)] = as_context
        held_any = (dish > 0) | (restaurant > 0)
        both, dish, restaurant = both[held_any], dish[held_any], restaurant[held_any]
        owner = both % parts
        for dest in range(parts):
            mine = np.flatnonzero(owner == dest)
            if len(mine):
                yield -1 - dest, TABLES, part, packed(_small(both[mine] // parts), _small(dish[mine]), _small(restaurant[mine]))

    pairs = exchanged(as_messages.unionByName(answers), parts, ask_pairs)
    seated = cut_lineage(exchanged(pairs, parts, seat_contexts), "seated")

    def seat_parent(part: int, held: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        asked = [(src, unpacked(payload)) for kind_, src, payload in held if kind_ == WORDS]
        sent = [unpacked(payload) for kind_, _, payload in held if kind_ == TABLES]
        n = 1 + max([int(ids.max()) // parts for _, (ids, _) in asked if len(ids)] + [int(s[0].max()) for s in sent if len(s[0])], default=0)
        dish, restaurant = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for ranks, dishes, restaurants in sent:
            dish[ranks.astype(np.int64)] += dishes.astype(np.int64)
            restaurant[ranks.astype(np.int64)] += restaurants.astype(np.int64)
        customers = -(-dish // SWEEPS)  # the mean over the kept sweeps, rounded up
        seen = np.flatnonzero(customers)
        tables = np.zeros(n)
        if len(seen):
            rng = np.random.default_rng([seed, part, 1])
            even = np.full(len(seen), 1.0 / (n_words + 1))
            tables[seen] = seat(np.zeros(len(seen), np.int64), customers[seen], even, np.array([parts]), PARENT_DISCOUNT, PARENT_STRENGTH, rng) / SWEEPS
        own = customers - PARENT_DISCOUNT * tables
        for src, (ids, counts) in asked:
            ranks = ids.astype(np.int64) // parts
            yield src, WORDS, part, packed(_small(ids), _small(counts), own[ranks].astype(np.float32), _small(restaurant[ranks]))
        yield -1, WORDS, part, packed(np.array([customers.sum(), tables.sum()], np.float64))

    # answers to blocks say which words each block asked for, in order
    asked = answers.select(F.col("src").alias("dest"), "kind", F.col("dest").alias("src"), "payload")
    sent = seated.where("dest < 0").select((-1 - F.col("dest")).alias("dest"), "kind", "src", "payload")
    parents = cut_lineage(exchanged(asked.unionByName(sent), parts, seat_parent), "parents")
    totals = [unpacked(bytes(r["payload"]))[0] for r in parents.where("dest = -1").select("payload").collect()]  # a row per partition
    parent_customers, parent_tables = float(sum(t[0] for t in totals)), float(sum(t[1] for t in totals))

    def score_block(number: int, held: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        block, ids, counts = of_block(held)
        at = _parts(block.words, parts)
        own, restaurant = np.zeros(len(block.words)), np.zeros(len(block.words))
        for kind_, src, payload in held:
            if kind_ == WORDS:
                _, _, own[at[src]], restaurant[at[src]] = unpacked(payload)
        pairs = _pairs(block, ids)
        dest = _destinations(ids[pairs.contexts], ids[pairs.words], counts[pairs.contexts], parts)
        order = np.argsort(dest, kind="stable")
        cuts = np.searchsorted(dest[order], np.arange(parts + 1))
        customers, tables = np.zeros(len(dest)), np.zeros(len(dest))
        for kind_, src, payload in held:
            if kind_ == PAIRS:
                mine = order[cuts[src] : cuts[src + 1]]
                customers[mine], tables[mine] = unpacked(payload)
        even = 1.0 / (n_words + 1)
        root = (own + (PARENT_STRENGTH + PARENT_DISCOUNT * parent_tables) * even) / (PARENT_STRENGTH + parent_customers)
        u, w = pairs.contexts, pairs.words
        chance = customers - DISCOUNT * tables / SWEEPS + (STRENGTH + DISCOUNT * restaurant[u] / SWEEPS) * root[w]
        model = np.log10(chance / (STRENGTH + counts[u]))[pairs.of_token]
        base = np.log10((counts + 1.0) / (n_train + n_words + 1.0))[block.tokens]
        starts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]])
        known = np.add.reduceat((counts > 0)[block.tokens].astype(np.int64), starts)
        yield number, BLOCK, 0, packed(block.lengths, known, np.add.reduceat(base, starts), np.add.reduceat(model, starts), block.train.astype(np.uint8))

    to_blocks = as_messages.unionByName(parents.where("dest >= 0")).unionByName(seated.where("dest >= 0"))
    scored = exchanged(to_blocks, parts, score_block).select(F.col("dest").alias("block"), F.col("payload").alias("scores"))
    together = cut_lineage(scored, "scores").join(blocks.select("block", "doc_ids"), "block")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, payload in enumerate(batch.column(1).to_pylist()):
                lengths, known, base, model, is_train = unpacked(payload)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, pa.array(is_train == 0), pa.array(lengths), pa.array(known), pa.array(np.full(n, n_train)), pa.array(base), pa.array(model)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return together.select("doc_ids", "scores").mapInArrow(
        rows, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
