"""Short codes of vectors: each part of a vector by the number of its nearest entry, found through a GNAT.

Components become integers (256 times, rounded down) and vectors are cut into equal parts. Each part has a codebook,
which starts from the vectors with the smallest ids and is refitted in rounds to the means of the parts nearest to each
entry. A tree over the entries of a codebook (geometric near-neighbour access tree) finds the nearest: a node holds split
points far from each other and deals the rest to the nearest one; for each split point and each other child it stores
the range of distances from the point to the child's entries. A query that is at distance d from a split point and knows
an entry within r drops a child only if its range lies strictly outside [d - r, d + r], with ranges rounded outwards and
radii upwards; what is left is compared by exact integers, ties going to the lower number.

Codebooks have a fixed size and are broadcast. Sums for the next round are made in each task, one row per entry, and
added by Spark; only the means of all entries come to the driver.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped, and so are those whose
length isn't that of the vector with the smallest id or isn't a multiple of the number of parts; with fewer vectors than
entries there are as many entries as vectors; rows with equal ids are ordered by their components, null ids come last;
repeated rows count each time; entries may be equal (the lower number wins); components of any size are exact (beyond
2**27 by Python's integers), but an error beyond a 64-bit integer is given as the largest; an empty table gives no rows;
columns other than the three named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ensemblage.llm.common import small
from ensemblage.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a node, and entries that a leaf may have.
SPLITS, LEAF = 6, 6
#: Components up to this size have distances that fit 64-bit integers.
PLAIN = 1 << 27
LARGEST = (1 << 63) - 1
#: Vectors looked up at once.
AT_ONCE = 4_096


def _squares(vectors: np.ndarray, entry: np.ndarray) -> np.ndarray:
    gap = vectors - entry
    return (gap * gap).sum(axis=1)


def _root_up(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(float)) * (1 + 1e-12), np.inf)


def _root_down(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(float)) * (1 - 1e-12), -np.inf)


class Gnat:
    """Nearest entries of many queries at once; ``entries`` is a matrix of integers."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None) -> None:
        self.entries = entries
        self.numbers = np.arange(len(entries)) if numbers is None else numbers
        self.children: list[Gnat] = []
        self.splits: list[int] = []
        if len(self.numbers) > LEAF:
            self._divide()

    def _divide(self) -> None:
        own = self.entries[self.numbers]
        gaps = _squares(own, own[0])
        columns = [gaps]
        chosen = [0]
        while len(chosen) < SPLITS and (far := int(np.argmax(gaps))) not in chosen:  # each split point far from those before
            chosen.append(far)
            columns.append(_squares(own, own[far]))
            gaps = np.minimum(gaps, columns[-1])
        squares = np.stack(columns, axis=1)
        nearest = np.argmin(squares, axis=1)
        nearest[chosen] = np.arange(len(chosen))
        if len(chosen) == 1:
            return  # equal entries: a leaf
        self.splits = [int(self.numbers[c]) for c in chosen]
        #: per split point and child: the least and largest distance to the child's entries, its split point among them
        self.low, self.high = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(chosen)))
        for child in range(len(chosen)):
            members = squares[nearest == child]
            self.low[:, child], self.high[:, child] = _root_down(members.min(axis=0)), _root_up(members.max(axis=0))
            rest = np.setdiff1d(np.flatnonzero(nearest == child), [chosen[child]])
            self.children.append(Gnat(self.entries, self.numbers[rest]))

    def _offer(self, number: int, squares: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        better = (squares < best[rows]) | ((squares == best[rows]) & (number < found[rows]))
        best[rows[better]], found[rows[better]] = squares[better], number

    def _visit(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        if not self.children:
            for number in self.numbers:
                self._offer(int(number), _squares(queries[rows], self.entries[number]), rows, best, found)
            return
        alive = np.ones((len(rows), len(self.splits)), bool)
        for split, number in enumerate(self.splits):
            here = np.flatnonzero(alive[:, split])
            if not len(here):
                continue
            squares = _squares(queries[rows[here]], self.entries[number])
            self._offer(number, squares, rows[here], best, found)
            radius = _root_up(best[rows[here]])
            outside = (_root_down(squares) - radius)[:, None] > self.high[split]
            outside |= (_root_up(squares) + radius)[:, None] < self.low[split]
            alive[here] &= ~outside
        for child, node in enumerate(self.children):
            here = rows[alive[:, child]]
            if len(here) and len(node.numbers):
                node._visit(queries, here, best, found)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and its squared distance, for each query."""
        found = np.zeros(len(queries), np.int64)
        best = _squares(queries, self.entries[0])
        self._visit(queries, np.arange(len(queries)), best, found)
        return found, best


def usable(vectors: DataFrame, vector: str, vec_id: str, label: str | None, parts: int) -> DataFrame:
    """vec_id, label, vector of the rows that can be coded."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    limit = F.lit(float("inf"))
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)))
    rows = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector")).first()
    return rows.where(F.size("vector") == first[0]) if first else rows


def _integers(column: pa.Array, length: int) -> np.ndarray:
    """The components, scaled and rounded down, as a matrix of integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    scaled = np.floor(flat * SCALE)
    if len(scaled) == 0 or np.abs(scaled).max() <= PLAIN:
        return scaled.astype(np.int64)
    exact = [[int(SCALE) * int(x) if abs(x) > 1 << 53 else int(np.floor(SCALE * x)) for x in row] for row in flat.tolist()]
    return np.array(exact, dtype=object)


class Codebooks:
    """``books``: a matrix of entries per part, in Python's integers. Trees are made where they are used."""

    def __init__(self, books: list[list[list[int]]]) -> None:
        self.books = books

    def matrices(self) -> list[np.ndarray]:
        plain = all(abs(x) <= PLAIN for book in self.books for entry in book for x in entry)
        return [np.array(book, dtype=np.int64 if plain else object) for book in self.books]

    def trees(self) -> list[Gnat]:
        return [Gnat(matrix) for matrix in self.matrices()]

    def sha256(self) -> str:
        shown = ",".join(str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(shown.encode()).hexdigest()


def _lookups(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of batches with their integers, codes and squared distances by row and part."""
    trees = books.trees()
    width = len(books.books[0][0])
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            some = batch.slice(at, AT_ONCE)
            values = _integers(some.column(some.num_columns - 1), width * len(trees))
            sought = [tree.nearest(values[:, p * width : (p + 1) * width].astype(object if tree.entries.dtype == object else values.dtype))
                      for p, tree in enumerate(trees)]
            yield some, values, np.stack([s[0] for s in sought], axis=1), np.stack([s[1] for s in sought], axis=1)


def first_books(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()  # bounded: entries rows
    if not first:
        return None
    length = len(first[0]["vector"])
    matrix = _integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), length)
    width = length // parts
    return Codebooks([[[int(x) for x in row[p * width : (p + 1) * width]] for row in matrix] for p in range(parts)])


def refitted(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the means, rounded down, of the parts nearest to them."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    width, n_parts, n_entries = len(books.books[0][0]), len(books.books), len(books.books[0])
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list[int]] = {}
        for _, values, codes, _ in _lookups(batches, shared.value):
            for p in range(n_parts):
                part = values[:, p * width : (p + 1) * width]
                for entry in np.unique(codes[:, p]):
                    mine = part[codes[:, p] == entry]
                    total = totals.setdefault((p, int(entry)), [0] * (width + 1))
                    for place, x in enumerate([*mine.sum(axis=0), len(mine)]):
                        total[place] += int(x)
        from decimal import Decimal

        found = [(p, e, place, Decimal(total[place]), total[width]) for (p, e), total in totals.items() for place in range(width)]
        columns = list(zip(*found, strict=True)) or [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    sums = rows.select("vector").mapInArrow(add, "part int, entry int, place int, total decimal(38,0), n bigint")
    means = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    new = [[list(entry) for entry in book] for book in books.books]
    for r in means.collect():  # bounded: one row per component of the codebooks
        new[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    assert len(new[0]) == n_entries
    return Codebooks(new)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``usable`` rows; None if there are none."""
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = refitted(rows, books)
    return books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (binary, one byte per part), error."""
    if len(books.books[0]) > 256:
        raise ValueError("a code has one byte per part")
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kinds = [rows.schema[c].dataType for c in ("vec_id", "label")]
    schema = pa.schema([("vec_id", to_arrow_type(kinds[0])), ("label", to_arrow_type(kinds[1])), ("code", pa.binary()), ("error", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, codes, squares in _lookups(batches, shared.value):
            codes_bytes = [row.tobytes() for row in codes.astype(np.uint8)]
            errors = [min(int(x), LARGEST) for x in squares.sum(axis=1)]
            arrays: list[Any] = [some.column(i).cast(schema.field(i).type) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(codes_bytes, pa.binary()), pa.array(errors, pa.int64())], schema=schema)

    return rows.select("vec_id", "label", "vector").mapInArrow(
        work, f"vec_id {kinds[0].simpleString()}, label {kinds[1].simpleString()}, code binary, error bigint")


def report(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of all vectors that can be coded.

    A label may hold many rows: its errors are added before they are shuffled, and joined back from one row per label.
    """
    rows = usable(vectors, vector, vec_id, label, PARTS)
    books = fit(rows)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")],
                           F.lit("").alias("codebooks_sha256"))
    found = cut_lineage(coded(rows, books), "codes")
    sums = cut_lineage(found.groupBy(F.col("label").alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("long").alias("label_error")), "label_errors")
    return found.join(small(sums), F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
