"""Vector codes against brute force in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from ensemblage.llm import queries, vectorcodes

VECTORS = "vec_id bigint, embedding array<double>, label int, code string, error string"


def expected(rows, parts=16, entries=64, rounds=2):
    """Contract, row by row: (vec_id, code, error, label_error, digest)."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and r[1] and len(r[1]) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    if not good:
        return []
    width = len(good[0][1]) // parts
    cut = [[[math.floor(256 * x) for x in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in good]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for row in cut:
                own.setdefault(nearest(row[p], p)[1], []).append(row[p])
            books[p] = [[sum(x) // len(own[e]) for x in zip(*own[e], strict=True)] if e in own else entry for e, entry in enumerate(books[p])]
    found = [[nearest(row[p], p) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in row) for row in found]
    totals = {}
    for r, error in zip(good, errors, strict=True):
        totals[r[2]] = totals.get(r[2], 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    most = (1 << 63) - 1
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in row), min(error, most), min(totals[r[2]], most), digest)
                   for r, row, error in zip(good, found, errors, strict=True)), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def invented(n, length, seed, scale=0.2):
    rng = random.Random(seed)
    return [(i * 7 % n, [rng.gauss(0, scale) for _ in range(length)], rng.choice([None, 1, 1, 2]), "c", "e") for i in range(n)]


@pytest.mark.parametrize("rows", [
    invented(300, 32, 1),
    invented(20, 16, 2),  # fewer than entries
    [(i, [float(i % 3)] * 32, 1, "c", "e") for i in range(150)],  # ties, equal entries, repeated vectors
    [(5, [0.5] * 16, None, "c", "e")] * 9 + [(None, [0.25] * 16, 3, "c", "e"), (1, None, 1, "c", "e"), (2, [], 1, "c", "e"), (3, [1.0] * 15, 1, "c", "e"),
     (4, [1.0] * 32, 1, "c", "e"), (6, [None] + [1.0] * 15, 1, "c", "e"), (7, [float("nan")] * 16, 1, "c", "e"), (8, [float("-inf")] * 16, 1, "c", "e")],
    invented(90, 32, 3) + [(500 + i, [1e6 * i, -3e7] * 16, 2, "c", "e") for i in range(20)],  # beyond plain integers
    invented(70, 16, 4) + [(900, [1e30, -1e30] * 8, 9, "c", "e")],  # an error beyond 64 bits
], ids=["plain", "few", "ties", "odd", "large", "huge"])
def test_report_against_brute_force(spark, rows):
    assert collected(vectorcodes.report(spark.createDataFrame(rows, VECTORS))) == expected(rows)


def test_empty(spark):
    table = spark.createDataFrame([], VECTORS)
    assert vectorcodes.report(table).count() == 0
    assert vectorcodes.report(table).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_tree_against_all_entries_and_drops_some():
    rng = np.random.default_rng(5)
    looked = {"n": 0}
    plain = vectorcodes._squares

    def counting(vectors, entry):
        looked["n"] += len(vectors)
        return plain(vectors, entry)

    for spread in (3, 40, 4_000):
        entries = rng.integers(-spread, spread, (64, 4))
        asked = np.concatenate([rng.integers(-spread, spread, (2_000, 4)), entries])
        squares = ((asked[:, None] - entries[None]) ** 2).sum(axis=2)
        tree = vectorcodes.Gnat(entries)
        vectorcodes._squares, looked["n"] = counting, 0
        try:
            found, best = tree.nearest(asked)
        finally:
            vectorcodes._squares = plain
        assert (found == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
        if spread > 3:
            assert looked["n"] < 0.9 * squares.size  # whole subtrees are dropped


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert collected(queries.QUERIES["op13_codes"](spark, folder)) == expected(rows)
