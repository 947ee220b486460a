"""Packing pieces into sequences by minimum bin slack.

How full a sequence gets depends on lengths alone, and there are at most ``capacity`` different ones. So the
pieces are counted by length on Spark, and the plan is made from that histogram of at most ``capacity`` cells,
whatever the number of documents. For each sequence the longest length left is taken and a bitset
subset-sum over the lengths that are left finds the fullest combination with it; that combination is removed
as often as the counts allow. Its size in the plan doesn't grow with the number of pieces. On Spark each piece
is then numbered within its length, and the plan says in which sequence and where the k-th piece of a length goes.

Defined results: lengths above ``capacity`` or below 1 raise an error; repeated rows are pieces of their own;
an empty table gives no rows; other columns stay, but for seq, sequence_id and offset, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ensemblage.llm.common import ordinal


@dataclass(frozen=True)
class Pattern:
    """Sequences ``first`` to ``first + times - 1`` all hold ``items``: pairs of a length and how often it occurs."""

    first: int
    times: int
    items: tuple[tuple[int, int], ...]


def _fullest(room: int, lengths: list[int], left: dict[int, int]) -> list[tuple[int, int]]:
    """The pieces whose lengths sum to the most within ``room``; long lengths are tried first.

    Bit s of a set says that s can be reached. A length that occurs n times is added in lots of 1, 2, 4, ...
    and the rest, whose sums reach every number of copies up to n.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # the set before the lot, length, copies
    for length in lengths:
        if length > room:
            continue
        copies = min(left[length], room // length)
        lot = 1
        while copies and not reach >> room & 1:
            lot = min(lot, copies)
            wider = (reach | reach << (lot * length)) & mask
            if wider != reach:
                steps.append((reach, length, lot))
                reach = wider
            copies -= lot
            lot *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, lot in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + lot
            total -= lot * length
    return sorted(taken.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold all pieces of a histogram of lengths."""
    left = {length: count for length, count in counts.items() if count}
    if left and (min(left) < 1 or max(left) > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    patterns: list[Pattern] = []
    first = 0
    while left:
        lengths = sorted(left, reverse=True)
        longest = lengths[0]
        left[longest] -= 1
        chosen = dict(_fullest(capacity - longest, [x for x in lengths if left[x]], left))
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // copies for length, copies in chosen.items())
        patterns.append(Pattern(first, times, tuple(sorted(chosen.items(), reverse=True))))
        first += times
        for length, copies in chosen.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]
    return patterns


def _runs(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: from which ordinal on a pattern takes its pieces, copies per sequence, first sequence, offset."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    for pattern in patterns:
        offset = 0
        for length, copies in pattern.items:
            start = used.get(length, 0)
            rows.setdefault(length, []).append((start, copies, pattern.first, offset))
            used[length] = start + copies * pattern.times
            offset += copies * length
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*found, strict=True)) for length, found in rows.items()}


def pack(pieces: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces`` with a column ``length``; at most ``capacity`` per sequence."""
    pieces = pieces.drop("seq", "sequence_id", "offset")
    # at most ``capacity`` rows
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = _runs(plan(counts, capacity))
    numbered = ordinal(pieces, "seq", ["length"], [*order])
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(names.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(len(names)).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                starts, copies, first, base = runs[int(length)]
                run = np.searchsorted(starts, ranks[at], side="right") - 1
                inside = ranks[at] - starts[run]
                sequence[at] = first[run] + inside // copies[run]
                offset[at] = base[run] + inside % copies[run] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.select(*names, "seq").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
