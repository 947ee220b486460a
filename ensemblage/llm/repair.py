"""Repairing the order of speakers in conversations by weighted interval parsing.

A repaired conversation is empty or reads as an optional system turn and then user and assistant in turns:
``(s?(ua)+)?`` over the initials of its roles. A repair keeps (K), re-roles (R) or deletes (D) each row and inserts (I)
empty turns; the cheapest is taken, and of equally cheap ones the one whose letters, in order, are least.

The grammar is in Chomsky normal form. A nonterminal names what a span of rows may become by its first and last
speaker, or that nothing is left of it. ``X Y -> Z`` holds where the last speaker of X may be followed by the first of Y.
A cell keeps the least (cost, letters) per nonterminal of a span, closed under insertions at both ends. Cells of a block
of rows are filled bottom-up by length of span over all splits; blocks are then joined to longer and longer spans. As the
nonterminals are closed under splitting, every split of a span gives the same cell, so joining blocks needs only one.
Equally cheap letters of one cell are never each other's beginning (the rest would be insertions, which cost), so
comparing letters commutes with joining.

Only letters of kinds of rows, one per row, go to Python; long conversations are parsed in blocks and joined in rounds.
The letters of a whole conversation are one value of its row in the result, eight in the last join, as many bytes as it
has rows each. Texts stay with Spark.

Defined results: a null role or text is one space; a null conv_id is a conversation of its own; null turns come first;
rows with equal turns are ordered by role and text; repeated rows are duplicates; a role without a known initial cannot be
kept; texts are only tested and compared, whatever their length; an empty table gives no rows; columns beyond conv_id,
turn, role and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ensemblage.operators.groups import SpreadGroups, TaskGroups, plan_groups
from ensemblage.session import cut_lineage

#: Rows per block; each is parsed over all its spans.
BLOCK = 12
#: Spans joined by one task of a round.
FAN_IN = 64

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

BLANK = r"[\x20\x09-\x0D]"
#: Faults as letters of a row's kind, after the initial of its role.
FINE, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = ".", "b", "d", "t"

Cell = dict[str, tuple[int, str]]

# nonterminals: "" (nothing left) and the first and last speaker of what is left
FOLLOWS = {"su", "ua", "au"}
NONTERMINALS = ["", "ss", "su", "sa", "uu", "ua", "au", "aa"]
START = ["", "ua", "sa"]


def _grammar() -> list[tuple[str, str, str]]:
    rules = [(left, right, left + right) for left in NONTERMINALS for right in NONTERMINALS if not left or not right]
    joins = [(x, y, x[0] + y[1]) for x in NONTERMINALS for y in NONTERMINALS if x and y and x[1] + y[0] in FOLLOWS]
    return rules + joins


RULES = _grammar()
#: What a span without rows may become by insertions.
INSERTED: Cell = {"": (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I"), "ua": (2 * INSERT, "II"), "au": (2 * INSERT, "II")}


def join_cells(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    found: Cell = {}
    for x, y, z in RULES:
        if x in left and y in right:
            (a, p), (b, q) = left[x], right[y]
            best = found.get(z)
            if best is None or a + b < best[0] or (a + b == best[0] and p + q < best[1]):
                found[z] = (a + b, p + q)
    return found


@functools.cache
def row_cell(initial: str, fault: str) -> Cell:
    """The cell of one row: its productions, closed under insertions on both sides."""
    cell: Cell = {"": (DELETE, "D")}
    if fault not in (IS_BLANK, IS_DUPLICATE):
        more = TRUNCATED if fault == IS_TRUNCATED else 0
        for role in "ua":
            cell[2 * role] = (REROLE + more, "R")
        if initial in ("s", "u", "a"):
            cell[2 * initial] = (KEEP + more, "K")
    return join_cells(join_cells(INSERTED, cell), INSERTED)


@functools.lru_cache(100_000)
def parse(kinds: str) -> Cell:
    """The cell of a block, given two letters per row (initial and fault), bottom-up by length of span."""
    n = len(kinds) // 2
    if n == 0:
        return INSERTED
    chart = {(i, i + 1): row_cell(kinds[2 * i], kinds[2 * i + 1]) for i in range(n)}
    for length in range(2, n + 1):
        for start in range(n - length + 1):
            end, best = start + length, {}
            for split in range(start + 1, end):
                for z, found in join_cells(chart[start, split], chart[split, end]).items():
                    if z not in best or found < best[z]:
                        best[z] = found
            chart[start, end] = best
    return chart[0, n]


def _to_lists(cell: Cell) -> tuple[list[int | None], list[str | None]]:
    return [cell[z][0] if z in cell else None for z in NONTERMINALS], [cell[z][1] if z in cell else None for z in NONTERMINALS]


def _to_cell(costs: list[int | None], letters: list[str | None]) -> Cell:
    return {z: (cost, text) for z, cost, text in zip(NONTERMINALS, costs, letters, strict=True) if cost is not None and text is not None}


def _mapped(df: DataFrame, names: list[str], make: Callable[..., Any], added: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """``df`` without the columns ``names``, which ``make`` turns row by row into the columns ``added``."""
    kept = [c for c in df.columns if c not in names]
    schema = pa.schema([(c, to_arrow_type(df.schema[c].dataType)) for c in kept] + [(name, kind) for name, _, kind in added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(len(kept), batch.num_columns)), strict=True)]
            columns = list(zip(*made, strict=True)) or [[] for _ in added]
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(c, kind) for c, (_, _, kind) in zip(columns, added, strict=True)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"{name} {kind}" for name, kind, _ in added]
    return df.select(*kept, *names).mapInArrow(work, ", ".join(kinds))


CELLS = [("costs", "array<int>", pa.list_(pa.int32())), ("letters", "array<string>", pa.list_(pa.string()))]


def _flag_repeats(df: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
    """``repeated``: whether role and text were seen earlier in the conversation."""
    same = ["conv_id", "role", "_digest"]
    if isinstance(groups, TaskGroups):
        first = F.min("pos").over(Window.partitionBy(*same))
        return df.withColumn("repeated", F.col("pos") > first)
    firsts = df.groupBy(*same).agg(F.min("pos").alias("_first"))
    renamed = firsts.select(*[F.col(c).alias(f"_of{c}") for c in same], "_first")
    match = [df[c].eqNullSafe(renamed[f"_of{c}"]) for c in same]
    return df.join(renamed, match).withColumn("repeated", F.col("pos") > F.col("_first")).drop("_first", *[f"_of{c}" for c in same])


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), block, turn, role, text, initial, fault, new_turn, illegal of each row, stored.

    ``new_turn``: its turn differs from the row's before; ``illegal``: its speaker can't follow the one before.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"_digest": F.sha2("text", 256), "initial": F.substring("role", 1, 1)})
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    plan = plan_groups(rows.select("conv_id"), ("conv_id",))

    def number(df: DataFrame, groups: TaskGroups | SpreadGroups) -> DataFrame:
        df = groups.ordinal(df, "pos", order).withColumn("pos", F.col("pos").cast("long") - 1)
        if isinstance(groups, SpreadGroups):
            df = cut_lineage(df, "numbered")
        df = groups.previous(df, "_before", F.struct("initial", "turn"), [F.col("pos")])
        return _flag_repeats(df, groups)

    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(rf"[.!?]{BLANK}*\z")
    fault = F.when(blank, IS_BLANK).when(F.col("repeated"), IS_DUPLICATE).when(~whole, IS_TRUNCATED).otherwise(FINE)
    pair = F.concat("_before.initial", "initial")
    return cut_lineage(plan.apply(rows, number).select(
        "conv_id", "pos", F.floor(F.col("pos") / BLOCK).cast("long").alias("block"), "turn", "role", "text", "initial", fault.alias("fault"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_before.turn"))).alias("new_turn"),
        (F.col("_before").isNotNull() & ~pair.isin(*FOLLOWS)).alias("illegal"),
    ), "numbered")


def _known(initial: Column) -> Column:
    return F.when(initial.isin("s", "u", "a"), initial).otherwise("-")


def parsed(rows: DataFrame) -> DataFrame:
    """Per conversation: its counts of faults, cost, audit and opens (what the repaired one starts with), from ``numbered`` rows."""
    counts = {
        "blank": F.sum((F.col("fault") == IS_BLANK).cast("long")), "duplicate": F.sum((F.col("fault") == IS_DUPLICATE).cast("long")),
        "truncated": F.sum((F.col("fault") == IS_TRUNCATED).cast("long")), "illegal": F.sum(F.col("illegal").cast("long")),
        "turns": F.sum(F.col("new_turn").cast("long")), "least": F.min("turn"), "most": F.max("turn"),
    }
    kinds = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat(_known(F.col("initial")), "fault").alias("kind")))),
                                     lambda x: x["kind"]), "")
    blocks = rows.groupBy("conv_id", "block").agg(kinds.alias("kinds"), *[c.alias(n) for n, c in counts.items()])
    spans = cut_lineage(_mapped(blocks, ["kinds"], lambda kinds: _to_lists(parse(kinds)), CELLS), "spans")

    def joined(costs: list[list[int | None]], letters: list[list[str | None]]) -> tuple[list[int | None], list[str | None]]:
        cells = [_to_cell(c, t) for c, t in zip(costs, letters, strict=True)]
        while len(cells) > 1:  # spans of doubled length
            pairs = [cells[i : i + 2] for i in range(0, len(cells), 2)]
            cells = [functools.reduce(join_cells, pair) for pair in pairs]
        return _to_lists(cells[0])

    left = spans.agg(F.max("block")).first()[0] or 0
    while left > 0:
        left //= FAN_IN
        cells = F.array_sort(F.collect_list(F.struct("block", "costs", "letters")))
        totals = [F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "turns")] + [F.min("least").alias("least"), F.max("most").alias("most")]
        grouped = spans.groupBy("conv_id", F.floor(F.col("block") / FAN_IN).cast("long").alias("_block")).agg(cells.alias("cells"), *totals)
        grouped = grouped.withColumnRenamed("_block", "block").withColumns({"costs": F.col("cells.costs"), "letters": F.col("cells.letters")}).drop("cells")
        spans = cut_lineage(_mapped(grouped, ["costs", "letters"], joined, CELLS), "spans", replaces=spans)

    ends = [F.when(F.get("costs", F.lit(NONTERMINALS.index(z))).isNotNull(), F.struct(
        F.get("costs", F.lit(NONTERMINALS.index(z))).cast("long").alias("cost"), F.get("letters", F.lit(NONTERMINALS.index(z))).alias("audit"),
        F.lit(z[:1]).alias("opens"))) for z in START]
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return spans.withColumn("_best", F.array_min(F.array(*ends))).select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "_best.cost", "_best.audit", "_best.opens")


def _part_audit(audit: str, opens: str) -> list[tuple[int, str, int]]:
    """Block, its letters and how many rows come out before it; insertions after the last row go with its block."""
    parts: list[tuple[int, str, int]] = []
    out = start = at = rows = 0
    for letter in audit:
        at += 1
        rows += letter != "I"
        if letter != "I" and rows % BLOCK == 0:
            parts.append((len(parts), audit[start:at], out))
            out += at - start - audit.count("D", start, at)
            start = at
    if start < at:
        if rows % BLOCK == 0 and parts:
            block, letters, before = parts.pop()
            parts.append((block, letters + audit[start:], before))
        else:
            parts.append((len(parts), audit[start:], out))
    return parts


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, seq (from 0), edit (K, R or I), turn, role, text of the repaired conversations.

    Texts are dealt by conversation and block, so a long conversation is spread. A deleted row gives none.
    """
    kind = pa.list_(pa.struct([("block", pa.int64()), ("letters", pa.string()), ("before", pa.int64())]))
    parts = _mapped(
        found.select("conv_id", "audit", "opens"), ["audit", "opens"],
        lambda audit, opens: ([dict(zip(("block", "letters", "before"), p, strict=True)) for p in _part_audit(audit, opens)], opens),
        [("parts", "array<struct<block:bigint,letters:string,before:bigint>>", kind), ("opens", "string", pa.string())],
    )
    parts = parts.select(F.col("conv_id").alias("_conv"), "opens", F.explode("parts").alias("part"))
    parts = parts.select("_conv", "opens", F.col("part.block").alias("_block"), F.col("part.letters").alias("letters"), F.col("part.before").alias("before"))
    joined = rows.join(parts, rows["conv_id"].eqNullSafe(parts["_conv"]) & (rows["block"] == parts["_block"]))
    steps = joined.withColumn("steps", F.regexp_extract_all("letters", F.lit("(I*[DKR](?:I+$)?)"), F.lit(1)))
    at = (F.col("pos") % BLOCK).cast("int")
    steps = steps.withColumns({
        "step": F.get("steps", at),
        "first": F.col("before") + F.length(F.replace(F.array_join(F.slice("steps", 1, at), ""), F.lit("D"), F.lit("")))})
    # letters of a step in order, deletions apart
    out = steps.withColumn("edits", F.split(F.replace("step", F.lit("D"), F.lit("")), "")).where(~F.col("step").isin("D"))
    out = out.select("conv_id", "turn", "role", "text", "opens", "first", F.posexplode("edits").alias("_n", "edit")).where(F.col("edit") != "")
    seq = F.col("first") + F.col("_n")
    speaker = F.when((seq + F.when(F.col("opens") == "s", 1).otherwise(0)) % 2 == 0, "user").otherwise("assistant")
    own = F.col("edit") == "K"
    return out.select(
        "conv_id", seq.alias("seq"), "edit", F.when(F.col("edit") != "I", F.col("turn")).alias("turn"),
        F.when(own, F.col("role")).otherwise(speaker).alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def digests(repaired_rows: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: the digest of ``role:text`` of all rows, joined by line feeds.

    A digest is made in order, so the rows of a conversation pass through one task, one at a time.
    """
    kind = repaired_rows.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("repaired_sha256", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple[Any, str]]:
            for conv_id, rows in itertools.groupby(stream(batches), key=lambda row: row[0]):
                digest = hashlib.sha256()
                for number, (_, role, text) in enumerate(rows):
                    digest.update(b"\n" * (number > 0) + role + b":" + text)
                yield conv_id, digest.hexdigest()

        made = results()
        while some := list(itertools.islice(made, 1_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    sorted_rows = repaired_rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return sorted_rows.select("conv_id", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text")).mapInArrow(
        work, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a repair test: each is dropped, emptied, robbed of its ends of sentences, repeated or given to the
    user, or left alone, as the CRC-32 of ``conv_id:turn`` says."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), fate.alias("_fate"))
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_fate") == 3, 2).otherwise(1)
    return rows.where("_fate <> 0").select(
        "conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def report(conversations: DataFrame, originals: DataFrame) -> DataFrame:
    """One row per conv_id of ``originals``: faults, cost and audit of the repair, and the digest of what it gives."""
    rows = numbered(conversations)
    found = cut_lineage(parsed(rows), "parsed")
    sums = digests(repaired(rows, found))
    table = found.drop("opens").withColumnRenamed("conv_id", "_found").join(
        sums.withColumnRenamed("conv_id", "_summed"), F.col("_found").eqNullSafe(F.col("_summed")), "left").drop("_summed")
    ids = originals.select("conv_id").distinct()
    none = F.lit(hashlib.sha256(b"").hexdigest())
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(table, F.col("conv_id").eqNullSafe(F.col("_found")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
