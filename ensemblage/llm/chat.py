"""Conversations rendered by a compiled template, with the spans to train on, and read back.

Rows are dealt by conversation and sorted by turn inside each task; rendering and reading go turn by turn, so a
task holds one turn at a time however long a conversation is.

Defined results: a null role or text is empty; a null conv_id is a conversation of its own; null turns come
first; rows with equal turns are ordered by role and text and all kept; an empty table gives no rows; columns
beyond conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from ensemblage.llm.template import compile_template, unescape

START, END = "<|im_start|>", "<|im_end|>"
CHAT_TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' ~ (m.role | escape_line) ~ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)
#: Characters of a turn's output per row; longer ones go on in the next row.
PIECE = 1 << 20


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batched(rows: Iterator[tuple[Any, ...]], schema: pa.Schema, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def format_conversations(conversations: DataFrame, template: str = CHAT_TEMPLATE) -> DataFrame:
    """conv_id, part, text, marked: the parts of a conversation in order, joined, are its output.

    A part is either wholly between generation markers or outside them. Rows of a conversation follow each
    other within a partition, in order of part.
    """
    compile_template(template)  # mistakes show here, not in a task
    kind = conversations.schema["conv_id"].dataType

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compile_template(template)

        def parts() -> Iterator[tuple[Any, ...]]:
            for conv_id, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
                messages = ({"role": role or "", "text": text or ""} for _, _, role, text in rows)
                number = 0
                for marked, run in itertools.groupby(write({"messages": messages}), key=lambda piece: piece[1]):
                    for text, _ in run:
                        for at in range(0, len(text), PIECE):
                            yield conv_id, number, text[at : at + PIECE], marked
                            number += 1

        yield from _batched(parts(), out)

    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema([("conv_id", to_arrow_type(kind)), ("part", pa.int64()), ("text", pa.string()), ("marked", pa.bool_())])
    return (
        conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(render, f"conv_id {kind.simpleString()}, part bigint, text string, marked boolean")
    )


class _Turns:
    """Reads turns from output that arrives in parts, and digests them."""

    def __init__(self) -> None:
        self.rest = ""
        self.n_turns = self.n_chars = self.n_marked = 0
        self.turns, self.marked = hashlib.sha256(), hashlib.sha256()
        self.open = ""

    def add(self, text: str, marked: bool) -> None:
        self.n_chars += len(text)
        if self.open and not marked:
            self.take_marked()
        if marked:
            self.open += text
        self.rest += text
        while (end := self.rest.find(END + "\n")) >= 0:
            role, _, said = self.rest[len(START) : end].partition("\n")
            self.turns.update(f"{unescape(role)}\n{unescape(said)}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
            self.rest = self.rest[end + len(END) + 1 :]

    def take_marked(self) -> None:
        text = unescape(self.open)
        self.n_marked += len(text)
        self.marked.update(text.encode("utf-8", "surrogatepass"))
        self.open = ""

    def result(self) -> tuple[Any, ...]:
        self.take_marked()
        if self.rest:
            raise ValueError("the output ends within a turn")
        return self.n_turns, self.turns.hexdigest(), self.n_marked, self.marked.hexdigest(), self.n_chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from the output of ``format_conversations`` alone."""
    kind = formatted.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema([
        ("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple[Any, ...]]:
            for conv_id, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
                turns = _Turns()
                for _, _, text, marked in rows:
                    turns.add(text, marked)
                yield conv_id, *turns.result()

        yield from _batched(conversations(), out)

    return formatted.mapInArrow(
        read, f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
