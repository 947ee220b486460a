"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. The automaton is built over the
words of all items and read-only afterwards; a document's words are streamed through it while the length of the
longest suffix that occurs in an item is tracked. A window is ``window`` consecutive words of an item, or a
whole shorter item. Words inside any occurrence of a window are hit; hit words next to each other are a span.

Documents are never shuffled: only the automata travel. Items are dealt to automata of at most ``MOST_WORDS``
words each, so one automaton has a bounded size; a document passes through one after the other.

Defined results: a null text or item has no words; empty items never occur; repeated items each count; repeated
documents each get their row; empty tables give no rows or no hits; columns that aren't named are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ensemblage.llm.common import DOCUMENT_COLUMNS, plain_words

WINDOW = 10
#: Item words per automaton; each becomes at most two states.
MOST_WORDS = 400_000
#: A document of which more than this share of its words is hit is dropped, not only relieved of the spans.
COVERAGE_LIMIT = 0.5


@dataclass
class Automaton:
    """Suffix automaton of several word sequences.

    ``ends[s]`` lists, longest first, the windows that are suffixes of state s's strings, with their items.
    """

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    moves: list[dict[int, int]] = field(default_factory=lambda: [{}])
    links: list[int] = field(default_factory=lambda: [-1])
    lengths: list[int] = field(default_factory=lambda: [0])
    ends: list[tuple[tuple[int, frozenset[str]], ...]] = field(default_factory=list)
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    shortest: int = 1 << 60  # words of the shortest window

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.moves.append(moves)
        self.links.append(link)
        self.lengths.append(length)
        return len(self.moves) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A state for the strings of ``child`` that are no longer than its parent's and the word."""
        copy = self._state(self.lengths[parent] + 1, dict(self.moves[child]), self.links[child])
        self.links[child] = copy
        while parent >= 0 and self.moves[parent].get(word) == child:
            self.moves[parent][word] = copy
            parent = self.links[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        child = self.moves[last].get(word)
        if child is not None:  # an earlier item goes on the same way
            return child if self.lengths[child] == self.lengths[last] + 1 else self._split(last, word, child)
        new = self._state(self.lengths[last] + 1, {}, 0)
        while last >= 0 and word not in self.moves[last]:
            self.moves[last][word] = new
            last = self.links[last]
        if last >= 0:
            child = self.moves[last][word]
            self.links[new] = child if self.lengths[child] == self.lengths[last] + 1 else self._split(last, word, child)
        return new

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> Automaton:
        made = cls(window)
        coded = [(name, [made.vocabulary.setdefault(w, len(made.vocabulary)) for w in words]) for name, words in items]
        for _, words in coded:
            last = 0
            for word in words:
                last = made._extend(last, word)
        found: list[dict[int, set[str]]] = [{} for _ in made.moves]
        for name, words in coded:
            state, length = 0, 0
            for at, word in enumerate(words):
                state, length = made.step(state, length, word)
                size = min(window, len(words))
                if at + 1 >= size:
                    holder = state
                    while made.lengths[made.links[holder]] >= size:
                        holder = made.links[holder]
                    found[holder].setdefault(size, set()).add(name)
        # windows of a state's suffixes: its own and those of its link, shorter states first
        made.ends = [()] * len(made.moves)
        for state in sorted(range(1, len(made.moves)), key=made.lengths.__getitem__):
            own = tuple((size, frozenset(names)) for size, names in sorted(found[state].items(), reverse=True))
            made.ends[state] = own + made.ends[made.links[state]]
        made.shortest = min((min(window, len(words)) for _, words in coded if words), default=made.shortest)
        made.pairs = np.unique(np.array([a * len(made.vocabulary) + b for _, words in coded for a, b in zip(words, words[1:], strict=False)], np.int64))
        return made

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The state and the length of the longest suffix that occurs, after one more word (-1: unknown)."""
        while state and word not in self.moves[state]:
            state = self.links[state]
            length = self.lengths[state]
        following = self.moves[state].get(word)
        return (0, 0) if following is None else (following, length + 1)

    def _stretches(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where a window can be at all: stretches in which each word, and each pair of neighbours, is one of an item's."""
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            pairs = codes[start : end - 1] * len(self.vocabulary) + codes[start + 1 : end]
            place = np.minimum(np.searchsorted(self.pairs, pairs), max(len(self.pairs) - 1, 0))
            broken = np.flatnonzero(self.pairs[place] != pairs) + 1 if len(self.pairs) else np.arange(1, end - start)
            cuts = [0, *broken.tolist(), end - start]
            for a, b in itertools.pairwise(cuts):
                if b - a >= self.shortest:
                    yield start + a, start + b

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Windows that occur, as (first word, word after the last) in order of their end, and the items they are from."""
        codes = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for start, end in self._stretches(codes):
            state = length = 0
            for i in range(start, end):
                state, length = self.step(state, length, int(codes[i]))
                longest = 0
                for size, names in self.ends[state]:
                    if size <= length:
                        items |= names
                        longest = max(longest, size)
                if longest:
                    spans.append((i + 1 - longest, i + 1))
        return spans, items


def automata(items: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS, name: str = "item_id") -> list[Automaton]:
    """Automata of all items. Items are read group by group; ``name`` is shown as a string."""
    made, group, size = [], [], 0
    for row in items.select(F.col(name).cast("string").alias("name"), "text").toLocalIterator():
        words = plain_words(row["text"])
        if words:
            group.append((row["name"] or "", words))
            size += len(words)
        if size >= most_words:
            made.append(Automaton.of(group, window))
            group, size = [], 0
    return [*made, Automaton.of(group, window)] if group or not made else made


def hit_words(words: list[bytes], found: list[Automaton]) -> tuple[list[tuple[int, int]], set[str]]:
    """Spans of hit words, joined where they touch, and the items with windows there."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    for automaton in found:
        more, names = automaton.matches(words)
        spans += more
        items |= names
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined, items


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def without_spans(text: str, found: list[Automaton], coverage_limit: float) -> str | None:
    """The text without its hit words, or None where more than ``coverage_limit`` of its words are hit.

    What is left may join to a new occurrence, so it is looked at again until there is none.
    """
    total, hit = len(plain_words(text)), 0
    while True:
        spans, _ = hit_words(plain_words(text), found)
        if not spans:
            return text
        hit += sum(end - start for start, end in spans)
        if hit > coverage_limit * total:
            return None
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        kept, at = [], 0
        for start, end in spans:
            kept.append(text[at : places[start][0]])
            at = places[end - 1][1]
        text = "".join([*kept, text[at:]])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans (array of first word and word after the last), items (sorted names)."""
    shared = docs.sparkSession.sparkContext.broadcast(automata(items, window))  # bounded: see MOST_WORDS
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, n_hit bigint, spans array<array<bigint>>, items array<string>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            n_words, n_hit, all_spans, all_items = [], [], [], []
            for text in batch.column(1):
                words = plain_words(text.as_py())
                spans, items_hit = hit_words(words, found)
                n_words.append(len(words))
                n_hit.append(sum(end - start for start, end in spans))
                all_spans.append([list(span) for span in spans])
                all_items.append(sorted(items_hit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(all_spans, pa.list_(pa.list_(pa.int64()))), pa.array(all_items, pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "spans", "items"],
            )

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage_limit: float = COVERAGE_LIMIT) -> DataFrame:
    """The documents without the passages of items; those over the coverage limit are gone. n_chars is counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(automata(items, window))  # bounded: see MOST_WORDS
    docs = docs.select(*DOCUMENT_COLUMNS)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        at = docs_columns.index("text")
        for batch in batches:
            texts = [None if t is None else without_spans(t, found, coverage_limit) for t in batch.column(at).to_pylist()]
            keep = pa.array([new is not None or not old.is_valid for new, old in zip(texts, batch.column(at), strict=True)], pa.bool_())
            changed = batch.set_column(at, "text", pa.array(texts, pa.string()))
            yield changed.filter(keep)

    docs_columns = docs.columns
    cleaned = docs.mapInArrow(clean, docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
