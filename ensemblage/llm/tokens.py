"""Encoding documents with a given word tokenizer, by whole words kept in a bounded memory.

The tokenizer encodes words, digits and runs of marks apart from each other, in lower case. A text of Latin
letters, digits and marks is cut into these pieces here, and a piece is encoded once per worker as long as it is
remembered. Of other texts the parts between spaces and line feeds, across which the tokenizer never joins
characters, are treated so, or given to the tokenizer as they are. ``path`` is a parameter; by default the file comes from the installed
``public_tokenizers``. Tests compare with the tokenizer on whole texts.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces a worker remembers before it starts anew; more only saves time.
REMEMBERED = 1_000_000
#: Parts handed to the tokenizer at once; its results take far more memory than ids.
AT_ONCE = 1_000
END_ID = 0

#: Characters for which lower case, normal form and classes are beyond doubt.
_PLAIN = re.compile("[ \n!-~\u00a1-\u024f]*")
_LETTERS, _NUMBERS = ("".join(regex.findall(kind, "".join(map(chr, range(0xA1, 0x250))))) for kind in (r"\p{L}", r"\p{N}"))
#: How the tokenizer's file parts a text, for these characters: words, single digits, endings, runs of other marks.
_PIECES = re.compile(f"[a-z{_LETTERS}]+|[0-9{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9{_LETTERS}{_NUMBERS}]+")
#: Byte-level vocabularies write printable bytes as themselves and the others, in order, as characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {byte: chr(256 + n) for n, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """ids of a text as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pieces: dict[str, bytes] = {}

    def _directly(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), AT_ONCE):
            for encoded in self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False):
                yield array("I", encoded.ids).tobytes()

    def _add_pieces(self, pieces: list[str]) -> None:
        """Encode pieces by the tokenizer's model alone; it takes their bytes as characters."""
        tokenize = self.tokenizer.model.tokenize
        for piece in pieces:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTES)
            self.pieces[piece] = array("I", [token.id for token in tokenize(shown)]).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; pieces seen for the first time are encoded together."""
        if len(self.pieces) > REMEMBERED:
            self.pieces = {}
        parted: list[list[str]] = []
        odd: set[str] = set()
        for text in texts:
            low = text.lower()
            if _PLAIN.fullmatch(low) and (text.isascii() or _PLAIN.fullmatch(text)):
                parted.append(_PIECES.findall(low))
                continue
            pieces: list[str] = []
            for part in text.replace("\n", " ").split(" "):
                low = part.lower()
                if _PLAIN.fullmatch(part) and _PLAIN.fullmatch(low):
                    pieces += _PIECES.findall(low)
                else:
                    odd.add(part)
                    pieces.append(part)
            parted.append(pieces)
        new = set(itertools.chain.from_iterable(parted)).difference(self.pieces)
        self._add_pieces(list(new - odd))
        odd &= new
        self.pieces.update(zip(odd, self._directly(list(odd)), strict=True))
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in parted]


def _groups(texts: list[str | None], most: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of limited size together, so that memory doesn't depend on how texts are batched."""
    run: list[str] = []
    size = 0
    for text in texts:
        run.append(text or "")
        size += len(run[-1])
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and n_tokens of each document: its ids and one end id. A null text is empty."""
    path = path or default_path()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            lengths = [len(ids) // 4 + 1 for run in _groups(batch.column(1).to_pylist()) for ids in encoder.encode_all(run)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint")


def encoded_pieces(docs: DataFrame, longest: int, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids (binary): each document's ids and its end id, cut where ``longest`` is passed."""
    path = path or default_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            doc_ids = batch.column(0)
            at = 0
            for run in _groups(batch.column(1).to_pylist()):
                rows, pieces, starts, lengths, parts = [], [], [], [], []
                for ids in encoder.encode_all(run):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * longest)):
                        part = ids[start : start + 4 * longest]
                        rows.append(at)
                        pieces.append(piece)
                        starts.append(start // 4)
                        lengths.append(len(part) // 4)
                        parts.append(part)
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")
