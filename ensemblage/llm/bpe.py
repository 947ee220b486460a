"""Byte-level BPE by a transducer that is determinised as it is used, and streaming decode.

Merging the pair of least rank again and again gives the one sequence of tokens in which every two neighbours, taken
alone, would stay apart. So tokens can be found from left to right: a nondeterministic machine stands behind a finished
token and inside a next one, and may finish it where the two are *neighbours*, that is, where merging their bytes gives
these two tokens back. Every prefix of a text has exactly one such parse. The deterministic machine follows the parses
that some open token still may continue. What they share is final and emitted, so output lags behind by a few tokens; a
state is the last emitted token and the bytes since, whose parses it determines. States and transitions are made when a
text first needs them and kept in a table of limited size; text is then encoded by one lookup per byte, however long it is.

Decoding lifts the state machine of UTF-8 to tokens: a state is the beginning of a character that is not complete yet; per
state and token, the text that becomes complete and the next state are kept once found. Bytes that are no UTF-8 become
U+FFFD each time a character breaks off, as in Python's own decoder.

Defined results: a null text is empty and has no ids; invalid bytes in a text are read as U+FFFD; every row is encoded for
itself, repeated or not; a text of any length is encoded piece by piece, given out in rows of bounded size; an empty table
gives no rows; columns beyond doc_id and text are ignored. Classes of characters are those of the ``regex`` library's year
of Unicode; libraries of another year may part texts with newer letters differently. Ids that no token has raise an error when decoded.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import itertools
import re
from array import array
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Transitions kept by a worker before it starts anew; more only saves time.
MOST_TRANSITIONS = 700_000
#: Pieces of text whose ids a worker remembers before it starts anew; longer pieces are not remembered.
MOST_PIECES, LONGEST_PIECE = 900_000, 64
#: Pairs of tokens known to be neighbours or not, before they are found anew.
MOST_PAIRS = 500_000
#: Bytes behind the last emitted token beyond which states are not kept but made again.
LONGEST_WINDOW = 512
#: Ids per row of encoded text.
IDS_PER_ROW = 1 << 16


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to id from a file of base64 tokens and ranks; the vocabulary is of fixed size and read by the driver."""
    if "://" in path:
        lines = [row[0] for row in spark.read.text(path).collect()]
    else:
        with open(path, encoding="ascii") as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


BYTES = [bytes((byte,)) for byte in range(256)]
#: A parse: its last token (-1: none), the parse before that and how many tokens it has. Equal beginnings are one object.
Parse = tuple[int, Any, int]
#: A parse that may go on: the bytes behind it, which begin a token.
Open = tuple[int, Parse]
#: A part at a token's edge, the rank of the merge that makes it and of the one that takes it.
Edge = tuple[bytes, int, int]


class Transducer:
    """Bytes to ids. ``ranks`` must hold every single byte."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        #: per beginning of a token: twice the token that it is itself (0 if none, else 1 more), and 1 if longer ones go on
        self.beginnings: dict[bytes, int] = {}
        for token, rank in ranks.items():
            self.beginnings[token] = self.beginnings.get(token, 0) & 1 | (rank + 1) << 1
            for size in range(1, len(token)):
                self.beginnings[token[:size]] = self.beginnings.get(token[:size], 0) | 1
        self.longest = max(map(len, ranks), default=1)
        self.edges = functools.lru_cache(1 << 17)(self._edges)
        #: left token * 2**32 + right token: whether they are neighbours
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        start: Parse = (-1, None, 0)
        #: per state the bytes since the last emitted token, the parse that ends with it, and those open behind it, longest bytes first
        self.states: list[tuple[bytes, Parse, list[Open]]] = [(b"", start, [(0, start)])]
        #: a state is known by its last emitted token and the bytes since
        self.number: dict[tuple[int, bytes], int] = {(-1, b""): 0}
        #: state * 256 + byte to (state, emitted ids)
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}

    def _merge(self, text: bytes) -> Iterator[list[bytes]]:
        """The parts of a short text before and after each merge of the pair of least rank."""
        parts = [text[i : i + 1] for i in range(len(text))]
        yield parts
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                return
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
            yield parts

    def _edges(self, token: int) -> tuple[list[Edge], list[Edge]] | None:
        """First and last parts that a token has while it is merged; None if merging its bytes doesn't give it.

        None of the lists is to be trusted as a course of time if ranks of merges don't rise; they are empty then.
        """
        steps = list(self._merge(self.tokens[token]))
        if len(steps[-1]) > 1:
            return None
        ranks = [self.ranks[next(part for part, old in zip(after, before, strict=False) if part != old)] for before, after in itertools.pairwise(steps)]
        if ranks != sorted(ranks):
            return [], []
        sides: list[list[Edge]] = []
        for at in (0, -1):
            times = [(parts[at], time) for parts, time in zip(steps, [-1, *ranks], strict=True)]
            first = [(part, time) for i, (part, time) in enumerate(times) if i == 0 or part != times[i - 1][0]]
            ends = [time for _, time in first[1:]] + [1 << 60]
            sides.append([(part, time, end) for (part, time), end in zip(first, ends, strict=True)])
        return sides[0], sides[1]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives both again.

        Apart from the border both merge in order of rank. A part at the end of the left and one at the start of the
        right merge if both are there at the time of their rank, or of the later one's making if that is later.
        """
        before, after = self.edges(left), self.edges(right)
        if before is None or after is None:
            return False
        unsure = not before[1] or not after[0]
        for a, made_a, gone_a in before[1]:
            for b, made_b, gone_b in after[0]:
                rank = self.ranks.get(a + b)
                if rank is not None:
                    time, gone = max(rank, made_a, made_b), min(gone_a, gone_b)
                    if time < gone and not unsure:
                        return False
                    unsure |= time == gone
        if not unsure:
            return True
        *_, parts = self._merge(self.tokens[left] + self.tokens[right])
        return parts == [self.tokens[left], self.tokens[right]]

    def _follow(self, window: bytes, parses: list[Open]) -> list[Open]:
        """What is open behind the last byte of the window: tokens that go on, and the one parse that ends there, if any."""
        ended, still, about_of, known = None, [], self.beginnings.get, self.pairs
        for size, parse in parses:
            about = about_of(window[-size - 1 :])
            if about:
                if about & 1:
                    still.append((size + 1, parse))
                if about > 1 and ended is None:
                    token, last = (about >> 1) - 1, parse[0]
                    fits = known.get(last << 32 | token) if last >= 0 else self.edges(token) is not None
                    if fits is None:
                        if len(known) >= MOST_PAIRS:
                            known.clear()
                        fits = known[last << 32 | token] = self.neighbours(last, token)
                    if fits:
                        ended = token, parse, parse[2] + 1
        if ended:
            still.append((0, ended))
        return still

    @staticmethod
    def _path(parse: Parse, base: Parse) -> tuple[int, ...]:
        """The tokens of a parse behind an earlier one."""
        path = []
        while parse is not base:
            path.append(parse[0])
            parse = parse[1]
        return tuple(path[::-1])

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Follow a byte for the first time: all parses that can go on, and what they share."""
        window, base, parses = self.states[state]
        window += BYTES[byte]
        parses = self._follow(window, parses)
        shared = parses[0][1]
        for _, parse in parses:
            while shared is not parse:
                if shared[2] >= parse[2]:
                    shared = shared[1]
                else:
                    parse = parse[1]
        emitted: tuple[int, ...] = ()
        if shared is not base:
            emitted = self._path(shared, base)
            size, parse = parses[0]
            while parse is not shared:
                size += len(self.tokens[parse[0]])
                parse = parse[1]
            window = window[len(window) - size :]
        key = (shared[0], window)
        target = self.number.get(key)
        if target is None:
            target = self.number[key] = len(self.states)
            self.states.append((window, shared, parses))
        self.steps[state << 8 | byte] = target, emitted
        return target, emitted

    def _end(self, state: int) -> tuple[int, ...]:
        _, base, parses = self.states[state]
        rest = self.ends[state] = self._path(parses[-1][1], base)  # the one that ends here has no bytes behind it
        return rest

    def encode(self, piece: bytes) -> list[int]:
        if len(self.steps) > MOST_TRANSITIONS:
            self._forget()
        ids: list[int] = []
        state, steps, states = 0, self.steps, self.states
        for at, byte in enumerate(piece):
            step = steps.get(state << 8 | byte)
            if step is None:
                if len(states[state][0]) >= LONGEST_WINDOW:
                    return ids + self._without_states(state, piece[at:])
                before = len(states)
                step = self._step(state, byte)
                if len(states) > before:  # what follows a state that is new is new as well: it waits until it comes again
                    ids += step[1]
                    return ids + self._without_states(step[0], piece[at + 1 :])
            state, emitted = step
            if emitted:
                ids += emitted
        ids += self.ends.get(state) or self._end(state)
        return ids

    def _without_states(self, state: int, rest: bytes) -> list[int]:
        """The ids behind a state to the end, without making states: for a lag beyond what they may hold."""
        window, base, parses = self.states[state]
        for byte in rest:
            window = window[-self.longest :] + bytes((byte,))
            parses = self._follow(window, parses)
        return list(self._path(parses[-1][1], base))


#: Texts of these characters alone are parted by Python's own, faster expressions.
LATIN = re.compile("[\t\n\r -~\u00a0-\u024f]*")


def latin_pattern(pattern: str) -> re.Pattern[str] | None:
    """The pattern for ``LATIN`` texts, its classes of letters and numbers written out; None if it has others."""
    shown = "".join(map(chr, range(0x24F + 1)))
    out, inside = [], False
    for part in regex.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, flags=regex.DOTALL):
        if part[:2] in (r"\p", r"\P") and len(part) > 2:
            found = "".join(map(re.escape, regex.findall(part, shown)))
            out.append(found if inside else f"[{found}]")
            continue
        inside = (inside or part == "[") and part != "]"
        out.append(part)
    try:
        return re.compile("".join(out))
    except re.error:
        return None


class TextEncoder:
    """Ids of texts: each match of the pattern for itself, short ones remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.machine = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.latin = latin_pattern(pattern)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the pieces remembered last; those met again are taken over

    def _new(self, piece: str) -> bytes:
        ids = self.before.get(piece) or array("I", self.machine.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= LONGEST_PIECE:
            self.known[piece] = ids
        return ids

    def _forget_some(self) -> None:
        if len(self.known) > MOST_PIECES:
            self.known, self.before = {}, self.known

    def encode(self, text: str) -> Iterator[bytes]:
        """Runs of ids as little-endian unsigned 32-bit integers, a run per stretch of text."""
        self._forget_some()
        pattern = self.latin if self.latin and LATIN.fullmatch(text) else self.pattern
        if len(text) <= 1 << 20:  # a text of ordinary length at once
            pieces = pattern.findall(text)
            found = list(map(self.known.get, pieces))
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                found[at] = self.known.get(pieces[at]) or self._new(pieces[at])
            yield b"".join(found)
            return
        run: list[bytes] = []
        size = 0
        for match in pattern.finditer(text):
            ids = self.known.get(match.group()) or self._new(match.group())
            run.append(ids)
            size += len(ids)
            if size >= 4 * IDS_PER_ROW:
                yield b"".join(run)
                run, size = [], 0
                self._forget_some()
        yield b"".join(run)


#: This worker's encoder, kept from task to task with the pieces and transitions it knows, behind its ranks and pattern.
_KEPT: list[tuple[dict[bytes, int], str, TextEncoder]] = []


def encoder_of(ranks: dict[bytes, int], pattern: str) -> TextEncoder:
    """The encoder of this worker, made anew for other ranks or another pattern than before."""
    if not _KEPT or _KEPT[0][0] is not ranks or _KEPT[0][1] != pattern:
        _KEPT[:] = [(ranks, pattern, TextEncoder(ranks, pattern))]
    return _KEPT[0][2]


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, part (from 0), ids: each text's ids in rows of limited size, one after the other; an empty text has one row.

    ids are little-endian unsigned 32-bit integers, one behind the other, in a binary value. Nothing is shuffled.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(spark, path or default_path()))  # a vocabulary: its size doesn't grow
    pattern = pattern or default_pattern()
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("part", pa.int64()), ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, pattern)
        most = 4 * IDS_PER_ROW
        for batch in batches:
            doc_ids, rows, parts, values, size = batch.column(0), [], [], [], 0

            def made() -> pa.RecordBatch:
                taken = doc_ids.take(pa.array(rows, pa.int64())).cast(schema.field(0).type)
                return pa.RecordBatch.from_arrays([taken, pa.array(parts, pa.int64()), pa.array(values, pa.binary())], schema=schema)

            for row, text in enumerate(batch.column(1)):
                part = 0
                for run in encoder.encode((text.as_py() or b"").decode("utf-8", "replace")):
                    for at in range(0, len(run), most) if run else (0,):
                        if not run and part:
                            continue  # nothing behind the last full run
                        rows.append(row)
                        parts.append(part)
                        values.append(run[at : at + most])
                        part += 1
                        size += len(values[-1])
                        if size > 16 * most:
                            yield made()
                            rows, parts, values, size = [], [], [], 0
            yield made()

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(work, f"doc_id {kind.simpleString()}, part bigint, ids binary")


class StreamDecoder:
    """Ids to text, part by part: a character cut by the end of a part comes with the next one."""

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.tokens = tokens
        #: per beginning of a character: id to the text that becomes complete and the beginning left
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        self.whole: dict[int, str] = {}  # tokens that are whole characters
        self.pending = b""

    def _step(self, pending: bytes, number: int) -> tuple[str, bytes]:
        token = self.tokens.get(number)
        if token is None:
            raise ValueError(f"no token has id {number}")
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        text = machine.decode(pending + token)
        left = machine.getstate()[0]
        found = self.steps[pending][number] = text, left
        self.steps.setdefault(left, {})
        if not pending and not left:
            self.whole[number] = text
        return found

    def feed(self, ids: array[int]) -> str:
        if not self.pending and None not in (texts := list(map(self.whole.get, ids))):
            return "".join(texts)
        out: list[str] = []
        pending, here = self.pending, self.steps[self.pending]
        for number in ids:
            step = here.get(number) or self._step(pending, number)
            out.append(step[0])
            if step[1] != pending:
                pending = step[1]
                here = self.steps[pending]
        self.pending = pending
        return "".join(out)

    def close(self) -> str:
        """What an unfinished character at the end gives."""
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")


def _ids(value: bytes) -> array[int]:
    found = array("I")
    found.frombytes(value)
    return found


def decoded(parts: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, part, ids, text for rows as ``encoded`` gives them: a document's parts one after the other, from part 0."""
    spark = parts.sparkSession
    shared = spark.sparkContext.broadcast({rank: token for token, rank in read_ranks(spark, path or default_path()).items()})
    kind = parts.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("part", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder(shared.value)
        held: tuple[pa.RecordBatch, list[str]] | None = None  # its last text may still get the end of a character
        for batch in batches:
            texts: list[str] = []
            for part, ids in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if part == 0:
                    rest = decoder.close()
                    if texts:
                        texts[-1] += rest
                    elif held:
                        held[1][-1] += rest
                texts.append(decoder.feed(_ids(ids)))
            if not texts:
                continue
            if held:
                yield _with_text(*held)
            held = batch, texts
        if held:
            held[1][-1] += decoder.close()
            yield _with_text(*held)

    def _with_text(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        columns = [batch.column(i).cast(schema.field(i).type) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema=schema)

    return parts.select("doc_id", "part", "ids").mapInArrow(work, f"doc_id {kind.simpleString()}, part bigint, ids binary, text string")


def round_trips(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded and decoded again by the same worker, run by run."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(spark, path or default_path()))  # a vocabulary: its size doesn't grow
    pattern = pattern or default_pattern()
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, pattern)
        decoder = StreamDecoder(encoder.machine.tokens)
        for batch in batches:
            found: list[tuple[int, str, str]] = []
            for text in batch.column(1):
                count, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for run in encoder.encode((text.as_py() or b"").decode("utf-8", "replace")):
                    count += len(run) // 4
                    of_ids.update(run)
                    of_text.update(decoder.feed(_ids(run)).encode("utf-8"))
                of_text.update(decoder.close().encode("utf-8"))
                found.append((count, of_ids.hexdigest(), of_text.hexdigest()))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            arrays = [batch.column(0).cast(schema.field(0).type), *[pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)]]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        work, f"doc_id {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
