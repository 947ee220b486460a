"""Encoding against the tiktoken library and against plain merging, decoding against whole bytes."""

import hashlib
import random
import unicodedata
from array import array

import public_tokenizers
import pytest
import tiktoken

from ensemblage.llm import bpe, queries

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = array("I", library.encode_ordinary(text or "")).tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def odd_texts():
    rng = random.Random(1)
    kinds = [(32, 127), (0, 0x2FFF), (0x10000, 0x1FFFF), (0x4E00, 0x9FFF)]
    # characters that Unicode has had for long: the libraries' tables are of different years
    mixed = ["".join(c for _ in range(n) if unicodedata.ucd_3_2_0.category(c := chr(rng.randrange(*rng.choice(kinds)))) != "Cn") for n in (9, 40, 3_000)]
    return [None, "", " ", "\n\n\n", "a" * 30_000, " " * 2_000, "-" * 4_000, "=-" * 900, "\x00\x7f", "é" * 500, "日本語" * 300, "😀👩‍👩‍👧" * 200,
            "don't I'LL we've", "1234567890" * 50, "<|endoftext|>", "tie", "tie", *mixed]


def test_texts_against_the_library(spark, library):
    rows = [(i // 2 if i % 5 else None, text, "clash") for i, text in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part string")
    found = sorted((tuple(r) for r in bpe.round_trips(docs).collect()), key=repr)
    assert found == sorted(((doc, *expected(library, text)) for doc, text, _ in rows), key=repr)


def test_parts_of_limited_size_join_to_the_text(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "IDS_PER_ROW", 7)
    texts = ["😀👩‍👩‍👧 日本 " * 40, "plain words " * 30, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    rows = bpe.decoded(bpe.encoded(docs)).collect()
    for doc, text in enumerate(texts):
        mine = [r for r in rows if r["doc_id"] == doc]
        assert [r["part"] for r in mine] == list(range(len(mine))) and all(len(r["ids"]) <= 28 for r in mine)
        assert "".join(r["text"] for r in mine) == (text or "")
        assert b"".join(r["ids"] for r in mine) == array("I", library.encode_ordinary(text or "")).tobytes()


def test_other_vocabularies_by_plain_merging():
    rng = random.Random(7)
    for _ in range(60):  # random merges over three letters, also such that a later one is met first
        ranks = {bytes((b,)): b for b in range(256)}
        made = [b"a", b"b", b"c"]
        for rank in range(256, 256 + rng.randint(1, 30)):
            token = rng.choice(made) + rng.choice(made)
            if token not in ranks:
                ranks[token] = rank
                made.append(token)
        machine = bpe.Transducer(ranks)
        for _ in range(60):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            *_, parts = machine._merge(text)
            assert machine.encode(text) == [ranks[part] for part in parts]


def test_forgetting_and_long_windows_change_nothing(ranks, library, monkeypatch):
    texts = [t for t in odd_texts() if t]
    monkeypatch.setattr(bpe, "MOST_TRANSITIONS", 50)
    monkeypatch.setattr(bpe, "LONGEST_WINDOW", 3)
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    encoder = bpe.TextEncoder(ranks, public_tokenizers.PATTERN)
    for text in texts:
        assert b"".join(encoder.encode(text[:500])) == array("I", library.encode_ordinary(text[:500])).tobytes()


def test_decoding_ids_that_are_no_text(ranks):
    tokens = {rank: token for token, rank in ranks.items()}
    rng = random.Random(2)
    for _ in range(200):
        ids = [ranks[bytes((rng.choice((0x41, 0xC3, 0xA9, 0xE6, 0x97, 0xA5, 0xF0, 0x9F, 0xFF)),))] for _ in range(rng.randint(1, 30))]
        decoder = bpe.StreamDecoder(tokens)
        shown = "".join(decoder.feed(array("I", ids[at : at + 3])) for at in range(0, len(ids), 3)) + decoder.close()
        assert shown == b"".join(tokens[i] for i in ids).decode("utf-8", "replace")
    with pytest.raises(ValueError):
        bpe.StreamDecoder(tokens).feed(array("I", [4_000_000]))


def test_invalid_bytes_and_an_empty_table(spark, library):
    docs = spark.createDataFrame([(1, b"ab\xffcd\xe6\x97")], "doc_id int, raw binary").selectExpr("doc_id", "cast(raw as string) as text")
    shown = bpe.decoded(bpe.encoded(docs)).collect()
    assert [r["text"] for r in shown] == [b"ab\xffcd\xe6\x97".decode("utf-8", "replace")]
    assert bpe.round_trips(docs.limit(0)).count() == 0 and bpe.decoded(bpe.encoded(docs.limit(0))).count() == 0


def test_a_worker_keeps_its_encoder_from_task_to_task(spark, ranks):
    other, pattern = dict(ranks), bpe.default_pattern()
    first = bpe.encoder_of(ranks, pattern)
    assert b"".join(first.encode("kept pieces")) and bpe.encoder_of(ranks, pattern) is first and first.known
    assert bpe.encoder_of(other, pattern) is not first and bpe.encoder_of(ranks, "[a-z]+").pattern.pattern == "[a-z]+"
    shared = spark.sparkContext.broadcast(other)
    met = spark.sparkContext.parallelize(range(40), 40).map(lambda _: (__import__("os").getpid(), id(bpe.encoder_of(shared.value, pattern)))).collect()
    assert len(set(met)) == len({pid for pid, _ in met}) < 40


def test_registered_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = sorted(map(tuple, queries.QUERIES["op12_bpe"](spark, folder).collect()))
    assert found == sorted((r["doc_id"], *expected(library, r["text"])) for r in docs)
