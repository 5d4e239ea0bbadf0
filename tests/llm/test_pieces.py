"""Operator 11 against the sentencepiece library."""

import hashlib
import random

import pyarrow as pa
import pytest

from laketier.llm import pieces, queries
from laketier.llm.tokens import vocabulary_path

PARTS = ["\u2003", "\u3000", "“", "a", "b", "the", " ", " ", "  ", "▁", "\n", "\t", "é", "日", "😀", "\x00", "<s>", "</s>",
         "<0x41>", "⁇", "\xa0", "ing", "   ", ".", ",", "1", "́", "﻿", "﷽", "\u0085"]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=vocabulary_path(pieces.VOCABULARY))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(3000)] + [
        "", " ", " " * 500, "▁" * 9 + " " * 9, "x" * 30_000, "word " * 20_000]


def test_ids_and_texts_equal_the_library(library, texts):
    encoder = pieces.PieceEncoder.of(vocabulary_path(pieces.VOCABULARY))
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    want = library.encode(texts, add_eos=True)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
    assert encoder.decode(lists).to_pylist() == library.decode(want)
    assert encoder.decode(lists.slice(7, 20)).to_pylist() == library.decode(want[7:27])


def test_any_ids_decode_as_by_the_library(library):
    r = random.Random(5)
    ids = [[r.randrange(32_000) if r.random() < 0.6 else r.randrange(3, 259)
            for _ in range(r.randint(0, 12))] for _ in range(4000)]
    encoder = pieces.PieceEncoder.of(vocabulary_path(pieces.VOCABULARY))
    assert encoder.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == library.decode(ids)


def test_a_difference_from_the_library_fails(monkeypatch):
    encoder = pieces.PieceEncoder(vocabulary_path(pieces.VOCABULARY))
    monkeypatch.setitem(encoder.rank, "▁a", None)
    with pytest.raises(pieces.PieceMismatch):
        encoder.encode(pa.array(["a b"]))


def test_unused_pieces_are_taken_apart():
    encoder = pieces.PieceEncoder(vocabulary_path(pieces.VOCABULARY))
    assert encoder.merged("▁the") == ["▁the"]
    encoder.unused = {"▁the"}
    assert "".join(encoder.merged("▁the")) == "▁the" and len(encoder.merged("▁the")) > 1


def test_words_are_joined_many_at_a_time_as_one_by_one(texts, monkeypatch):
    encoder = pieces.PieceEncoder(vocabulary_path(pieces.VOCABULARY))
    units = [" " + x for x in texts if x] + [" " + "a" * n for n in range(45)] + [" 日\U0010ffffa", "  "]
    want = [encoder.encoded(u) for u in units]
    monkeypatch.setattr(pieces, "ROWS", 100)
    ids, sizes = encoder.encoded_units(units)
    assert ids.tolist() == [i for x in want for i in x] and sizes.tolist() == list(map(len, want))
    encoder.unused = {"▁the"}  # such vocabularies have their units one by one
    ids, sizes = encoder.encoded_units([" the", " a"])
    assert sizes.tolist() == [len(encoder.encoded(" the")), 1]
    encoder.unused = set()
    monkeypatch.setattr(pieces, "heapq", None)
    encoder.encode(pa.array(["no heap for words, nor for é日😀.\n"]))


def test_equal_scores_are_joined_leftmost_first():
    encoder = pieces.PieceEncoder(vocabulary_path(pieces.VOCABULARY))
    encoder.rank = {p: 1 for p in encoder.rank}
    units = [" there", " aaaaa", " restlessness", " onononon"]
    ids, _ = encoder.encoded_units(units)
    assert ids.tolist() == [i for u in units for i in encoder.encoded(u)]


def test_query_rows(spark, documents, library, texts, monkeypatch):
    rows = [(i % 2900, t) for i, t in enumerate(texts)] + [(None, "no id"), (4, None), (5, "twice"),
                                                           (5, "twice")]
    monkeypatch.setattr(queries, "table", lambda *a: documents(rows))
    got = sorted(map(tuple, queries.op11_pieces(spark, "").collect()), key=repr)
    ids = library.encode([t or "" for _, t in rows], add_eos=True)
    want = [(d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
             hashlib.sha256(x.encode()).hexdigest())
            for (d, _), i, x in zip(rows, ids, library.decode(ids))]
    assert got == sorted(want, key=repr)
    assert queries.op11_pieces(spark, "").columns == ["doc_id", "n_tokens", "ids_sha256",
                                                      "decoded_sha256"]


def test_decoding_as_an_operator_of_its_own(spark, documents):
    encoded = pieces.encode_documents(documents([(1, "plain  text é 日"), (2, None)]))
    out = {r.doc_id: r.decoded for r in pieces.decode_documents(encoded).collect()}
    assert out == {1: "plain  text é 日", 2: ""}
    lists = spark.createDataFrame([(1, [264, 287]), (2, None)], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in pieces.decode_documents(lists).collect()} == {
        1: "a b", 2: ""}


def test_empty_table(spark, documents):
    assert pieces.encode_documents(documents([])).collect() == []
