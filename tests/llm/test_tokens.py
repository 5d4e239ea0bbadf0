"""Token files, packing and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

from laketier.llm import dac
from laketier.llm.packing import WINDOW, combinations, pack, pack_documents, repeat_counts
from laketier.llm.token_counts import merged_size, token_counts
from laketier.llm.token_files import read_segments, token_documents, write_tokens
from laketier.llm.common import scratch_path
from laketier.llm.tokens import vocabulary_path

ODD = ["\x1c", "\x85", " ", "é", "é", "É", "İ", "Σ", "ς", "<|endoftext|>",
       "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "'s", "'LL", "’", "中文", "한국", "１", "²", "_",
       "‍", "🙂", "\n", "\t", " ", "a", "B", "The", "don't", "ﬁ", "ß", "\x00", ".", ",", "!",
       "3", "÷", "\x0b", "\r\n"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture()
def rows(words):
    r = random.Random(11)
    odd = [(i, "".join(r.choice(ODD) for _ in range(r.randint(0, 14)))) for i in range(400)]
    return odd + [(1000 + i, words(r.randint(0, 300))) for i in range(40)] + [
        (2000, words(9000)), (2001, None), (2002, ""), (2003, " \n"), (None, "no id"),
        (5, "an id again"), (5, "an id again"), (2004, "x" * 5000)]


def expected(library, rows):
    return [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_dac_round_trip_and_random_access():
    r = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 511, 512, 513, 3000):
        for top in (10, 300, 70_000, 2**32 - 1):
            for bits in (4, 8):
                ids = r.integers(0, top, n, endpoint=True).astype(np.uint32)
                reader = dac.Reader(dac.encode(ids, bits))
                assert len(reader) == n and (reader.range(0, n) == ids).all()
                assert all(reader[i] == ids[i] for i in range(0, n, 37))
                for a, b in np.sort(r.integers(0, n, (9, 2), endpoint=True)).tolist():
                    assert (reader.range(a, b) == ids[a:b]).all()
    with pytest.raises(IndexError):
        dac.Reader(dac.encode(np.arange(5)))[5]
    with pytest.raises(ValueError):
        dac.Reader(b"something else")


def test_token_files_hold_the_librarys_ids_in_order(documents, rows, library):
    got = token_documents(documents(rows)).orderBy("start").collect()
    want = sorted(expected(library, rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == \
        sorted((i, len(t), crc(t)) for i, t in want if i is not None)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_segments_are_cut_between_documents_and_read_at_random(spark, documents, rows, library):
    path = scratch_path(spark, "test")
    write_tokens(documents(rows), path, segment_tokens=500)
    segments = read_segments(spark, path).orderBy("start").collect()
    assert len(segments) > 5 and all(s.n_tokens == sum(s.sizes) for s in segments)
    everything = [t for s in segments for t in dac.Reader(s.image).range(0, s.n_tokens).tolist()]
    for s in segments[::3]:
        reader = dac.Reader(s.image)
        assert all(reader[i] == everything[s.start + i] for i in range(0, s.n_tokens, 41))


def test_pieces_cover_every_id_once(documents, rows, library):
    got = pack_documents(documents(rows)).collect()
    ids = {}
    for i, t in expected(library, rows):
        ids.setdefault(i, t)
    for i in {r[0] for r in rows} - {5}:
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids[i])
        at = 0
        for r in pieces:
            assert (r.start, r.doc_tokens) == (at, len(ids[i]))
            assert r.ids_crc32 == crc(ids[i][at:at + r.length])
            at += r.length
    assert sum(r.length for r in got if r.doc_id == 5) == sum(len(t) for i, t in expected(library, rows)
                                                              if i == 5)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        assert [a for a, _ in sorted(pieces)] == \
            np.cumsum([0, *(n for _, n in sorted(pieces))])[:-1].tolist()
        assert sum(n for _, n in pieces) <= WINDOW
    # at most one short sequence per partition of the input
    assert sum(sum(n for _, n in p) < WINDOW for p in sequences.values()) <= 3


def test_solver_finds_known_repeat_counts():
    histogram = np.zeros(WINDOW, np.int64)
    for lengths, times in (((1000, 1048), 40), ((500, 700, 848), 30), ((1024, 1024), 10)):
        for n in lengths:
            histogram[n] += times
    combos = combinations(histogram)
    counts = repeat_counts(combos, histogram)
    assert (counts >= 0).all()
    fitted = np.bincount(combos.ravel(), np.repeat(counts, 3), minlength=WINDOW)
    fitted[0] = 0
    assert np.abs(fitted - histogram).max() < 1
    lengths = np.repeat(np.arange(WINDOW), histogram)
    pieces, sequences = pack(lengths)
    assert sequences == 80 and len(pieces) == len(lengths)  # every window full, nothing cut


def test_counts_equal_the_library(documents, rows, library):
    got = token_counts(documents(rows), limit=50).collect()
    want = [(i, len((t or "").encode()), len(ids) - 1, len(ids) - 1 > 50)
            for (i, t), (_, ids) in zip(rows, expected(library, rows))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_merging_takes_the_lowest_rank_leftmost_first():
    ranks = {("a", "a"): 0, ("aa", "a"): 1, ("b", "c"): 2, ("aa", "aa"): 3}
    assert merged_size(list("aaa"), ranks) == 1
    assert merged_size(list("aaaa"), ranks) == 1
    assert merged_size(list("abcb"), ranks) == 3
    assert merged_size(["x"], ranks) == 1 and merged_size([], ranks) == 0


def test_empty_tables(documents):
    none = documents([(1, "a")]).where("doc_id < 0")
    assert token_documents(none).collect() == []
    assert pack_documents(none).collect() == []
    assert token_counts(none).collect() == []
