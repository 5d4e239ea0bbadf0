"""Repeated byte strings against a brute-force search of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from laketier.llm import repeats
from laketier.llm.queries import QUERIES
from laketier.llm.repeats import remove_repeats


def brute(rows, min_bytes, keep):
    data = [(t or "").encode() for _, t in rows]
    count, first = Counter(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        for a in range(len(data[i]) - min_bytes + 1):
            w = data[i][a:a + min_bytes]
            count[w] += 1
            first.setdefault(w, (i, a))
    out = []
    for i, (doc, _) in enumerate(rows):
        gone = np.zeros(len(data[i]), bool)
        for a in range(len(data[i]) - min_bytes + 1):
            w = data[i][a:a + min_bytes]
            if count[w] > 1 and (keep == "none" or first[w] != (i, a)):
                gone[a:a + min_bytes] = True
        kept = bytes(np.frombuffer(data[i], np.uint8)[~gone])
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(data[i]), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(words):
    r = random.Random(5)
    shared = [words(60) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [words(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, len(s) // 2)
            parts += [s[a:r.randint(a, len(s))], words(r.randint(0, 30))]
        rows.append((i, r.choice(["", " "]).join(parts)))
    rows += [(100, None), (101, ""), (102, "x"), (103, "a" * 500), (104, "ab" * 300),
             (105, rows[3][1]), (106, rows[3][1]), (107, "é" * 200), (None, rows[4][1])]
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("crowd", [256, 2, 1])
def test_equals_brute_force(documents, words, keep, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = texts(words)
    got = remove_repeats(documents(rows), 50, keep).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 50, keep)


def test_repeated_rows_and_empty_tables(documents, words):
    text = words(30)
    got = remove_repeats(documents([(1, text), (1, text), (2, words(30))]), 50).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [
        (1, len(text.encode())), (1, len(text.encode())), (2, 0)]
    assert remove_repeats(documents([(1, text)]).where("doc_id < 0"), 50).collect() == []


def test_pieces_of_a_long_text_cover_every_window(words, monkeypatch):
    data = words(400).encode()
    whole = repeats.runs(data, 60)
    monkeypatch.setattr(repeats, "PIECE", 300)
    cut = repeats.runs(data, 60)
    for first, last, _, place in (whole, cut):
        covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
        assert covered.tolist() == list(range(len(data) - 59))
        assert ((place <= first + 60 - 32) & (place >= last)).all()


def suffixes_of(data, length):
    return repeats.SuffixOrder(np.frombuffer(data, np.uint8), np.arange(len(data) - length + 1), length)


@pytest.mark.parametrize("length", [8, 9, 16, 50, 100])
def test_window_ranks_are_suffix_order(words, length):
    data = (words(40) * 2).encode()
    order = suffixes_of(data, length)
    windows = [data[a:a + length] for a in range(len(data) - length + 1)]
    want = {w: i for i, w in enumerate(sorted(set(windows)))}
    assert order.ranks.tolist() == [want[w] for w in windows]


@pytest.mark.parametrize("length", [8, 9, 50, 100])
def test_longest_previous_factors_equal_brute_force(words, length):
    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), length)

    for data in (words(30).encode() * 2 + words(10).encode(), b"a" * 150, b"ab" * 70 + b"ba" * 40,
                 bytes([0] * 120 + [1] + [0] * 120), random.Random(1).randbytes(120) * 2):
        windows = [data[a:a + length] for a in range(len(data) - length + 1)]
        factor, source = repeats.longest_previous_factors(suffixes_of(data, length))
        assert factor.tolist() == [max((common(w, e) for e in windows[:i]), default=0)
                                   for i, w in enumerate(windows)]
        for i, (f, s) in enumerate(zip(factor.tolist(), source.tolist())):
            assert (f == 0) == (s < 0) and (s < 0 or s < i and common(windows[i], windows[s]) == f)
        either, later = repeats.copies(np.frombuffer(data, np.uint8), np.arange(len(windows)), length)
        assert later.tolist() == [w in windows[:i] for i, w in enumerate(windows)]
        assert either.tolist() == [windows.count(w) > 1 for w in windows]


def test_previous_smaller_equals_brute_force():
    r = np.random.default_rng(1)
    for values in (r.permutation(500), np.arange(300), np.arange(300)[::-1], np.zeros(0, int),
                   np.concatenate([np.arange(1, 400), [0], np.arange(400, 500)]),
                   np.concatenate([np.arange(100, 300), np.arange(50), np.arange(50, 100)[::-1]])):
        want = [next((j for j in range(i - 1, -1, -1) if values[j] < v), -1)
                for i, v in enumerate(values)]
        assert repeats.previous_smaller(values).tolist() == want


def test_planted_passages_of_over_50_words(spark, documents, workdir):
    """The contract's 400 bytes decide, not the words: passages of 51 words and more are
    removed from 400 bytes on and stay below; documents without any stay whole."""
    r = random.Random(11)

    def word(n):
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n))

    def passage(n_bytes):
        text = " ".join(word(r.randint(4, 6)) for _ in range(51))
        return text + " " + "x" * (n_bytes - len(text.encode()) - 1)

    rows, sizes = [], (350, 399, 400, 401, 700)
    for k, size in enumerate(sizes):
        planted = passage(size)
        assert len(planted.encode()) == size and len(planted.split()) > 50
        for i in range(3):  # other bytes on either side, so that no copy reaches further
            around = " ".join(word(5) for _ in range(80))
            rows.append((10 * k + i, f"{around}{'ABC'[i]}{planted}{'XYZ'[i]}{around[::-1]}"))
    rows += [(100 + i, " ".join(word(5) for _ in range(150))) for i in range(5)]
    documents(rows).write.parquet(f"{workdir}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op6_repeated_strings"](spark, workdir).collect()))
    assert got == sorted(brute(rows, 400, "none"))
    assert {g[0]: g[2] for g in got} == {
        **{10 * k + i: size if size >= 400 else 0 for k, size in enumerate(sizes) for i in range(3)},
        **{100 + i: 0 for i in range(5)}}
