"""Operator 12 against a brute-force version."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from laketier.llm import queries, ranking

ITEM_COLUMNS = "item_id bigint, text string, doc_id string, m string, score string, held string"


def brute_force(docs, items, top=10):
    counted = [(d, Counter(t), len(t)) for d, text in docs if (t := ranking.item_terms(text))]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in counted:
            m = 100 - 75 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in ranking.item_terms(text) if t in c)
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(found[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    common, rare = ["the", "of", "é", "日本", "a1", "X"], [f"w{i}" for i in range(200)]

    def text(n):
        seps = [" ", "\n", ", ", "\x00", "-", "  ", " "]
        return "".join((r.choice(common) if r.random() < 0.5 else r.choice(rare)) + r.choice(seps)
                       for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(300)]
    docs += [(1000 + i, "a copy of W7 and w8, w8") for i in range(120)]  # ties, one stratum
    docs += [(None, "no id w9"), (None, "no id w9"), (5, "w9 same id"), (5, "w9 same id"),
             (6, None), (7, ""), (8, " .,;\t"), (9, "w3 " * 50_000)]
    items = [(i, text(r.randint(0, 40))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "unheard"), (103, "w8 copy"), (104, "W9 w9 W9"),
              (104, "w9"), (None, "of w3"), (105, "?!")]
    return docs, items


def frames(spark, documents, rows):
    docs, items = rows
    return documents(docs), spark.createDataFrame(
        [(i, t, "d", "m", "s", "h") for i, t in items], ITEM_COLUMNS)


@pytest.mark.parametrize("small", [False, True])
def test_ranks_equal_brute_force(spark, documents, rows, small, monkeypatch):
    if small:  # blocks of a few items, parts of a few documents
        monkeypatch.setattr(ranking, "BLOCK_ITEMS", 9)
    docs, items = frames(spark, documents, rows)
    got = ranking.search(docs, items, block_bytes=500 if small else ranking.BLOCK_BYTES)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(*rows)


def test_other_depths(spark, documents, rows):
    docs, items = frames(spark, documents, rows)
    assert sorted(map(tuple, ranking.search(docs, items, top=3).collect()), key=repr) == \
        brute_force(*rows, top=3)


def test_visits_stop_at_the_bound(monkeypatch):
    import pyarrow as pa
    vocabulary = ranking.Vocabulary(["a b"])
    weights = np.array([1000, 10], np.int64)

    def part(m, *tfs):
        held = np.array([t for t, _ in tfs], np.int64)
        return ranking.Part(m, pa.array(range(m, m + len(tfs))), held,
                            np.array([f for _, f in tfs], np.int64), np.arange(len(tfs)), weights)
    parts = [part(90, (1, 5)), part(30, (0, 3), (0, 2)), part(50, (0, 9), (0, 8), (0, 7))]
    seen = []
    scores = ranking.Part.scores
    monkeypatch.setattr(ranking.Part, "scores", lambda self, *a: seen.append(self) or scores(self, *a))
    best = [[]]
    ranking.best_rows(parts, vocabulary, 2, 2, best)
    # the highest bound is visited first; its two best are above all other bounds
    assert seen == [parts[2]] and [r[2] for r in best[0]] == [50, 51]
    seen.clear()
    ranking.best_rows(parts, vocabulary, 2, 4, wide := [[]])
    assert seen == [parts[2], parts[1]] and [r[2] for r in wide[0]] == [50, 51, 52, 30]


def test_empty_tables(spark, documents, rows):
    docs, items = frames(spark, documents, rows)
    assert ranking.search(documents([]), items).collect() == []
    assert ranking.search(docs, items.limit(0)).collect() == []


def test_query_columns(spark, documents, rows, monkeypatch):
    docs, items = frames(spark, documents, rows)
    monkeypatch.setattr(queries, "table", lambda s, d, name: items if name == "benchmark" else docs)
    assert queries.op12_ranked_search(spark, "").dtypes == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
