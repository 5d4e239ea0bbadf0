"""Exact and near duplicates, and components, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from laketier.llm import simhash
from laketier.llm.components import connected_components
from laketier.llm.exact_dedup import exact_duplicates
from laketier.llm.simhash import near_duplicates


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        least = min((x for x in ids if x is not None), default=None)
        out.append((i, least, len(ids), i == least, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture()
def rows(words):
    base = [words(n) for n in (1, 3, 40, 400, 3000)]
    return [(1, base[0]), (2, base[1]), (3, base[2]), (4, base[3]), (5, base[4]),
            (16, base[2].replace(" ", "\n\t")), (17, base[2] + " "), (18, base[2]), (9, base[3]),
            (10, base[4][:-1] + "§"), (11, base[4]), (12, None), (13, ""), (14, " "), (15, "\n "),
            (None, base[0]), (None, "alone"), (None, "alone"), (20, "again"), (20, "again"),
            (21, "z" * 20_000), (22, "z" * 20_000), (23, "z" * 20_001), (24, " "), (25, "é")]


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda c: F.xxhash64(c) % 3],
                         ids=["whole", "colliding"])
def test_exact_duplicates_equal_brute_force(documents, rows, fingerprint):
    got = exact_duplicates(documents(rows), fingerprint).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(rows)


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_fingerprints_use_the_hash_of_the_engine(spark, documents, words):
    texts = [(1, "one Two three"), (2, "Ä b")]
    got = {r.doc_id: r.fingerprint for r in near_duplicates(documents(texts)).collect()}
    want = spark.createDataFrame([(1, "one two three"), (2, "Ä b")], "i int, t string").select(
        "i", F.lower(F.hex(F.xxhash64("t")))).collect()
    assert got == {r[0]: r[1].zfill(16) for r in want}


def test_near_duplicates_equal_brute_force(documents, words):
    r = random.Random(3)
    rows, texts = [], [words(n) for n in (30, 60, 200, 2000)]
    for i in range(120):
        w = r.choice(texts).split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = words(1)
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"),
             (None, rows[0][1]), (505, rows[1][1]), (505, rows[1][1])]
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    want = sorted(((i, f"{prints[a]:016x}", least[find(a)]) for a, (i, _) in enumerate(rows)), key=str)
    got = near_duplicates(documents(rows)).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert len({c for _, _, c in want}) < len(rows) - 20
    assert near_duplicates(documents(rows).where("doc_id < 0")).collect() == []


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [64, 3])
def test_links_connect_what_brute_force_connects(max_bits, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = np.random.default_rng(max_bits)
    seen = [int(x) for x in r.integers(0, 2**63, 12)]
    for _ in range(150):
        x = seen[r.integers(0, len(seen))]
        for _ in range(r.integers(1, 4)):
            x ^= 1 << int(r.integers(0, 64 if len(seen) % 2 else 8))
        seen.append(x)
    prints = np.array(sorted(set(seen)), np.uint64)
    points, owner = simhash.grid_points(prints, max_bits)
    order = np.lexsort((owner, points))
    found, want = simhash.Forest(), simhash.Forest()
    for a, b in simhash.links_at_points(points[order], owner[order], max_bits):
        found.link(a, b)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= max_bits).tolist():
            want.link(int(prints[i]), int(prints[i + 1 + j]))
    assert all(found.find(int(x)) == want.find(int(x)) for x in prints)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201),
                                                                                   (201, 200)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []
