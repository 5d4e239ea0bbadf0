"""Operator 10: SimHash near-duplicates by segment-popcount embedding.

A fingerprint is mapped to the number of ones in each of its 32 two-bit segments, a
point of a grid. The Manhattan distance of two points is never more than the number
of differing bits, so fingerprints within ``max_bits`` lie within that distance, and
each of them reaches a common grid point in half as many steps. Every distinct
fingerprint goes to the points within half the distance; those that meet at a point
are compared exactly (exclusive or, ones counted), and of the links found at a point
a spanning forest is kept, not all pairs.

A point where more than ``CROWD`` fingerprints meet is cut finer in the same way, by
one-bit segments, whose points hold at most ``bits + 1`` fingerprints for distance
two; nothing is dropped.

Copies share a fingerprint, which is one node however many documents have it; the
documents are joined to its component by a join that Spark can split.

Defined cases: NULL and empty texts, and texts of blanks alone, have fingerprint
zero and are linked like any other; texts of fewer words than a shingle are one
shingle; rows that share an id are documents of their own; NULL ids never name a
component unless all its ids are NULL; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import ascii_words, ship_package, staged, task
from laketier.llm.components import connected_components
from laketier.llm.tokens import slices

SHINGLE, MAX_BITS, SEED = 3, 2, 42
CROWD = 64
EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the shingles, repeats included."""
    from xxhash import xxh64_intdigest as xxh64
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        hashes = [xxh64(text, SEED)]
    else:
        starts = [0, *(ends[:-shingle] + 1).tolist()]
        hashes = [xxh64(text[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    ones, rows = np.zeros(64, np.int64), np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for k in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[k:k + (1 << 15)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(((2 * ones > len(rows)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def _pairs(prints: np.ndarray) -> np.ndarray:
    """Ones per two-bit segment, each count in the segment's own two bits."""
    return (prints & EVEN) + (prints >> ONE & EVEN)


def _steps(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points and all their neighbours on the grid, with their owners."""
    out, own = [points], [owner]
    for k in range(0, 64, 2):
        unit = np.uint64(1 << k)
        count = points >> np.uint64(k) & np.uint64(3)
        for ok, moved in ((count < 2, points + unit), (count > 0, points - unit)):
            out.append(moved[ok])
            own.append(owner[ok])
    return np.concatenate(out), np.concatenate(own)


def grid_points(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, fingerprint) for the points within half of ``max_bits`` steps."""
    points, owner = _pairs(prints), prints
    for _ in range((max_bits + 1) // 2):
        points, owner = _steps(points, owner)
        if max_bits > 2:
            points, owner = np.unique(np.stack([points, owner]), axis=1)
    return points, owner


class Forest:
    """Union-find over fingerprints; roots are the smallest."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def link(self, a: int, b: int):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in self.parent]


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def _meet(prints: np.ndarray, max_bits: int, forest: Forest):
    """Link the distinct fingerprints of one crowded point by one-bit segments."""
    if max_bits > 2:  # rows of a block against the rest: exact for any distance
        for i in range(len(prints)):
            for j in np.flatnonzero(_close(prints[i + 1:], prints[i], max_bits)).tolist():
                forest.link(int(prints[i]), int(prints[i + 1 + j]))
        return
    owner = np.tile(prints, 65)
    points = np.concatenate([prints, *(prints ^ np.uint64(1 << k) for k in range(64))])
    order = np.argsort(points, kind="stable")
    points, owner = points[order], owner[order]
    same = np.flatnonzero(points[1:] == points[:-1])
    ok = _close(owner[same], owner[same + 1], max_bits)
    for a, b in zip(owner[same[ok]].tolist(), owner[same[ok] + 1].tolist()):
        forest.link(a, b)


def links_at_points(points: np.ndarray, prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints that meet at a point, given
    in the order of the points (and of the fingerprints at a point, each once)."""
    start = np.flatnonzero(np.concatenate([[True], points[1:] != points[:-1]]))
    size = np.diff(np.append(start, len(points)))
    forest = Forest()
    for at, n in zip(start[size > CROWD].tolist(), size[size > CROWD].tolist()):
        _meet(prints[at:at + n], max_bits, forest)
    calm = np.repeat((size > 1) & (size <= CROWD), size)
    points, prints = points[calm], prints[calm]
    for lag in range(1, CROWD):
        near = np.flatnonzero(points[lag:] == points[:-lag])
        if not len(near):
            break
        ok = near[_close(prints[near], prints[near + lag], max_bits)]
        for a, b in zip(prints[ok].tolist(), prints[ok + lag].tolist()):
            forest.link(a, b)
    return forest.edges()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, print (the 64 bits as a bigint) for every row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [fingerprint(ascii_words(t.as_py()), shingle) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.array(made, np.uint64).view(np.int64))],
                    ["doc_id", "print"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
            .mapInArrow(task(run), "doc_id bigint, print bigint"))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints ``print`` that a
    chain of links with at most ``max_bits`` differing bits connects."""
    ship_package(prints.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("print").to_numpy().view(np.uint64)
            for k in range(0, len(found), 20_000):
                point, owner = grid_points(found[k:k + 20_000], max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(point.view(np.int64)), pa.array(owner.view(np.int64))],
                    ["point", "print"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), np.int64)

        def found(rows):
            edges = links_at_points(rows[0].view(np.uint64), rows[1].view(np.uint64), max_bits)
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()),
                                               pa.array(ends[:, 1].copy())], ["u", "v"])

        for batch in batches:
            rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            held = np.concatenate([held, rows], axis=1)
            # the last point may go on in the next batch
            whole = int(np.searchsorted(-(held[0] != held[0][-1]).astype(int), 0)) if held.size else 0
            if whole:
                yield found(np.ascontiguousarray(held[:, :whole]))
                held = held[:, whole:]
        if held.size:
            yield found(np.ascontiguousarray(held))

    return (prints.mapInArrow(task(spread), "point bigint, print bigint")
            .repartition("point").sortWithinPartitions("point", "print")
            .mapInArrow(task(meet), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    made = staged(fingerprints(docs, shingle), "prints")
    distinct = staged(made.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct")
    found = connected_components(links(distinct.select("print"), max_bits))
    labelled = staged(
        distinct.join(found.withColumnRenamed("node", "print"), "print", "left")
        .select("print", "first", F.coalesce("component", "print").alias("component")), "labelled")
    names = staged(labelled.groupBy("component").agg(F.min("first").alias("component_id")), "names")
    members = staged(labelled.join(names, "component").select("print", "component_id"), "members")
    return made.join(members, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
