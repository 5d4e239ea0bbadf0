"""Operator 6: repeated byte strings by longest-previous-factor arrays.

Every byte covered by a string of ``min_bytes`` that also starts elsewhere is found,
over all documents, without ever sorting all suffixes in one place:

1. Each window of ``min_bytes`` bytes is represented by its minimizer, the place of
   the smallest hash of ``SEED_BYTES`` bytes in it. Equal windows have the same
   minimizer at the same offset. Neighbouring windows share theirs, so a document is
   a list of runs of windows (about one per 185 bytes): seed hash, hash of the run's
   whole text, first and last window.
2. Runs are counted by (seed, text), two independent 64-bit hashes: a run that occurs
   again is repeated in full (its bytes are not compared; among 10^12 runs, 600 TB, two
   that differ agree in both with a chance of 10^-15). A seed with several texts needs a
   closer look, at one example of each.
3. The texts of those runs are brought together by seed. Their windows are put in suffix
   order (prefix doubling); the previous and next smaller positions in that order give
   each window's longest previous factor and where it starts. Windows whose factor is a
   whole window are later copies, and their sources are earlier ones.
4. A seed with more than ``CROWD`` texts is not brought together. Its runs are cut by
   the windows' offset from the minimizer into narrower runs (``WIDTHS``), whose seed is
   the text common to all windows of such a cut; equal windows share it. These are
   counted in turn, from step 2 on, down to single windows, which need no closer look.
   Each cut narrows the search to where the texts differ, so it makes few rows.

``keep="none"`` removes every copy, ``keep="first"`` leaves the first one (smallest
id, then place). Rows are identified by id and text hash: rows equal in both are
copies of each other with the same result.

Defined cases: NULL and empty texts have no bytes (hash of nothing); texts shorter
than ``min_bytes`` stay as they are; matches never cross documents; rows that share
an id are documents of their own, and so are rows with NULL ids; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import ship_package, staged, task
from laketier.llm.tokens import slices

MIN_BYTES = 400
SEED_BYTES = 32
CROWD = 256
WIDTHS = (48, 8, 1)
#: Documents with repeats up to this number (24 bytes each) are told apart from the
#: rest by broadcast before their texts move; beyond it, by a shuffle join.
BROADCAST_KEYS = 500_000
PIECE = 1 << 22  # bytes of a text looked at at once; places within fit in 24 bits
RUNS = "s array<int>, e array<int>, p array<int>, k array<bigint>, r array<bigint>"
KEY = ["id", "h"]
MIX = np.uint64(0x9E3779B97F4A7C15)


def seed_hashes(data: np.ndarray, width: int = SEED_BYTES) -> np.ndarray:
    """A 64-bit hash of the ``width`` (a power of two) bytes from each place on."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX
    h ^= h >> np.uint64(29)
    step = 1
    while step < width:
        h = (h[:-step] * np.uint64(0xBF58476D1CE4E5B9 + 2 * step)) + h[step:]
        h ^= h >> np.uint64(31)
        step *= 2
    return h * MIX


def _runs_of_piece(data: np.ndarray, min_bytes: int):
    """First window, last window, seed hash of each run of windows of one piece."""
    h = seed_hashes(data)
    places = np.arange(len(h), dtype=np.uint64)
    least = h >> np.uint64(24) << np.uint64(24) | places
    span = min_bytes - SEED_BYTES + 1  # seeds in a window
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:-(span - width)], least[span - width:])
    at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.append(first[1:], len(at)) - 1, h[at[first]], at[first]


def runs(data: bytes, min_bytes: int = MIN_BYTES):
    """Arrays (first window, last window, seed hash, minimizer) of a text's runs.

    Long texts are looked at in overlapping pieces; a run cut by a piece's end is two
    runs with the same seed, which step 3 of the method treats alike.
    """
    out = []
    everything = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(data) - min_bytes + 1), PIECE):
        piece = everything[at:at + PIECE + min_bytes - 1]
        first, last, seed, place = _runs_of_piece(piece, min_bytes)
        out.append((first + at, last + at, seed, place + at))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    return tuple(np.concatenate(x) for x in zip(*out))


def _hash64(data) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _ranked(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    sorted_ = values[order]
    out = np.empty(len(values), np.uint32)
    out[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])[:len(values)]
    return out


def _joined(parts: list[np.ndarray], bits: int) -> np.ndarray:
    """Ranks of ``bits`` bits side by side."""
    out = parts[0].astype(np.uint64)
    for part in parts[1:]:
        out = out << np.uint64(bits) | part
    return out


class SuffixOrder:
    """Suffix order of the ``length`` (8 at least) bytes from each start on: by prefix
    doubling, or three or four times the width where so many ranks fit in 64 bits. The
    ranks of every width passed on the way stay, for lengths of common prefixes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, length: int):
        n = len(data)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.head = np.zeros(n, np.uint64)  # the next eight bytes
        for i in range(8):
            self.head = self.head << np.uint64(8) | padded[i:i + n]
        self.starts, self.length = starts, length
        self.widths = [(8, _ranked(self.head))]
        while True:
            width, rank = self.widths[-1]
            bits = max(1, int(rank.max()).bit_length())
            times = min(4, 64 // bits)
            if times * width >= length:  # last round: the windows alone
                places = sorted({min(i * width, length - width) for i in range(times)})
                self.ranks = _ranked(_joined([rank[starts + p] for p in places], bits))
                return
            further = np.concatenate([rank, np.zeros(times * width, np.uint32)])
            self.widths.append((times * width, _ranked(_joined(
                [further[i * width:i * width + n] for i in range(times)], bits))))

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common bytes of the windows numbered ``a`` and ``b``, up to ``length``."""
        a, b, last = self.starts[a], self.starts[b], len(self.head) - 1
        found, left = np.zeros(len(a), np.int64), self.length  # bytes that may still agree
        for width, rank in reversed(self.widths):
            for _ in range(left // width):
                same = rank[np.minimum(a + found, last)] == rank[np.minimum(b + found, last)]
                found += width * same
            left = width - 1
        differ = (self.head[np.minimum(a + found, last)]
                  ^ self.head[np.minimum(b + found, last)])
        for bits in range(8, 64, 8):  # bytes that agree before the first that does not
            found += differ < np.uint64(1 << (64 - bits))
        return np.minimum(found, self.length)


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1."""
    near = np.arange(len(values)) - 1
    open_ = np.arange(len(values))
    for _ in range(40):  # what lies between a place and its candidate is never smaller
        open_ = open_[near[open_] >= 0]
        open_ = open_[values[near[open_]] > values[open_]]
        near[open_] = near[near[open_]]
    for i in open_.tolist():  # the few behind long rising stretches, one after the other
        at = near[i]
        while at >= 0 and values[at] > values[i]:
            at = near[at]
        near[i] = at
    return near


def longest_previous_factors(suffixes: SuffixOrder) -> tuple[np.ndarray, np.ndarray]:
    """The longest previous factor of each window (the most bytes, up to the window's
    length, that it has in common with an earlier one), and the number of the earlier one
    (-1: none). Windows are numbered by position.

    The earlier windows with most in common are, in suffix order (equal strings by
    position), the nearest of smaller position before and behind.
    """
    n = len(suffixes.ranks)
    order = np.lexsort((np.arange(n), suffixes.ranks))
    behind = n - 1 - previous_smaller(order[::-1])[::-1]  # n: none
    factor, source = np.zeros(n, np.int64), np.full(n, -1)
    for near in (previous_smaller(order), behind):
        at = np.flatnonzero((near >= 0) & (near < n))
        here, there = order[at], order[near[at]]
        common = suffixes.common_prefix(here, there)
        more = common > factor[here]
        factor[here[more]], source[here[more]] = common[more], there[more]
    return factor, source


def copies(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each window has an equal one anywhere, and whether an earlier one: those
    whose longest previous factor is the whole window, and the sources of such ones."""
    factor, source = longest_previous_factors(SuffixOrder(data, starts, length))
    later = factor == length
    either = later.copy()
    either[source[later]] = True
    return either, later


def spans_of(flags: np.ndarray, min_bytes: int) -> list[tuple[int, int]]:
    """Byte intervals covered by the flagged windows, one per stretch of windows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(a, b - 1 + min_bytes) for a, b in edge.reshape(-1, 2).tolist()]


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


SPAN_FIELDS = [("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in SPAN_FIELDS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, SPAN_FIELDS)],
                                      [n for n, _ in SPAN_FIELDS])


def document_runs(docs: DataFrame, min_bytes: int) -> DataFrame:
    """Per row: id, h, doc_id, n_bytes, sha256 of the text, and its runs as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                size, sha, s, e, p, k, r = [], [], [], [], [], [], []
                for text in part.column("text"):
                    data = (text.as_py() or "").encode("utf-8", "replace")
                    first, last, seed, place = runs(data, min_bytes)
                    view = memoryview(data)
                    size.append(len(data))
                    sha.append(hashlib.sha256(data).hexdigest())
                    s.append(first)
                    e.append(last)
                    p.append(place)
                    k.append(seed.view(np.int64))
                    r.append([_hash64(view[a:b + min_bytes])
                              for a, b in zip(first.tolist(), last.tolist())])
                lists = [pa.array(x, pa.list_(t)) for x, t in
                         ((s, pa.int32()), (e, pa.int32()), (p, pa.int32()), (k, pa.int64()),
                          (r, pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("id", "h", "doc_id")] +
                    [pa.array(size, pa.int64()), pa.array(sha)] + lists,
                    ["id", "h", "doc_id", "n_bytes", "sha", "s", "e", "p", "k", "r"])

    return docs.mapInArrow(task(run), f"id bigint, h bigint, doc_id bigint, n_bytes bigint, sha string, {RUNS}")


def run_texts(texts: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the runs listed in ``wanted`` of each text, by seed."""
    schema = pa.schema([("k", pa.int64()), ("id", pa.int64()), ("h", pa.int64()),
                        ("s", pa.int64()), ("e", pa.int64()), ("p", pa.int64()),
                        ("crowded", pa.bool_()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = row["text"].encode("utf-8", "replace")
                yield pa.RecordBatch.from_pylist(
                    [{"k": w["k"], "id": row["id"], "h": row["h"], "s": w["s"], "e": w["e"],
                      "p": w["p"], "crowded": w["crowded"], "data": data[w["s"]:w["e"] + min_bytes]}
                     for w in row["wanted"]], schema)

    return texts.mapInArrow(task(run), "k bigint, id bigint, h bigint, s bigint, e bigint, "
                                 "p bigint, crowded boolean, data binary")


def compared(contexts: DataFrame, min_bytes: int, keep_first: bool) -> DataFrame:
    """Spans repeated among the runs of each seed."""
    group_bytes = 1 << 21

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[2], r[3]))  # id, h, first window: order of positions
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        count = np.array([r[4] - r[3] + 1 for r in rows])
        begin = np.cumsum([0, *(len(r[5]) for r in rows[:-1])])
        before = np.cumsum(count) - count
        starts = np.repeat(begin - before, count) + np.arange(count.sum())
        found = copies(data, starts, min_bytes)[int(keep_first)]
        out = []
        for i in np.flatnonzero(np.add.reduceat(found, before)).tolist():
            _, doc, h, s, _, _ = rows[i]
            out += [(doc, h, s + a, s + b) for a, b in
                    spans_of(found[before[i]:before[i] + count[i]], min_bytes)]
        return _span_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != held[-1][0] and size >= group_bytes:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield spans(held)

    return (contexts.select("k", "id", "h", "s", "e", "data")
            .repartition("k").sortWithinPartitions("k")
            .mapInArrow(task(run), "id bigint, h bigint, start bigint, stop bigint"))


def cut_finer(contexts: DataFrame, min_bytes: int, width: int) -> DataFrame:
    """The runs cut where the offset from the minimizer is a multiple of ``width``. The
    seed of a cut is what all its windows would have in common were it whole, so it does
    not depend on where the run ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, doc, h, s, e, p, data in zip(*(c.to_pylist() for c in batch.columns)):
                view = memoryview(data)
                for u in range((p - e) // width, (p - s) // width + 1):
                    a, b = max(s, p - u * width - width + 1), min(e, p - u * width)
                    core = p - u * width - s, p - u * width - width + 1 + min_bytes - s
                    out.append((doc, h, a, b, p,
                                _hash64(b"%d %d " % (k, u) + data[max(0, core[0]):core[1]]),
                                _hash64(view[a - s:b + min_bytes - s])))
            columns = list(zip(*out)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             ["id", "h", "s", "e", "p", "k", "r"])

    return contexts.select("k", *KEY, "s", "e", "p", "data").mapInArrow(
        task(run), "id bigint, h bigint, s bigint, e bigint, p bigint, k bigint, r bigint")


def repeated_spans(docs: DataFrame, runs_: DataFrame, min_bytes: int, keep_first: bool,
                   widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(id, h, start, stop) of bytes repeated in the windows of ``runs_`` (id, h, s, e, p,
    k, r: first and last window, minimizer, seed, hash of the text); spans may overlap or
    repeat."""
    texts = staged(runs_.groupBy("k", "r").agg(F.count("*").alias("n")), "texts")
    seeds = staged(texts.groupBy("k").agg(F.sum("n").alias("runs"), F.count("*").alias("texts"))
                   .where("runs > 1"), "seeds")
    status = staged(texts.join(seeds, "k").select("k", "r", "n", "texts"), "status")
    marked = staged(runs_.join(status, ["k", "r"]), "marked")
    example = staged(marked.where("n > 1").groupBy("k", "r")
                     .agg(F.min(F.struct("id", "h", "s", "e", "p")).alias("one"),
                          F.first("texts").alias("texts")), "examples")
    full = marked.where("n > 1")
    if keep_first:
        full = full.join(example.select("k", "r", "one"), ["k", "r"]).where(
            F.struct("id", "h", "s") != F.struct("one.id", "one.h", "one.s"))
    full = full.select(*KEY, F.col("s").cast("bigint").alias("start"),
                       (F.col("e") + F.lit(min_bytes)).cast("bigint").alias("stop"))
    place = ["s", "e", "p"]
    look = (marked.where("n = 1 and texts > 1").select(*KEY, "k", *place, "texts")
            .unionByName(example.where("texts > 1").select("one.id", "one.h", "k", "one.s", "one.e",
                                                           "one.p", "texts")))
    wanted = staged(look.groupBy(*KEY).agg(F.collect_list(F.struct(
        "k", *place, (F.col("texts") > CROWD).alias("crowded"))).alias("wanted")), "wanted")
    # rows equal in id and text have the same runs: one of them is enough
    contexts = staged(run_texts(
        with_texts(docs, wanted).dropDuplicates(KEY).select(*KEY, "text", "wanted"),
        min_bytes), "contexts")
    spans = full.unionByName(compared(contexts.where(~F.col("crowded")), min_bytes, keep_first))
    crowded = contexts.where("crowded")
    if widths and not crowded.isEmpty():
        finer = staged(cut_finer(crowded, min_bytes, widths[0]), "finer")
        spans = spans.unionByName(
            repeated_spans(docs, finer, min_bytes, keep_first, widths[1:]))
    return spans


def with_texts(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is in the staged ``listed``, with its columns."""
    if listed.count() <= BROADCAST_KEYS:
        docs = docs.join(F.broadcast(listed.select(*KEY)), KEY, "left_semi")
    return docs.join(listed, KEY)


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans for every row."""
    ship_package(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    docs = docs.select(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64("text").alias("h"), doc_id.alias("doc_id"), F.col("text"))
    known = staged(document_runs(docs, min_bytes), "runs")
    runs_ = known.select(*KEY, F.explode(F.arrays_zip("s", "e", "p", "k", "r")).alias("run")
                         ).select(*KEY, "run.*")
    spans = repeated_spans(docs, runs_, min_bytes, keep == "first")
    listed = staged(spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "stop")).alias("spans")),
                    "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                data, at, sha = text.encode("utf-8", "replace"), 0, hashlib.sha256()
                whole = merged([(x["start"], x["stop"]) for x in found])
                for a, b in [*whole, [len(data), len(data)]]:
                    sha.update(memoryview(data)[at:a])
                    at = b
                out.append({"doc_id": doc, "n_bytes": len(data),
                            "n_removed": sum(b - a for a, b in whole), "n_spans": len(whole),
                            "kept_sha256": sha.hexdigest(), "spans": whole})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.list_(pa.int64())))])
    changed = with_texts(docs, listed).select("doc_id", "text", "spans").mapInArrow(
        task(cut), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "spans array<array<bigint>>")
    same = known.join(listed.select(*KEY), KEY, "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.col("sha").alias("kept_sha256"),
        F.array().cast("array<array<bigint>>").alias("spans"))
    return same.unionByName(changed)
