"""Operator 5: packing token ids into sequences with non-negative least squares.

Each worker tokenises its partition in groups of about ``GROUP_TOKENS`` ids (its
bound on memory). Full windows of a long document become sequences of their own;
what remains of each document is a length below the window. For those lengths,
shallow combinations (two or three lengths that fill a window exactly) are
enumerated, their repeat counts solved against the histogram of lengths by
non-negative least squares, rounded and taken out; the residual documents are
packed greedily, longest first, cutting a document where a window ends. Only the
last sequence of a group can be short.

Sequences are numbered over the whole result by adding, to the number inside the
partition, the sequences of the partitions before it (one number each).

Defined cases: a NULL text is empty; an empty text is its end id alone, one piece of
length 1; rows with NULL or repeated ids are documents of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import crc32, ship_package, staged, task
from laketier.llm.token_files import with_end
from laketier.llm.tokens import Encoder, slices, vocabulary_path

WINDOW = 2048
GROUP_TOKENS = 6_000_000
# Triples are enumerated for so many of the commonest lengths as their shortest member.
TRIPLE_LENGTHS = 64
SOLVER_STEPS = 150

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "shard int, local_sequence bigint, offset bigint")


def combinations(histogram: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to the window, from lengths present.

    ``histogram[l]`` is the number of documents of length l, for l below the window.
    """
    window = len(histogram)
    have = np.flatnonzero(histogram)
    have = have[have > 0]
    pairs = have[(histogram[window - have] > 0) & (2 * have <= window)]
    rows = [np.stack([pairs, window - pairs, 0 * pairs], 1)]
    common = have[np.argsort(-histogram[have], kind="stable")][:TRIPLE_LENGTHS]
    for a in np.sort(common):
        b = have[have >= a]
        c = window - a - b
        b, c = b[c >= b], c[c >= b]
        b, c = b[histogram[c] > 0], c[histogram[c] > 0]
        rows.append(np.stack([np.full(len(b), a), b, c], 1))
    return np.concatenate(rows)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = SOLVER_STEPS
                  ) -> np.ndarray:
    """Non-negative least squares: x >= 0 that minimises |A x - histogram|, where
    column j of A counts the lengths of combination j. Multiplicative updates keep x
    non-negative and lower the residual at every step."""
    window = len(histogram)
    real = (combos > 0).astype(float)
    target = (histogram[combos] * real).sum(1)
    x = target / real.sum(1) / max(1.0, len(combos) / max(1, np.count_nonzero(histogram)))
    for _ in range(steps):
        used = np.bincount(combos.ravel(), (real * x[:, None]).ravel(), minlength=window)
        x = x * target / np.maximum((used[combos] * real).sum(1), 1e-12)
    return x


def pack(lengths: np.ndarray, window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of documents with these
    lengths (each at least 1), and the number of sequences."""
    pieces, sequence = [], 0
    rest = lengths % window
    for i, n in enumerate((lengths // window).tolist()):
        for k in range(n):
            pieces.append((i, k * window, window, sequence, 0))
            sequence += 1
    order = np.argsort(rest, kind="stable")
    histogram = np.bincount(rest, minlength=window)
    histogram[0] = 0
    last = np.cumsum(np.bincount(rest, minlength=window))  # in order, past each length's documents
    left = histogram.copy()

    def take(length: int) -> int:
        left[length] -= 1
        return int(order[last[length] - 1 - left[length]])

    begin = lengths - rest
    if histogram.any():
        combos = combinations(histogram)
        counts = repeat_counts(combos, histogram) if len(combos) else np.zeros(0)
        for j in np.argsort(-counts, kind="stable"):
            times = int(counts[j] + 0.5)
            if not times:
                break
            members = [int(x) for x in combos[j] if x]
            while times and all(left[m] >= members.count(m) for m in members):
                offset = 0
                for m in members:
                    i = take(m)
                    pieces.append((i, int(begin[i]), m, sequence, offset))
                    offset += m
                sequence += 1
                times -= 1
    filled = 0
    for length in range(window - 1, 0, -1):
        for _ in range(int(left[length])):
            i = take(length)
            start, rest_of = int(begin[i]), length
            while rest_of:
                n = min(rest_of, window - filled)
                pieces.append((i, start, n, sequence, filled))
                start, rest_of, filled = start + n, rest_of - n, filled + n
                if filled == window:
                    sequence, filled = sequence + 1, 0
    return pieces, sequence + (filled > 0)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    vocabulary = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(vocabulary), TaskContext.get().partitionId()
        doc_ids, held, held_tokens, sequences = [], [], 0, 0

        def close():
            nonlocal held_tokens, sequences
            lengths = np.concatenate([np.diff(b) for _, b in held])
            ids = np.concatenate([i for i, _ in held])
            at = np.cumsum(lengths) - lengths
            pieces, n = pack(lengths, window)
            doc, start, length, sequence, offset = np.array(pieces, np.int64).T
            data, first = memoryview(ids.astype("<u4")).cast("B"), at[doc] + start
            crc = [crc32(data[4 * a:4 * (a + m)]) for a, m in zip(first.tolist(), length.tolist())]
            batch = pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, pa.int64()).take(pa.array(doc)),
                "start": start, "length": length, "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": lengths[doc], "shard": np.full(len(doc), shard, np.int32),
                "local_sequence": sequence + sequences, "offset": offset})
            sequences += n
            doc_ids.clear(), held.clear()
            held_tokens = 0
            return batch

        for batch in batches:
            for part in slices(batch, "text"):
                held.append(with_end(*encoder.encode(part.column("text"))))
                doc_ids += part.column("doc_id").to_pylist()
                held_tokens += len(held[-1][0])
                if held_tokens >= group_tokens:
                    yield close()
        if held:
            yield close()
        encoder.forget()

    pieces = staged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
                    .mapInArrow(task(run), PIECES), "pieces")
    used = pieces.groupBy("shard").agg(F.max("local_sequence").alias("n")).orderBy("shard").collect()
    starts = accumulate((r.n + 1 for r in used), initial=0)
    offsets = spark.createDataFrame([(r.shard, s) for r, s in zip(used, starts)],
                                    "shard int, before bigint")
    return pieces.join(F.broadcast(offsets), "shard").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("before") + F.col("local_sequence")).alias("sequence_id"), "offset")
