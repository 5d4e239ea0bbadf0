"""Operator 4: token ids in a binary format with random access.

``write_tokens`` sorts documents by id across the cluster (range partitioning, one
shuffle of the texts), tokenises each sorted run and writes segments: a DAC image
(``dac.py``) with the ids of whole documents and the document directory. Spark's
own writer commits them, so a lost executor or a second attempt of a task leaves
no partial file. Places are kept relative to the shard (the sorted partition); the
start of each shard is the sum of those before it, one number per partition.

Defined cases: a NULL text is empty; an empty text has the end id alone; documents
with a NULL id come first; rows that share an id are kept as rows of their own,
ordered by a hash of the text; an empty table gives no segments and no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm import dac
from laketier.llm.common import crc32, scratch_path, ship_package, task
from laketier.llm.tokens import END_ID, Encoder, slices, vocabulary_path

SEGMENT_TOKENS = 1 << 20
SEGMENTS = ("shard int, segment int, shard_start bigint, n_tokens bigint, "
            "doc_ids array<bigint>, sizes array<bigint>, image binary")


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID
             ) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds with ``end_id`` after every document."""
    bounds = bounds + np.arange(len(bounds))
    out = np.full(int(bounds[-1]), end_id, np.uint32)
    inside = np.ones(len(out), bool)
    inside[bounds[1:] - 1] = False
    out[inside] = ids
    return out, bounds


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write the ids of all texts (each followed by the end id) below ``path``."""
    vocabulary = vocabulary or vocabulary_path()
    ship_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of(vocabulary), TaskContext.get().partitionId()
        doc_ids, sizes, held = [], [], []
        segment, start = 0, 0

        def close():
            nonlocal segment, start
            ids = np.concatenate(held)
            batch = pa.RecordBatch.from_pylist([{
                "shard": shard, "segment": segment, "shard_start": start, "n_tokens": len(ids),
                "doc_ids": doc_ids, "sizes": sizes, "image": dac.encode(ids)}], SCHEMA)
            segment, start = segment + 1, start + len(ids)
            doc_ids.clear(), sizes.clear(), held.clear()
            return batch

        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = with_end(*encoder.encode(part.column("text")))
                first = 0
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    doc_ids.append(doc_id)
                    sizes.append(int(bounds[i + 1] - bounds[i]))
                    if sum_tokens(held) + bounds[i + 1] - bounds[first] >= segment_tokens:
                        held.append(ids[bounds[first]:bounds[i + 1]])
                        first = i + 1
                        yield close()
                if first < part.num_rows:
                    held.append(ids[bounds[first]:])
        if held:
            yield close()
        encoder.forget()

    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
     .repartitionByRange("doc_id", F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(task(encode), SEGMENTS).write.parquet(path))


SCHEMA = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()),
                    ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("sizes", pa.list_(pa.int64())), ("image", pa.binary())])


def sum_tokens(held: list[np.ndarray]) -> int:
    return sum(map(len, held))


def read_segments(spark, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids before them in the whole store.

    The driver handles one number per shard, that is per partition of the writer.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    starts = accumulate((r.n for r in totals), initial=0)
    offsets = spark.createDataFrame([(r.shard, s) for r, s in zip(totals, starts)],
                                    "shard int, before bigint")
    return (segments.join(F.broadcast(offsets), "shard")
            .withColumn("start", F.col("before") + F.col("shard_start")).drop("before"))


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, sizes = dac.Reader(row["image"]), row["sizes"]
                at = list(accumulate(sizes, initial=0))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array([row["start"] + a for a in at[:-1]], pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array([crc32(reader.range(a, a + n).astype("<u4").tobytes())
                                           for a, n in zip(at, sizes)], pa.int64())})

    return (read_segments(spark, path).select("start", "doc_ids", "sizes", "image")
            .mapInArrow(task(decode), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def token_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the store in the shared folder and report every document from its files."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_documents(docs.sparkSession, path)
