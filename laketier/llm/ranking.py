"""Operator 12: ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone, so documents of one m form a
stratum, in which a term's impact depends on tf alone and is computed once for each tf.
The index is the documents' postings, dealt by range of m (and a salt, so that one
length that many documents share is several parts): a task holds whole strata or parts
of one, and sorts each part's postings by term. The greatest tf of each term in a part
bounds the score that any of its documents can have for an item. For each item a task
visits its parts in order of that bound and stops when it is below the item's k-th best
score so far; what is left is k rows an item and task, ranked by Spark.

Items are searched in blocks of bounded text (``BLOCK_ITEMS``, ``BLOCK_BYTES``), so what
tasks are told of the items does not grow; each block reads the documents once to count
n and the tf of the block's terms. All arithmetic but the weights' logarithm is 64-bit integers.

Defined cases: items and documents that are NULL, empty or without a term find nothing
and are not found (they do not count in N either); every row of ``items`` is an item of
its own, whatever its id, and every row of ``docs`` a document of its own; equal scores
rank by id, NULL ids last, rows that share score and id in any order; an empty table on
either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laketier.llm.common import scratch_path, ship_package, staged, task
from laketier.llm.tokens import slices
from laketier.llm.units import gathered

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERMS = re.compile(TERM)
TOP = 10
#: Items that are searched at once, and their text.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 1 << 20
#: Parts that a task orders by bound at once, their postings, and those of one part.
GROUP_PARTS, GROUP_POSTINGS, PART_POSTINGS = 512, 1 << 22, 1 << 19
#: 100 * (1 - b) and 100 * b of the normaliser, 1000 * k1 / 100 of the impact.
FLAT, STEEP, GAIN, RISE = 25, 75, 1_000_000_000, 8


def item_terms(text: str | None) -> list[str]:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERMS.findall(lowered)


class Vocabulary:
    """Terms of a block of items, and of each item its terms with their repeats."""

    def __init__(self, texts: list[str | None]):
        found = [Counter(item_terms(t)) for t in texts]
        self.terms = sorted({t for c in found for t in c})
        place = {t: i for i, t in enumerate(self.terms)}
        self.ends = np.cumsum([len(c) for c in found])
        self.held = np.array([place[t] for c in found for t in c], np.int64)
        self.times = np.array([n for c in found for n in c.values()], np.int64)


def blocks_of(items: DataFrame, max_bytes: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items in blocks of at most ``max_bytes`` of text (one item at
    least), read one after the other."""
    ids, texts, held = [], [], 0
    for item, text in items.select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        size = len(text or "")
        if ids and (held + size > max_bytes or len(ids) == BLOCK_ITEMS):
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(item)
        texts.append(text)
        held += size
    if ids:
        yield ids, texts


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), held (places of the block's terms in the document)
    and tf (their occurrences) of every document with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                text = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
                blank = pc.replace_substring_regex(
                    text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
                words = pc.split_pattern(pc.utf8_trim(blank, " "), " ")
                bounds = words.offsets.to_numpy().astype(np.int64)
                flat = words.flatten()
                empty = np.flatnonzero(pc.equal(text_size(blank), 0).to_numpy(zero_copy_only=False))
                n = np.diff(bounds)
                n[empty] = 0  # splitting nothing gives one empty word
                at = pc.index_in(flat, value_set=known)
                place = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
                code = at.take(pa.array(place)).to_numpy().astype(np.int64)
                owner = np.searchsorted(bounds - bounds[0], place, "right") - 1
                entries, tf = np.unique(owner * max(1, len(terms)) + code, return_counts=True)
                ends = np.searchsorted(entries, np.arange(len(n) + 1) * max(1, len(terms)))
                offsets = pa.array(ends, pa.int32())
                out = pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n),
                    pa.ListArray.from_arrays(offsets, pa.array(
                        entries % max(1, len(terms)), pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))],
                    ["doc_id", "n", "held", "tf"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        task(run), "doc_id bigint, n bigint, held array<int>, tf array<bigint>")


def text_size(text: pa.Array) -> pa.Array:
    return pc.binary_length(pc.utf8_trim(text, " "))


class Part:
    """Postings of documents of one stratum: by term, the greatest tf first, then in order
    of id."""

    def __init__(self, m: int, doc_ids: pa.Array, held: np.ndarray, tf: np.ndarray,
                 owner: np.ndarray, weights: np.ndarray):
        order = np.lexsort((owner, -tf, held))
        self.doc_ids, self.owner = doc_ids, owner[order]
        held, tf = held[order], tf[order]
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        self.terms, self.starts = held[first], first
        self.sizes = np.diff(np.append(first, len(held)))
        levels, level = np.unique(tf, return_inverse=True)
        impact = GAIN * levels // (1000 * levels + RISE * m)  # once for each tf
        self.impact = weights[held] * impact[level]
        self.most = self.impact[first]  # of the greatest tf

    def scores(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places) with a score, in order, and their scores for an item."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        found = self.terms[at] == terms
        at, times = at[found], times[found]
        sizes = self.sizes[at]
        places = gathered(self.starts[at], sizes)
        total = np.zeros(len(self.doc_ids), np.int64)
        np.add.at(total, self.owner[places], self.impact[places] * np.repeat(times, sizes))
        docs = np.flatnonzero(total)
        return docs, total[docs]


def best_rows(parts: list[Part], vocabulary: Vocabulary, size: int, top: int,
              best: list[list[tuple]]) -> None:
    """Visit the parts for every item, the highest bound first, and keep each item's
    ``top`` rows (-score, id is NULL, id) in ``best``."""
    item_of = np.repeat(np.arange(len(vocabulary.ends)),
                        np.diff(np.concatenate([[0], vocabulary.ends])))
    bounds = np.zeros((len(parts), len(vocabulary.ends)), np.int64)
    for i, part in enumerate(parts):
        most = np.zeros(size, np.int64)
        most[part.terms] = part.most
        np.add.at(bounds[i], item_of, most[vocabulary.held] * vocabulary.times)
    order = np.argsort(-bounds, axis=0, kind="stable")
    start = 0
    for item, end in enumerate(vocabulary.ends.tolist()):
        terms, times = vocabulary.held[start:end], vocabulary.times[start:end]
        start = end
        rows = best[item]
        for i in order[:, item]:
            bound = bounds[i, item]
            if bound == 0 or (len(rows) == top and bound < -rows[-1][0]):
                break  # no document of this part, or of a later one, gets in
            docs, scores = parts[i].scores(terms, times)
            if len(docs) > top:  # the k-th best score, and all that have it
                docs, scores = keep_top(docs, scores, top)
            ids = parts[i].doc_ids.take(pa.array(docs)).to_pylist()
            rows += [(-s, d is None, d) for s, d in zip(scores.tolist(), ids)]
            rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
            del rows[top:]


def keep_top(docs: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    least = np.partition(scores, len(scores) - top)[len(scores) - top]
    above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
    kept = np.concatenate([above, equal[:top - len(above)]])  # places are in order of id
    return docs[kept], scores[kept]


def index_search(postings: DataFrame, vocabulary: Vocabulary, weights: np.ndarray,
                 top: int) -> DataFrame:
    """(item, doc_id, score): the best rows of each task, from postings (doc_id, m, held,
    tf) dealt and sorted by m and id."""
    size = len(vocabulary.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in vocabulary.ends]
        parts, waiting = [], 0
        for part, count in stratum_parts(batches, weights):
            parts.append(part)
            waiting += count
            if waiting >= GROUP_POSTINGS or len(parts) == GROUP_PARTS:
                best_rows(parts, vocabulary, size, top, best)
                parts, waiting = [], 0
        if parts:
            best_rows(parts, vocabulary, size, top, best)
        rows = [(i, r[2], -r[0]) for i, rows in enumerate(best) for r in rows]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int64())], ["item", "doc_id", "score"])

    return postings.mapInArrow(task(run), "item int, doc_id bigint, score bigint")


def stratum_parts(batches: Iterator[pa.RecordBatch], weights: np.ndarray):
    """Parts (and their postings' number) of rows sorted by m, then id."""
    held: list[pa.RecordBatch] = []
    m, count = None, 0

    def built():
        table = pa.Table.from_batches(held)
        lists = table.column("held").combine_chunks()
        return Part(m, table.column("doc_id").combine_chunks(),
                    lists.flatten().to_numpy().astype(np.int64),
                    table.column("tf").combine_chunks().flatten().to_numpy(),
                    np.repeat(np.arange(len(table)), pc.list_value_length(lists).to_numpy()),
                    weights), count

    for batch in batches:
        strata = batch.column("m").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], strata[1:] != strata[:-1]]))
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(strata)).tolist()):
            if held and (strata[a] != m or count >= PART_POSTINGS):
                yield built()
                held, count = [], 0
            m = int(strata[a])
            held.append(batch.slice(a, b - a))
            count += pc.sum(pc.list_value_length(held[-1].column("held"))).as_py()
    if held:
        yield built()


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES
           ) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item."""
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    schema = "item_id bigint, rank int, doc_id bigint, score bigint"
    path = scratch_path(spark, "ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    for ids, texts in blocks_of(items, block_bytes):
        vocabulary = Vocabulary(texts)
        if not vocabulary.terms:
            continue
        counts = staged(term_counts(docs, vocabulary.terms), "terms")
        n_docs, length = counts.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        # one row for each term of the block
        df = np.zeros(len(vocabulary.terms), np.int64)
        for term, holding in (counts.select(F.explode("held").alias("term")).groupBy("term")
                              .agg(F.count("*")).collect()):
            df[term] = holding
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1)))
                            for x in df.tolist()], np.int64)
        m = F.expr(f"{FLAT} + ({STEEP} * n * {n_docs}L) div {length}L")
        postings = (counts.where(F.size("held") > 0)
                    .select("doc_id", m.alias("m"), "held", "tf")
                    .repartitionByRange("m", F.xxhash64("doc_id", "held"))
                    .sortWithinPartitions("m", F.col("doc_id").asc_nulls_last()))
        rows = index_search(postings, vocabulary, weights, top)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(),
                                                   F.col("doc_id").asc_nulls_last())
        named = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")
        ranked = (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
                  .join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
        ranked.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
