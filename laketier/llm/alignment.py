"""Operator 13: two tokenizers aligned over exact-text deduplicated documents.

Documents are shuffled by their full text, so that every distinct text is tokenized and
aligned once, and counts with the number of documents that have it. A text's tokens are
those of its units (``units.py``), with which both vocabularies end a token; a task
aligns each distinct unit once, and a text is put together by array lookups.

The texts of a task are gathered to blocks of a bounded number of links. A block is one
row: its distinct id pairs with the number of documents that hold each, and for each
text the pairs it holds and how often. Pair counts are added up over the blocks' pairs
(each moved once for each block, not for each text), the highest count of each A id
comes from those, and every block gets the counts of its own pairs back. So no list of
all pairs is in one place, whatever the corpus. A text's measures then join the
documents that have it, by the hash of the text.

Defined cases: texts that are NULL, empty, or that the vocabularies' tokens do not give
back byte for byte have no tokens (zeros, and an empty ``groups_sha256``); they link no
ids. Rows that share an id are documents of their own, NULL ids too. Nothing but such
texts, or an empty table, gives rows of zeros, or none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import ship_package, staged, task
from laketier.llm.tokens import BYTE_LETTERS, Pieces, slices, vocabulary_path
from laketier.llm.units import BLANK_PIECE, gathered, spaced_units

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links (token pairs that overlap) that a block gathers before it becomes a row; a
#: longer text is a block of its own.
BLOCK_LINKS = 1 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class PairUnits(Pieces):
    """What a task knows of the units it has met: how their tokens align."""

    def __init__(self, path: str):
        import json

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        first, second = json.loads(path)
        self.a, self.b = Tokenizer.from_file(first), SentencePieceProcessor(model_file=second)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        byte_of = {c: i for i, c in enumerate(BYTE_LETTERS)}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.forget()

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace(BLANK_PIECE, " ").encode()

    def forget(self):
        super().forget()
        #: n_a, n_b, n_groups of each unit; -1 where its tokens do not give it back.
        self.counts = np.zeros((0, 3), np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)  # A id << 32 | B id
        self.groups = pa.array([], pa.string())

    def learn(self, words: list[str]):
        of_a = [e.ids for e in self.a.encode_batch(words, add_special_tokens=False)]
        of_b = self.b.encode([w[1:] for w in words], num_threads=1)
        blank = self.b.piece_to_id(BLANK_PIECE)
        counts, sizes, links, groups = [], [], [], []
        for word, a, b in zip(words, of_a, of_b):
            b = b or [blank]  # the library puts no blank before an empty text
            found = aligned(a, b, [len(self.bytes_a[i]) for i in a],
                            [len(self.bytes_b[i]) for i in b])
            data = word.encode()
            good = (b"".join([self.bytes_a[i] for i in a]) == data
                    and b"".join([self.bytes_b[i] for i in b]) == data)
            counts.append((len(a), len(b), len(found[0])) if good else (-1, -1, -1))
            sizes.append(len(found[1]) if good else 0)
            links += found[1] if good else []
            groups.append(";".join(found[0]))
        self.counts = np.concatenate([self.counts, np.array(counts, np.int64).reshape(-1, 3)])
        self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
        self.links = np.concatenate([self.links, np.array(links, np.int64)])
        self.groups = pa.concat_arrays([self.groups, pa.array(groups, pa.string())])


def aligned(a: list[int], b: list[int], size_a: list[int], size_b: list[int]
            ) -> tuple[list[str], list[int]]:
    """Groups between the offsets where both rows end a token, written ``a1,a2|b1``, and
    the links (``A id << 32 | B id``) of all tokens whose bytes overlap; both rows have
    the same bytes."""
    groups, links = [], []
    i = j = first_a = first_b = end_a = end_b = 0
    na, nb = len(a), len(b)
    if na:
        end_a = size_a[0]
    if nb:
        end_b = size_b[0]
    while i < na and j < nb:
        links.append(a[i] << 32 | b[j])
        if end_a == end_b:
            groups.append(",".join(map(str, a[first_a:i + 1])) + "|"
                          + ",".join(map(str, b[first_b:j + 1])))
            first_a, first_b = i + 1, j + 1
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            i += 1
            if i < na:
                end_a += size_a[i]
        if step_b:
            j += 1
            if j < nb:
                end_b += size_b[j]
    return groups, links


BLOCK = ("block string, pairs array<bigint>, documents array<bigint>, keys array<binary>, "
         "measures array<bigint>, sha array<string>, ends array<int>, held array<int>, "
         "times array<int>")


def text_blocks(texts: DataFrame, paths: str, block_links: int) -> DataFrame:
    """Distinct texts (key, documents, text) as blocks, one row each; see the module.

    ``ends``, ``held``, ``times``: where each text's entries end, and the entries: a place
    in ``pairs``, and how often the text holds that pair. ``measures`` has n_a, n_b,
    n_groups, n_links of each text in turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = PairUnits.of(paths)
        held: list[tuple] = []
        links = 0
        try:
            for batch in batches:
                for part in slices(batch, "text", 4 << 20):
                    for row in aligned_texts(part, units):
                        if held and links + len(row[-1]) > block_links:
                            yield block(held)
                            held, links = [], 0
                        held.append(row)
                        links += len(row[-1])
            if held:
                yield block(held)
        finally:
            units.forget()

    return texts.select("key", "documents", "text").mapInArrow(task(run), BLOCK)


def aligned_texts(part: pa.RecordBatch, units: PairUnits):
    """key, documents, measures, sha, links of each text; those without tokens stay out."""
    words, codes, bounds = spaced_units(part.column("text"))
    if not len(codes):
        return
    entry = units.find(words)[codes]
    counts = units.counts[entry]
    sizes = units.sizes[entry]
    links = units.links[gathered((np.cumsum(units.sizes) - units.sizes)[entry], sizes)]
    at = np.concatenate([[0], np.cumsum(sizes)])
    groups = pc.binary_join(pa.ListArray.from_arrays(
        pa.array(bounds, pa.int32()), units.groups.take(pa.array(entry))), ";")
    for i, (key, documents) in enumerate(zip(part.column("key").to_pylist(),
                                             part.column("documents").to_pylist())):
        a, b = bounds[i], bounds[i + 1]
        if a == b or (counts[a:b, 0] < 0).any():
            continue
        own = links[at[a]:at[b]]
        yield (key, documents, [*counts[a:b].sum(0).tolist(), len(own)],
               hashlib.sha256(groups[i].as_buffer()).hexdigest(), own)


def block(rows: list[tuple]) -> pa.RecordBatch:
    keys, documents, measures, sha, links = zip(*rows)
    pairs, place = np.unique(np.concatenate(links), return_inverse=True)
    text = np.repeat(np.arange(len(rows)), [len(x) for x in links])
    entries, times = np.unique(text * len(pairs) + place, return_counts=True)
    held, owner = entries % len(pairs), entries // len(pairs)
    count = np.bincount(held, np.array(documents, float)[owner], len(pairs)).astype(np.int64)
    ends = np.cumsum(np.bincount(owner, minlength=len(rows)))
    return pa.RecordBatch.from_pylist([{
        "block": hashlib.sha256(b"".join(keys)).hexdigest(), "pairs": pairs, "documents": count,
        "keys": keys, "measures": [x for m in measures for x in m], "sha": sha,
        "ends": ends, "held": held, "times": times}], pa.schema([
            ("block", pa.string()), ("pairs", pa.list_(pa.int64())),
            ("documents", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary())),
            ("measures", pa.list_(pa.int64())), ("sha", pa.list_(pa.string())),
            ("ends", pa.list_(pa.int32())), ("held", pa.list_(pa.int32())),
            ("times", pa.list_(pa.int32()))]))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id << 32 | B id), documents that hold it linked, and whether no other B id
    has more with that A id."""
    counts = staged(blocks.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x"))
                    .groupBy(F.col("x.pairs").alias("pair"))
                    .agg(F.sum("x.documents").alias("documents")), "pair-counts")
    a = F.shiftright("pair", 32)
    # one row for each A id: the vocabulary bounds it
    best = staged(counts.groupBy(a.alias("a")).agg(F.max("documents").alias("most")), "best")
    return counts.join(F.broadcast(best), a == F.col("a")).select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def text_measures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """key, the measures and groups_sha256 of every text of the blocks."""
    told = (blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
            .join(counts, "pair").groupBy("block")
            .agg(F.collect_list(F.struct("place", "documents", "best")).alias("told")))
    schema = pa.schema([("key", pa.binary()), *((m, pa.int64()) for m in MEASURES),
                        ("groups_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                def values(name):
                    return batch.column(name)[i].values
                told = values("told")
                order = told.field("place").to_numpy()
                documents, best = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
                documents[order] = told.field("documents").to_numpy()
                best[order] = told.field("best").to_numpy(zero_copy_only=False)
                held, times = values("held").to_numpy(), values("times").to_numpy()
                ends = values("ends").to_numpy()
                starts = np.concatenate([[0], ends[:-1]])
                n_best = np.add.reduceat(times * best[held], starts)
                total = np.add.reduceat(times * documents[held], starts)
                measures = values("measures").to_numpy().reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [values("keys"), *(pa.array(measures[:, k]) for k in (0, 1, 2, 3)),
                     pa.array(n_best), pa.array(total), values("sha")], schema=schema)

    return (blocks.drop("pairs", "documents").join(told, "block")
            .select("keys", "measures", "sha", "ends", "held", "times", "told")
            .mapInArrow(task(run), "key binary, " + "".join(f"{m} bigint, " for m in MEASURES)
                        + "groups_sha256 string"))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
                    block_links: int = BLOCK_LINKS) -> tuple[DataFrame, DataFrame]:
    """Measures of every document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256), and the table of linked id pairs (a_id, b_id, documents, best)."""
    import json
    ship_package(docs.sparkSession)
    paths = json.dumps([path_a or vocabulary_path(BYTE_LEVEL), path_b or vocabulary_path(PIECES)])
    key = F.unhex(F.sha2("text", 256))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    texts = (rows.where("text != ''").groupBy("text").agg(F.count("*").alias("documents"))
             .select(key.alias("key"), "documents", "text"))
    blocks = staged(text_blocks(texts, paths, block_links), "blocks")
    counts = staged(pair_counts(blocks), "pairs")
    measures = staged(text_measures(blocks, counts), "measures")
    # a text that many documents share is one row here, and Spark can split its documents
    out = (rows.select("doc_id", key.alias("key")).join(measures, "key", "left")
           .select("doc_id", *[F.coalesce(m, F.lit(0)).cast("bigint").alias(m) for m in MEASURES],
                   F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
    table = counts.select(F.shiftright("pair", 32).cast("int").alias("a_id"),
                          F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"),
                          "documents", "best")
    return out, table
