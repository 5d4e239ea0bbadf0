"""Operator 9: token counts by merging alone.

A word of the vocabulary's pattern starts as single symbols in a linked list; a
heap holds the adjacent pairs by merge rank. The lowest-ranked pair (the leftmost
of equals) is merged again and again, and the count is the number of symbols less
the number of merges: no ids are looked up or emitted. Counts of distinct pieces
are kept per task (bounded), a text's count is their sum.

Defined cases: NULL and empty texts have 0 tokens and 0 bytes; a special token's
string inside a text is one token, as the library has it; rows are counted one by
one, whatever their ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import ship_package, task
from laketier.llm.tokens import Pieces, parts_of, slices, split_pieces, vocabulary_path

LIMIT = 2048
WORD_END = "</w>"


def merged_size(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after merging the lowest-ranked adjacent pair until none is left."""
    n = len(symbols)
    symbols = symbols[:]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    heapify(heap)
    merges = 0
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # stale unless the place still starts the pair of this rank
        if j < 0 or symbols[i] is None or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        k = after[i] = after[j]
        merges += 1
        if k >= 0:
            before[k] = i
            new = ranks.get((symbols[i], symbols[k]))
            if new is not None:
                heappush(heap, (new, i))
        h = before[i]
        if h >= 0:
            new = ranks.get((symbols[h], symbols[i]))
            if new is not None:
                heappush(heap, (new, h))
    return n - merges


class Counter(Pieces):
    """Token counts of pieces and texts."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in merges)
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))
                                  or r"(?!)")

    def forget(self):
        super().forget()
        self.counts = np.zeros(0, np.int64)

    def words(self, piece: str) -> list[str]:
        """The piece as words of the merge model."""
        parts = parts_of(piece) if self.short else None
        if parts is None:
            normal = self.tokenizer.normalizer.normalize_str(piece)
            parts = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return parts

    def count(self, piece: str) -> int:
        out = len(self.special.findall(piece))
        for text in self.special.split(piece) if out else (piece,):
            for word in self.words(text):
                if word:
                    out += merged_size([*word[:-1], word[-1] + WORD_END], self.ranks)
        return out

    def learn(self, words: list[str]):
        self.counts = np.concatenate([self.counts, np.fromiter(map(self.count, words), np.int64,
                                                               len(words))])

    def texts(self, texts: pa.Array) -> np.ndarray:
        words, codes, bounds = split_pieces(texts)
        entry = self.find(words)[codes] if len(codes) else np.zeros(0, np.int64)
        each = self.counts[entry]
        total = np.concatenate([[0], np.cumsum(each)])
        return np.diff(total[bounds])


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) per document."""
    vocabulary = vocabulary or vocabulary_path()
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                n = counter.texts(text)
                size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, pa.array(n, pa.int64()), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        counter.forget()

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
            .mapInArrow(task(count), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"))
