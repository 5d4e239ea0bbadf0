"""Operator 11: ids of a merge-type piece vocabulary and the texts they stand for.

A text, its blanks written as U+2581 and one put before it, is a row of symbols, at
first its characters. An agenda holds the adjacent pairs whose joined symbol is a piece,
the highest score first and the leftmost among equals; the first pair is joined, and its
new neighbours go on the agenda. Rows of few symbols are taken thousands at a time, the
agenda of each a row of an array (``joined_rows``); longer ones have a heap, and a popped
pair that is no longer there is passed over (``merged``). Symbols that are no piece
become their UTF-8 bytes' pieces (or the unknown id, where a vocabulary has no bytes).
No piece of the vocabulary reaches over the beginning of a word, so the agendas run on
the distinct units of a task's texts (``units.py``) and a text's ids are put together by
array lookups; a vocabulary with such pieces is given whole texts.

Every unit new to a task is checked, ids and text, against the sentencepiece library
in one call for each Arrow batch; a difference (such as a vocabulary that rewrites
characters) fails the job.

Defined cases: NULL and empty texts have the end id alone, and decode to an empty
text; repeated rows and ids, and NULL ids, are rows like others; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import ship_package, task
from laketier.llm.tokens import Pieces, slices, vocabulary_path
from laketier.llm.units import BLANK_PIECE, gathered, spaced_units

VOCABULARY = "piece_bpe_32k.model"
#: Symbols up to which a row's agenda is a row of an array, and rows taken at a time.
ROW_SYMBOLS, ROWS = 32, 8192
CODE_POINTS = 0x110000
NO_PIECE = np.int32(2**31 - 1)  # ranks after any piece's


class PieceMismatch(ValueError):
    """A unit whose ids or text the library gives differently."""


class PieceEncoder(Pieces):
    """Ids of texts by an agenda of adjacent symbol pairs; see the module."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        byte = [sp.is_byte(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
        plain = [i for i in range(size) if not byte[i] and not special[i]]
        self.id_of = {names[i]: i for i in plain}
        order = {s: r for r, s in enumerate(sorted({-sp.get_score(i) for i in plain}))}
        #: The higher a piece's score, the lower its rank; equal scores share one.
        self.rank = {names[i]: order[-sp.get_score(i)] for i in plain}
        self.unused = {names[i] for i in plain if sp.is_unused(i)}
        self.byte_id = [0] * 256 if any(byte) else None
        for i in range(size):
            if byte[i]:
                self.byte_id[int(names[i][3:5], 16)] = i  # <0xHH>
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        self.whole = any(BLANK_PIECE in p.lstrip(BLANK_PIECE) for p in self.id_of)
        #: Bytes of each id in a decoded text; specials have none, the unknown its mark.
        self.bytes_of = pa.array(
            [bytes([int(n[3:5], 16)]) if b else
             (" ⁇ ".encode() if i == self.unknown else b"") if s else
             n.replace(BLANK_PIECE, " ").encode()
             for i, (n, b, s) in enumerate(zip(names, byte, special))], pa.binary())
        self.forget()

    def forget(self):
        super().forget()
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def merged(self, text: str) -> list[str]:
        """The symbols left when no adjacent pair is a piece. The agenda holds a pair as
        its rank and its left symbol's place; one that has changed since has another
        rank, or none, and is passed over."""
        rank, n, push, pop = self.rank.get, len(text), heapq.heappush, heapq.heappop
        symbols = list(text)
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank(text[i:i + 2])) is not None]
        heapq.heapify(agenda)
        before, after = list(range(-1, n)), list(range(1, n + 2))
        made: dict[str, tuple[str, str]] = {}
        while agenda:
            key = pop(agenda)
            left = key & 0xFFFFFFFF
            first, right = symbols[left], after[left]
            if not first or right >= n:
                continue
            second = symbols[right]
            joined = first + second
            if rank(joined) != key >> 32:
                continue
            if joined in self.unused:
                made[joined] = first, second
            symbols[left], symbols[right] = joined, ""
            after[left] = beyond = after[right]
            before[beyond] = left
            if beyond < n and (r := rank(joined + symbols[beyond])) is not None:
                push(agenda, r << 32 | left)
            previous = before[left]
            if previous >= 0 and (r := rank(symbols[previous] + joined)) is not None:
                push(agenda, r << 32 | previous)
        if not self.unused:
            return [s for s in symbols if s]
        return [p for s in symbols if s for p in self._used(s, made)]

    def _used(self, symbol: str, made: dict) -> list[str]:
        """An unused piece is taken apart again into what it was made of."""
        if symbol not in self.unused or symbol not in made:
            return [symbol]
        return [p for part in made[symbol] for p in self._used(part, made)]

    def encoded(self, unit: str) -> list[int]:
        out: list[int] = []
        for symbol in self.merged(unit.replace(" ", BLANK_PIECE)):
            known = self.id_of.get(symbol)
            if known is not None:
                out.append(known)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in symbol.encode("utf-8", "replace"))
            elif not out or out[-1] != self.unknown:  # a run of unknown symbols is one
                out.append(self.unknown)
        return out

    @cached_property
    def symbol_of(self) -> np.ndarray:
        """Symbol of each character, a blank's that of U+2581: the id of its piece, or its
        code point after all ids."""
        out = np.arange(CODE_POINTS, dtype=np.int32) + len(self.bytes_of)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                out[ord(piece)] = i
        out[ord(" ")] = out[ord(BLANK_PIECE)]
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of symbols that join to a piece, as numbers in order; rank and id of that
        piece. After the last comes one that no pair has."""
        symbol = {p: i for p, i in self.id_of.items() if len(p) > 1}
        for p in set(chain.from_iterable(self.id_of)):
            symbol[p] = int(self.symbol_of[ord(p)])
        found = sorted((symbol[p[:i]] << 32 | symbol[p[i:]], rank, self.id_of[p])
                       for p, rank in self.rank.items() if rank is not None
                       for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol)
        keys, ranks, ids = zip(*found, (1 << 62, NO_PIECE, 0))
        return np.array(keys, np.int64), np.array(ranks, np.int32), np.array(ids, np.int32)

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that each pair of symbols joins to."""
        keys, ranks, ids = self.pairs
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(keys, key)
        return np.where(keys[at] == key, ranks[at], NO_PIECE), ids[at]

    def joined_rows(self, symbols: np.ndarray) -> np.ndarray:
        """What is left of rows of symbols (in the first column and behind a row's end -1)
        when no adjacent pair is a piece; -1 in the places of those joined to another."""
        width = symbols.shape[1]
        flat = symbols.ravel()
        before, after = np.arange(-1, flat.size - 1), np.arange(1, flat.size + 1)
        ranks, ids = self.joined(flat, np.append(flat[1:], -1))
        agenda = ranks.reshape(-1, width)
        live = np.arange(len(symbols))
        while True:
            left = live * width + agenda[live].argmin(axis=1)  # the leftmost of the best
            some = ranks[left] != NO_PIECE
            live, left = live[some], left[some]
            if not len(live):
                return flat.reshape(-1, width)
            right, previous = after[left], before[left]
            beyond = after[right]
            flat[left], flat[right], ranks[right] = ids[left], -1, NO_PIECE
            after[left], before[beyond] = beyond, left
            ranks[left], ids[left] = self.joined(flat[left], flat[beyond])
            ranks[previous], ids[previous] = self.joined(flat[previous], flat[left])

    def encoded_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units, one after the other, and how many each has."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(lengths, kind="stable")
        plain = self.byte_id is not None and not self.unused
        few = int(np.searchsorted(lengths[order], ROW_SYMBOLS, "right")) if plain else 0
        symbols = self.symbol_of[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        starts = np.cumsum(lengths) - lengths
        sizes = np.zeros(len(units), np.int64)
        out = []
        for at in range(0, few, ROWS):
            rows = order[at:min(at + ROWS, few)]
            width = int(lengths[rows[-1]])
            place = np.arange(width)
            table = np.full((len(rows), width + 2), -1, np.int32)
            inside = place < lengths[rows, None]
            table[:, 1:-1][inside] = symbols[(starts[rows, None] + place)[inside]]
            table = self.joined_rows(table)
            ids, sizes[rows] = self._as_ids(table)
            out.append(ids)
        rest = array("i")
        for i in order[few:].tolist():
            ids = self.encoded(units[i])
            sizes[i] = len(ids)
            rest.extend(ids)
        flat = np.concatenate([*out, np.frombuffer(rest, np.int32)])
        begin = np.empty(len(units), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[gathered(begin, sizes)], sizes

    def _as_ids(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols of all rows, those without a piece as bytes, and how many
        each row has."""
        there = table >= 0
        symbols = table[there]
        if symbols.max(initial=0) < len(self.bytes_of):
            return symbols, there.sum(axis=1)
        bare = np.flatnonzero(symbols >= len(self.bytes_of))
        points, which = np.unique(symbols[bare] - len(self.bytes_of), return_inverse=True)
        spelt = [[self.byte_id[b] for b in chr(c).encode("utf-8", "replace")] for c in points.tolist()]
        length = np.array([len(x) for x in spelt])
        each = np.ones(len(symbols), np.int64)
        each[bare] = length[which]
        ends = np.cumsum(each)
        out = np.repeat(symbols, each)
        out[gathered((ends - each)[bare], each[bare])] = np.array(
            list(chain.from_iterable(spelt)), np.int32)[gathered((np.cumsum(length) - length)[which], each[bare])]
        return out, np.diff(np.concatenate([[0], ends])[np.cumsum([0, *there.sum(axis=1)])])

    def learn(self, words: list[str]):
        ids, sizes = self.encoded_units(words)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        given = self.library.encode([w[1:] for w in words], num_threads=1)
        if " " in words:  # the library puts no blank before an empty text
            at = words.index(" ")
            given[at] = ids[bounds[at]:bounds[at + 1]].tolist()
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
        if not np.array_equal(sizes, np.fromiter(map(len, given), np.int64)) or \
                not np.array_equal(ids, np.fromiter(chain.from_iterable(given), np.int32)) or \
                self.decode(lists).to_pylist() != self.library.decode(given):
            raise PieceMismatch("the library gives other ids or another text")
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, the end id after each, and the bounds."""
        units, codes, bounds = spaced_units(texts, self.whole)
        if len(codes):
            entry = self.find(units)[codes]
            sizes = self.sizes[entry]
            ids = self.ids[gathered((np.cumsum(self.sizes) - self.sizes)[entry], sizes)]
            bounds = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        else:
            ids = np.zeros(0, np.int32)
        out = np.insert(ids, bounds[1:], self.end).astype(np.int32)
        return out, bounds + np.arange(len(bounds))

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids: the pieces' bytes in a row, less the blank put before."""
        offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        flat = ids.flatten()
        joined = pc.binary_join(pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), self.bytes_of.take(flat)), b"")
        starts = np.frombuffer(joined.buffers()[1], np.int32)[:len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2], np.uint8)[:starts[-1]]
        blank = np.append(data, 0)[starts[:-1]] == 0x20
        blank &= np.diff(starts) > 0
        # neither the byte of a blank nor the unknown's mark is one put before a text
        lead = np.append(flat.to_numpy(), -1)[offsets[:-1]]
        blank &= (lead != self.unknown) & (lead != (self.byte_id or [-1] * 256)[0x20])
        drop = starts[:-1][blank]
        starts = starts - np.concatenate([[0], np.cumsum(blank)])
        joined = pa.Array.from_buffers(pa.binary(), len(joined), [
            None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.delete(data, drop))])
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # ids that no text has
            return pa.array([decoded_bytes(x) for x in joined.to_pylist()], pa.string())


def decoded_bytes(data: bytes) -> str:
    """UTF-8 to text; every byte that begins no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at:at + error.start].decode() + "�")
            at += error.start + 1
    return "".join(out)


def encode_documents(docs: DataFrame, path: str | None = None, column: str = "text",
                     decoded: bool = False) -> DataFrame:
    """doc_id, ids (array<int>, the end id last) and, where asked for, the text that the
    ids decode to, of every row. ``path``: the vocabulary file."""
    ship_package(docs.sparkSession)
    path = path or vocabulary_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(path)
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    ids, bounds = encoder.encode(part.column("text"))
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                    columns = {"doc_id": part.column("doc_id"), "ids": lists}
                    if decoded:
                        columns["decoded"] = encoder.decode(lists)
                    yield pa.RecordBatch.from_pydict(columns)
        finally:
            encoder.forget()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("text")
                       ).mapInArrow(task(run), "doc_id bigint, ids array<int>"
                                    + (", decoded string" if decoded else ""))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (with a column ids) and the text of its ids as ``decoded``; a NULL list
    is empty."""
    ship_package(encoded.sparkSession)
    path = path or vocabulary_path(VOCABULARY)
    schema = encoded.drop("decoded").schema.simpleString()[len("struct<"):-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(path)
        for batch in batches:
            lists = batch.column("ids")
            lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32())) \
                if lists.null_count else lists.cast(pa.list_(pa.int32()))
            yield batch.append_column("decoded", encoder.decode(lists))

    return encoded.drop("decoded").mapInArrow(task(run), f"{schema}, decoded string")
