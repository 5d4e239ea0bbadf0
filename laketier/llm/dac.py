"""Directly addressable codes: any token of a stored run without block decoding.

An id is split into ``bits``-wide chunks, lowest first. Level k holds, in order,
the k-th chunk of every id that has one, and a continuation bitmap: bit i says
whether entry i goes on in level k+1, at the place given by the number of ones
before i. A rank directory keeps that number for every ``RANK_BLOCK`` bits, so a
lookup reads one chunk, one bit and less than one block of bitmap per level. A
range of ids is a range on every level, hence decoded with array operations.

File layout (little-endian): b"DAC1", chunk bits u8, levels u8, pad u16, ids u64;
per level: entries u64, chunks (one byte each), bitmap (bits from the lowest up),
directory (u32 per block, ones before the block).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
RANK_BLOCK = 512


def encode(ids: np.ndarray, bits: int = 8) -> bytes:
    """``ids`` (unsigned, below 2**32) as one DAC image; no ids give no level."""
    rest = np.asarray(ids, np.uint64)
    out, levels = [], 0
    while len(rest):
        chunk = (rest & np.uint64((1 << bits) - 1)).astype(np.uint8)
        rest = rest >> np.uint64(bits)
        more = rest > 0
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), RANK_BLOCK))
        directory = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        out += [struct.pack("<Q", len(chunk)), chunk.tobytes(),
                np.packbits(more, bitorder="little").tobytes(), directory.tobytes()]
        rest, levels = rest[more], levels + 1
    return b"".join([MAGIC, struct.pack("<BBHQ", bits, levels, 0, len(ids)), *out])


class Reader:
    """Random access to the ids of one image."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a DAC image")
        self.bits, levels, _, self.size = struct.unpack_from("<BBHQ", image, 4)
        at, self.levels = 16, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", image, at)
            at += 8
            chunks = np.frombuffer(image, np.uint8, n, at)
            at += n
            bitmap = np.frombuffer(image, np.uint8, -(-n // 8), at)
            at += len(bitmap)
            directory = np.frombuffer(image, "<u4", -(-n // RANK_BLOCK), at)
            at += 4 * len(directory)
            self.levels.append((chunks, bitmap, directory))

    def __len__(self) -> int:
        return self.size

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Ones among the first ``i`` bits."""
        block = i // RANK_BLOCK
        if block >= len(directory):  # i is the end, on a block's border
            block = len(directory) - 1
        first = block * RANK_BLOCK
        ones = int(np.bitwise_count(bitmap[first // 8:i // 8]).sum())
        if i % 8:
            ones += (int(bitmap[i // 8]) & ((1 << i % 8) - 1)).bit_count()
        return int(directory[block]) + ones

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (k * self.bits)
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(bitmap, directory, i)
        return value

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) as uint32."""
        if not 0 <= start <= stop <= self.size:
            raise IndexError((start, stop))
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            if start == stop:
                break
            out[where] |= chunks[start:stop].astype(np.uint32) << np.uint32(k * self.bits)
            first = start // 8
            flags = np.unpackbits(bitmap[first:-(-stop // 8)], bitorder="little")
            more = flags[start - 8 * first:stop - 8 * first].astype(bool)
            where = where[more]
            start = self._rank(bitmap, directory, start)
            stop = start + len(where)
        return out
