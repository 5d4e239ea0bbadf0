"""Texts cut where no tokenizer in use can join them: before a blank that follows
something else.

The byte-level vocabulary's split pattern starts a new part at every blank after a
character that is not white space (within a run of white space, only the last may), and
the piece vocabulary has no piece with a blank after another character. So the tokens of a text (with the blank that both put before
it) are those of its units, one after the other, and a task needs to tokenize every
distinct unit only once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK_PIECE = "▁"  # stands for a blank in piece vocabularies

#: First and second bytes of white space beyond Latin-1, and of U+2581, in UTF-8.
SPACING = np.zeros((256, 2), bool)
SPACING[[0xE1, 0xE2, 0xE3], 0] = SPACING[[0x80, 0x81, 0x96, 0x9A], 1] = True


def spaced_units(texts: pa.Array, whole: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct units of the texts, each with a blank before it; the code of each unit
    of the texts in order; where each text's units start (one bound more than texts).
    Empty and NULL texts have no units. ``whole``: every text is one unit.

    A blank begins a unit after a printing ASCII character, or one beyond ASCII that is
    neither white space nor a literal U+2581 (a blank to a piece vocabulary). Some others
    that share those characters' first bytes are left out with them, which only makes a
    unit longer.
    """
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.binary_join_element_wise(" ", texts, "") if len(texts) else texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    offsets = offsets - first
    filled = np.diff(offsets) > 1  # more than the blank before it
    opens = np.zeros(len(flat), bool)
    if not whole and len(flat):
        opens[1:] = (flat[1:] == 0x20) & (flat[:-1] > 0x20) & (flat[:-1] != 0x7F)
        beyond = flat[:-1] >= 0x80
        opens[2:] &= ~(beyond[1:] & (flat[:-2] == 0xC2))  # U+0085, U+00A0
        opens[3:] &= ~(beyond[2:] & SPACING[flat[:-3], 0] & SPACING[flat[1:-2], 1])
    opens[offsets[:-1]] = True
    empty = offsets[:-1][~filled]
    at = np.flatnonzero(opens)
    bounds = np.searchsorted(at, offsets)
    if not len(at):
        return pa.array([], pa.string()), np.zeros(0, np.int64), bounds
    cuts = np.append(at, len(flat)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(at), pa.py_buffer(cuts), pa.py_buffer(flat))
    if len(empty):  # their blank alone is no unit
        keep = np.ones(len(at), bool)
        keep[np.searchsorted(at, empty)] = False
        units = units.filter(pa.array(keep))
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
    coded = units.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), bounds


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start, start+1, ...`` of every entry, one entry after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
