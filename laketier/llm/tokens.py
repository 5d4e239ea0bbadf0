"""Token ids of whole texts with the public word-level BPE vocabulary.

The vocabulary drops white space and never merges across it, so a text's ids
are the concatenation of the ids of its pieces between ASCII white space. Each
task keeps the ids of the pieces it has met (a bounded cache), which makes the
tokenizers library encode every distinct piece about once per task.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
# Pieces a task remembers: about 40 MB, whatever the size of the corpus.
CACHE_PIECES = 1_000_000
# The vocabulary's split pattern over the letters that the short way takes:
# lower-case a-z and the lower-case letters of Latin-1.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_SHORT = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others follow from U+0100 on, in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return "".join(out)


BYTE_LETTERS = _byte_letters()


def parts_of(piece: str) -> list[str] | None:
    """The piece as words of the merge model, in its byte-level letters; None when
    only the library's own normalizer and pattern can tell."""
    if not _SHORT.fullmatch(piece) or "<|" in piece:
        return None
    return [p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_LETTERS)
            for p in _PARTS.findall(piece.lower())]


class Pieces:
    """Bounded memory of the distinct pieces a task has met, one per file. The worker
    keeps the tokenizer for later tasks; the pieces go with the task (``forget``).

    Held as Arrow and numpy columns (some 40 bytes a piece), so that the lookups
    of a whole slice of texts are one vectorised call.
    """

    _instances: dict[tuple, "Pieces"] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if (cls, path) not in cls._instances:
            cls._instances[cls, path] = cls(path)
        return cls._instances[cls, path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.short = short_way_holds(self.tokenizer)
        self.forget()

    def forget(self):
        self.seen = pa.array([], pa.string())

    def learn(self, words: list[str]):
        """Append what is held of ``words`` to the columns."""
        raise NotImplementedError

    def find(self, words: pa.Array) -> np.ndarray:
        """Where each word's entry is, after learning the unknown ones."""
        at = pc.index_in(words, value_set=self.seen)
        if at.null_count:
            if len(self.seen) + at.null_count > CACHE_PIECES and len(self.seen):
                self.forget()
                at = pc.index_in(words, value_set=self.seen)
            new = words.filter(at.is_null())
            self.learn(new.to_pylist())
            self.seen = pa.concat_arrays([self.seen, new])
            at = pc.index_in(words, value_set=self.seen)
        return at.to_numpy().astype(np.int64)


class Encoder(Pieces):
    """Token ids of texts."""

    def forget(self):
        super().forget()
        self.ids = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)

    def learn(self, words: list[str]):
        flat, sizes = array("I"), array("q")
        tokenize, encode = self.tokenizer.model.tokenize, self.tokenizer.encode
        for word in words:
            parts = parts_of(word) if self.short else None
            if parts is None:
                ids = encode(word, add_special_tokens=False).ids
            else:
                ids = [t.id for p in parts for t in tokenize(p)]
            flat.extend(ids)
            sizes.append(len(ids))
        self.ids = np.concatenate([self.ids, np.frombuffer(flat, np.uint32)]) if flat else self.ids
        self.sizes = np.concatenate([self.sizes, np.frombuffer(sizes, np.int64)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order (uint32), and where each text's ids start
        (one bound more than texts). NULL counts as empty."""
        words, codes, bounds = split_pieces(texts)
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        entry = self.find(words)[codes]
        each = self.sizes[entry]
        ends = np.cumsum(each)
        starts = (np.cumsum(self.sizes) - self.sizes)[entry]
        place = np.repeat(starts - (ends - each), each) + np.arange(int(ends[-1]))
        return self.ids[place], np.concatenate([[0], ends])[bounds]


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces whose tokens add up to those of the texts, the code of each
    piece of the texts in order, and where each text's pieces start (one bound more
    than texts). NULL counts as empty.

    Pieces lie between ASCII white space; a full stop or comma after a final letter
    is a piece of its own, as to the vocabulary's pattern. A-Z are in lower case, as
    its normalizer has them, unless a text holds the opening of a special token:
    those are told apart by case.
    """
    texts = pc.fill_null(texts, "")
    special = pc.match_substring(texts, "<|")
    lowered = pc.ascii_lower(texts)
    if pc.any(special).as_py():
        lowered = pc.if_else(special, texts, lowered)
    words, codes, bounds = split_blanks(lowered)
    if not len(words):
        return words, codes, bounds
    stop = pc.and_not(pc.match_substring_regex(words, r"[a-z][.,]$"),
                      pc.match_substring(words, "<|"))
    stops = stop.to_numpy(zero_copy_only=False)
    if not stops.any():
        return words, codes, bounds
    stem = pc.if_else(stop, pc.utf8_slice_codeunits(words, 0, -1), words)
    tail = pc.utf8_slice_codeunits(words.filter(stop), -1)
    coded = pa.concat_arrays([stem, tail]).dictionary_encode()
    code = coded.indices.to_numpy()
    tails = np.zeros(len(words), code.dtype)
    tails[stops] = code[len(words):]
    ends = np.cumsum(1 + stops[codes])
    out = np.repeat(code[codes], 1 + stops[codes])
    out[ends[stops[codes]] - 1] = tails[codes[stops[codes]]]
    return coded.dictionary, out, np.concatenate([[0], ends])[bounds]


def split_blanks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words between ASCII white space, codes and bounds as above, of
    texts without NULLs and as they are."""
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(1, np.int64)
    lists = pc.ascii_split_whitespace(texts)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    bounds -= bounds[0]
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # blanks at a text's ends
        keep = codes != empty
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        codes = codes[keep]
    return words, codes, bounds


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 6 << 20):
    """Cut a record batch into runs of rows with at most ``max_bytes`` of text each
    (one row at least), so a worker holds that plus the longest text at once."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held + n > max_bytes and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def short_way_holds(tokenizer) -> bool:
    """Whether words can go to the merge model directly: checked on the file at
    hand rather than assumed, against the whole library call."""
    probe = "Plain words, it's 42 of THEM; we'll (see) a_b-c #tag x's3's!! Äpfel señor ÉTÉ ß."
    ids = [t.id for p in probe.split() for q in parts_of(p)
           for t in tokenizer.model.tokenize(q)]
    return ids == tokenizer.encode(probe, add_special_tokens=False).ids
