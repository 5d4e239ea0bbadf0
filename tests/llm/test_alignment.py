"""Operator 13 against a brute-force version with both libraries."""

import hashlib
import random
from collections import Counter

import pytest

from laketier.llm import alignment, queries
from laketier.llm.tokens import BYTE_LETTERS, vocabulary_path

PARTS = ["\u2003", "\u3000", "“", "a", "the", "tion", " ", " ", "  ", "\n", "é", "日本", "😀", "<|endoftext|>", "<s>", "Don't",
         "12", ".", "\xa0", " ", "ing ", "under", "\x00"]


def brute_force(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_lib = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    byte_of = {c: bytes([i]) for i, c in enumerate(BYTE_LETTERS)}
    found, counts = [], Counter()
    for doc, text in rows:
        if not text:
            found.append((doc, None))
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        a_bytes = [b"".join(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            found.append((doc, None))
            continue

        def spans(ids, parts):
            out, at = [], 0
            for i, p in zip(ids, parts):
                out.append((i, at, at + len(p)))
                at += len(p)
            return out
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        ends = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups = ";".join(
            ",".join(str(x) for x, _, e in a if lo < e <= hi) + "|"
            + ",".join(str(y) for y, _, f in b if lo < f <= hi)
            for lo, hi in zip([0, *ends], ends))
        counts.update(set(links))
        found.append((doc, (len(a), len(b), len(ends), links, groups)))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            links = x[3]
            out.append((doc, *x[:3], len(links), sum(counts[p] == best[p[0]] for p in links),
                        sum(counts[p] for p in links),
                        hashlib.sha256(x[4].encode()).hexdigest()))
    return out, {(a, b): (n, n == best[a]) for (a, b), n in counts.items()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(13)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(150)]
    texts += ["", None, " ", "   ", "a▁b", "▁", "trailing ", "word " * 300, "copy of a text"]
    out = list(enumerate(texts))
    return out + [(1000 + i, "copy of a text") for i in range(40)] + [
        (None, "no id"), (7, "same id"), (7, "same id"), (7, "other text")]


@pytest.mark.parametrize("block_links", [alignment.BLOCK_LINKS, 50])
def test_measures_and_pairs(spark, documents, rows, block_links):
    measures, table = alignment.align_documents(documents(rows), block_links=block_links)
    want, pairs = brute_force(rows)
    assert sorted(map(tuple, measures.collect()), key=repr) == sorted(want, key=repr)
    assert {(r.a_id, r.b_id): (r.documents, r.best) for r in table.collect()} == pairs


def test_query_columns_and_tables_without_tokens(spark, documents, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *a: documents([(1, None), (2, ""), (3, "a▁b")]))
    out = queries.op13_alignment(spark, "")
    assert dict(out.dtypes) == {"doc_id": "bigint", **{m: "bigint" for m in alignment.MEASURES},
                                "groups_sha256": "string"}
    assert sorted(map(tuple, out.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    monkeypatch.setattr(queries, "table", lambda *a: documents([]))
    assert queries.op13_alignment(spark, "").collect() == []


def test_groups_and_links_of_one_row():
    assert alignment.aligned([1, 2, 3], [7, 8], [2, 1, 1], [3, 1]) == (
        ["1,2|7", "3|8"], [1 << 32 | 7, 2 << 32 | 7, 3 << 32 | 8])
    assert alignment.aligned([1, 2], [7, 8], [2, 2], [1, 3]) == (
        ["1,2|7,8"], [1 << 32 | 7, 1 << 32 | 8, 2 << 32 | 8])
    assert alignment.aligned([], [], [], []) == ([], [])
