"""Operator 8: language identification of mixed-language texts.

Script ranges narrow the candidates of a word: only languages that were seen in its
script. The candidates are scored by the word's letter n-grams (naive Bayes over
hashed 1- to 3-grams, word borders included). Viterbi over the words of a text, with
a penalty for every switch, labels spans; the text's language is the one whose spans
hold most letters, its score the share of all letters.

Long texts are cut into blocks of ``BLOCK`` words that are solved side by side for
every language they may be entered in, then joined: the result is that of one pass.

The model learns from about ``SAMPLE`` texts of each language, chosen by a hash of
id and text; it has one row of ``BUCKETS`` numbers per language. Languages are meant
to be a few hundred at most.

Defined cases: NULL texts and texts without letters are ``und`` with score 0 and no
spans; letters of a script that no learned language uses belong to no span, and a
text with nothing else gets the commonest learned language with score 0 (``und`` when
nothing was learned); ties go to the language first in order; rows with NULL or
repeated ids are texts of their own, never held out when NULL and not learned from;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import remainder, ship_package, task
from laketier.llm.tokens import slices, split_blanks

SAMPLE = 3000
BUCKETS = 1 << 15
SWITCH = 8.0
TEMPER = 0.5  # overlapping n-grams repeat each other's evidence
BLOCK = 256
UNKNOWN_SCRIPT = 0
# First code points of script ranges, and the script from there on (0: none listed).
SCRIPTS = ((0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4),
           (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6), (0x0780, 0), (0x0900, 7),
           (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 11), (0x0B80, 12), (0x0C00, 13),
           (0x0C80, 14), (0x0D00, 15), (0x0D80, 16), (0x0E00, 17), (0x0E80, 18), (0x0F00, 19),
           (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23), (0x13A0, 0), (0x1E00, 1),
           (0x1F00, 2), (0x2000, 0), (0x3040, 24), (0x30A0, 25), (0x3100, 0), (0x3400, 26),
           (0x4DC0, 0), (0x4E00, 26), (0xA000, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 26),
           (0xFB00, 0), (0x20000, 26), (0x32000, 0))
N_SCRIPTS = 27
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT = np.array([s for _, s in SCRIPTS])
_letters: np.ndarray | None = None


def is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters[points]


class Grams:
    """Hashed letter n-grams of distinct words, words without letters left out."""

    def __init__(self, words: pa.Array):
        text = "\n".join(words.to_pylist()) + "\n" if len(words) else ""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.cumsum(points == 10) - (points == 10)
        keep = is_letter(points)
        points, word = points[keep], word[keep]
        self.letters = np.bincount(word, minlength=len(words))  # per word
        self.script = np.zeros(len(words), np.int64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else []
        self.real = word[first] if len(word) else np.zeros(0, np.int64)
        script = _SCRIPT[np.searchsorted(_STARTS, points, "right") - 1]
        if len(word):
            self.script[self.real] = script[first]
        # a border before and after each word, coded 1 and 2
        n = len(self.real)
        owner = np.concatenate([word, self.real, self.real])
        value = np.concatenate([points, np.ones(n, np.int64), np.full(n, 2)])
        side = np.concatenate([np.ones(len(word)), np.zeros(n), np.full(n, 2)])
        order = np.lexsort((np.concatenate([np.arange(len(word)), np.arange(n), np.arange(n)]),
                            side, owner))
        value, owner = value[order].astype(np.uint64), owner[order]
        buckets, owners = [], []
        gram = np.zeros(len(value), np.uint64)
        for size in range(3):
            tail = value[size:]
            gram = (gram[:len(tail)] * np.uint64(0x100000001B3) + tail + np.uint64(size)) \
                * np.uint64(0x9E3779B97F4A7C15)
            same = owner[:len(tail)] == owner[size:]
            buckets.append((gram[same] >> np.uint64(49)).astype(np.int64))
            owners.append(owner[:len(tail)][same])
            gram = gram ^ (gram >> np.uint64(31))
        self.bucket, self.owner = np.concatenate(buckets), np.concatenate(owners)
        self.size = len(words)

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Sum of ``table`` rows (bucket, language) over each word's n-grams."""
        out = np.zeros((self.size, table.shape[1]))
        for k in range(table.shape[1]):
            out[:, k] = np.bincount(self.owner, table[self.bucket, k], minlength=self.size)
        return out


@dataclass
class Model:
    languages: list[str]
    commonest: int
    table: np.ndarray  # log probability by bucket and language
    scripts: np.ndarray  # whether a language was seen in a script

    def words(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Scores by word and language, and which words have any candidate."""
        allowed = self.scripts[:, grams.script].T
        scores = TEMPER * grams.scores(self.table)
        scores = np.where(allowed, scores, scores.min(initial=0.0) - 100.0)
        return scores, allowed.any(1) & (grams.letters > 0)


def lowered(texts: pa.Array):
    return split_blanks(pc.utf8_lower(pc.fill_null(texts, "")))


def fit(docs: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS) -> Model:
    """Learn from the rows of ``docs`` (text, lang) with both present."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    if not sizes:
        return Model([], -1, np.zeros((buckets, 0)), np.zeros((0, N_SCRIPTS), bool))
    languages = [r.lang for r in sizes]
    index = {name: i for i, name in enumerate(languages)}
    share = spark.createDataFrame([(r.lang, min(1.0, sample / r.n)) for r in sizes],
                                  "lang string, share double")
    chosen = docs.join(F.broadcast(share), "lang").where(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, scripts_of = {}, {}
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                words, codes, bounds = lowered(part.column("text"))
                grams = Grams(words)
                lang = np.array([index[x] for x in part.column("lang").to_pylist()])
                owner = np.repeat(lang, np.diff(bounds))
                for k in np.unique(lang).tolist():
                    times = np.bincount(codes[owner == k], minlength=len(words))
                    made = np.bincount(grams.bucket, times[grams.owner], minlength=buckets)
                    seen = np.bincount(grams.script, times * grams.letters, minlength=N_SCRIPTS)
                    grams_of[k] = grams_of.get(k, 0) + made
                    scripts_of[k] = scripts_of.get(k, 0) + seen
        for k, made in grams_of.items():
            value = np.concatenate([made, scripts_of[k]])
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)),
                 pa.array(value[at])], ["lang", "at", "n"])

    # at most (buckets + scripts) rows per language reach the driver
    rows = (chosen.select("text", "lang").mapInArrow(task(count), "lang int, at int, n double")
            .groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow())
    value = np.zeros((len(languages), buckets + N_SCRIPTS))
    value[rows["lang"].to_numpy(), rows["at"].to_numpy()] = rows["n"].to_numpy()
    grams, scripts = value[:, :buckets] + 0.5, value[:, buckets:]
    return Model(languages, max(range(len(sizes)), key=lambda i: sizes[i].n),
                 np.log(grams / grams.sum(1, keepdims=True)).T.copy(),
                 scripts > 0)  # the n-grams' smoothed counts tell how likely


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH, block: int = BLOCK
            ) -> np.ndarray:
    """Best label per word: sum of scores less ``penalty`` per change of label inside a
    text (``bounds`` as in ``split_blanks``)."""
    n, labels = scores.shape
    out = np.zeros(n, np.int64)
    if not n or not labels:
        return out
    length = np.diff(bounds)
    per_text = -(-length // block)
    text = np.repeat(np.arange(len(length)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = bounds[text] + number * block
    size = np.minimum(block, bounds[text + 1] - begin)
    by_size = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[by_size], -np.arange(1, size.max() + 1), "right")

    # what a block adds on the way from an entry label (of the word before) to its last
    best = np.where(np.eye(labels, dtype=bool), 0.0, -np.inf)[None].repeat(len(text), 0)
    for t, m in enumerate(active):
        rows = by_size[:m]
        v = best[rows]
        best[rows] = np.maximum(v, v.max(2, keepdims=True) - penalty) + scores[begin[rows] + t][:, None]
    # from block to block within a text; entering a text costs nothing
    total = np.zeros((len(text), labels))
    entry = np.zeros((len(text), labels), np.int64)
    for k in range(int(number.max()) + 1):
        rows = np.flatnonzero(number == k) if k else np.flatnonzero(number == 0)
        if k == 0:
            total[rows] = best[rows].max(1)
            entry[rows] = best[rows].argmax(1)
        else:
            through = total[rows - 1][:, :, None] + best[rows]
            total[rows], entry[rows] = through.max(1), through.argmax(1)
    last = np.zeros(len(text), np.int64)
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    last[ends] = total[ends].argmax(1)
    enter = np.zeros(len(text), np.int64)
    for k in range(int(number.max()), -1, -1):
        rows = np.flatnonzero(number == k)
        enter[rows] = entry[rows, last[rows]]
        if k:
            last[rows - 1] = enter[rows]
    # inside the blocks, from the known entry to the known last label
    v = np.full((len(text), labels), -np.inf)
    v[np.arange(len(text)), enter] = 0.0
    came = np.zeros((n, labels), np.int16)
    for t, m in enumerate(active):
        rows = by_size[:m]
        top = v[rows].argmax(1)
        jump = v[rows, top][:, None] - penalty
        stay = v[rows] >= jump
        came[begin[rows] + t] = np.where(stay, np.arange(labels), top[:, None])
        v[rows] = np.where(stay, v[rows], jump) + scores[begin[rows] + t]
    state = last.copy()
    for t in range(len(active) - 1, -1, -1):
        rows = by_size[:active[t]]
        here = begin[rows] + t
        out[here] = state[rows]
        state[rows] = came[here, state[rows]]
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, spans (first word, words, language) for every row. Words
    are counted among those with letters of a learned script."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("spans", pa.list_(pa.struct([("first_word", pa.int32()),
                                                      ("words", pa.int32()),
                                                      ("lang", pa.string())])))])

    def label(part: pa.RecordBatch) -> pa.RecordBatch:
        model = held.value
        names = model.languages
        words, codes, bounds = lowered(part.column("text"))
        grams = Grams(words)
        text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        letters = np.bincount(text, grams.letters[codes], minlength=part.num_rows)
        scores, real = model.words(grams)
        keep = real[codes]
        text, codes = text[keep], codes[keep]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))])
        found = viterbi(scores[codes], bounds.astype(np.int64))
        share = np.zeros((part.num_rows, max(1, len(names))))
        np.add.at(share, (text, found), grams.letters[codes])
        best = share.argmax(1)
        score = share.max(1) / np.maximum(letters, 1)
        empty = (share.max(1) == 0) if len(names) else np.ones(part.num_rows, bool)
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])]) \
            if len(text) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(text)))
        spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
        for a, n, t, k in zip(at.tolist(), size.tolist(), text[at].tolist(), found[at].tolist()):
            spans[t].append({"first_word": a - int(bounds[t]), "words": n, "lang": names[k]})
        common = names[model.commonest] if names else "und"
        pred = ["und" if not letters[i] else common if empty[i] else names[best[i]]
                for i in range(part.num_rows)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(pred), pa.array(score),
             pa.array(spans, schema.field("spans").type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield label(part)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).mapInArrow(
        task(run), "doc_id bigint, lang_pred string, score double, "
             "spans array<struct<first_word:int,words:int,lang:string>>"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows a model may learn from: those whose id is not held out."""
    return docs.where(remainder(F.col("doc_id"), 5) != 0).select("doc_id", "text", "lang")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans; learned from the rows not held out."""
    found = identify(docs, fit(training_rows(docs)))
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
                        .alias("held_out"), "lang_pred", "score", "spans")
