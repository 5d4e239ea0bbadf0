"""Operator 3: language-model scores by a log-bilinear model with noise contrast.

Words are written as classes: the end of a text, the ``FREQUENT`` commonest words,
and for all others (words never seen too) one of ``ENDINGS`` classes by the word's
last letters. The probability of a word is that of its class after the two classes
before it, times that of the word in its class:

* class after context, a log-bilinear model: the context vector is the sum of the two
  class vectors, each scaled by its position's weights, and a class's score is its
  product with the class's output vector plus a bias. Training is noise-contrastive:
  the classes of the corpus are told from classes drawn by their frequency, all in
  numpy, on every training text once. Each task trains on its texts and the vectors
  are averaged, weighted by tokens, in ``ROUNDS`` rounds. For scoring the model is
  normalised exactly: batched matrix products give every class's score after every
  pair of classes, hence the normaliser of each pair.
* word in class, absolute discounting: what is taken from the words seen is the
  probability of the words of the class never seen, taken together as one.

So the probabilities after any context sum to one over the known words and one
unknown word per class.

Counts are exact over all training texts, and no vocabulary is ever held in one
place. A worker codes its texts in blocks of some ``BLOCK_BYTES`` against the
block's own dictionary and writes both down; the words of all dictionaries meet once
in a shuffle, where they are counted and sent back to the blocks they came from. A
word is one row per block however often it occurs, so a word that makes up a third
of all tokens is no hot group.

Defined cases: NULL and empty texts are the end alone; without training texts every
word is unknown and the base is 0 for each token; rows with NULL or repeated ids are
texts of their own, NULL ids are learned from and not held out; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import remainder, ship_package, staged, task
from laketier.llm.tokens import slices, split_blanks

FREQUENT = 500
ENDINGS = 200
WIDTH = 24
ROUNDS = 3
NOISE = 64
BATCH = 4096
RATE = 0.15
BLOCK_BYTES = 48 << 20
TASK_TOKENS = 2_000_000  # about what one task trains on
END = " "  # no word holds a blank

CODED = ("kind int, block bigint, doc_id bigint, held_out boolean, codes binary, "
         "first int, words array<string>, counts array<bigint>")
SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
          "within double, classes binary")


# --- texts as codes of a block's dictionary -------------------------------------------------

class Block:
    """The dictionary of the texts coded so far, and training counts of its words."""

    def __init__(self, number: int):
        self.number = number
        self.words = pa.array([END], pa.string())
        self.counts = np.zeros(1, np.int64)
        self.bytes = 0

    def code(self, texts: pa.Array, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts, an end after each, and the bounds of the texts."""
        words, codes, bounds = split_blanks(pc.ascii_lower(pc.fill_null(texts, "")))
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            self.words = pa.concat_arrays([self.words, words.filter(at.is_null())])
            at = pc.index_in(words, value_set=self.words)
        known = at.to_numpy().astype(np.int64) if len(words) else np.zeros(0, np.int64)
        size = np.diff(bounds) + 1
        ends = np.cumsum(size) - 1
        out = np.zeros(int(size.sum()), np.int64)
        inside = np.ones(len(out), bool)
        inside[ends] = False
        out[inside] = known[codes]
        times = np.bincount(out[np.repeat(learn, size)], minlength=len(self.words))
        times[:len(self.counts)] += self.counts
        self.counts = times
        self.bytes += texts.nbytes
        return out, np.append(ends - size + 1, len(out))


def coded_texts(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: 1 the codes of a text, 0 a part of a block's dictionary."""
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()),
                        ("held_out", pa.bool_()), ("codes", pa.binary()),
                        ("first", pa.int32()), ("words", pa.list_(pa.string())),
                        ("counts", pa.list_(pa.int64()))])
    part_words = 1 << 16

    def dictionary(block: Block) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(block.words), part_words):
            words = block.words[k:k + part_words]
            n = len(words)
            yield pa.RecordBatch.from_arrays([
                pa.array([0], pa.int32()), pa.array([block.number]), pa.array([None], pa.int64()),
                pa.array([None], pa.bool_()), pa.array([None], pa.binary()),
                pa.array([k], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words),
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()),
                                         pa.array(block.counts[k:k + n]))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        block = Block(first)
        for batch in batches:
            for part in slices(batch, "text"):
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                codes, bounds = block.code(part.column("text"), ~held)
                data = codes.astype("<u4")
                n = part.num_rows
                empty = [pa.nulls(n, schema.field(f).type) for f in ("first", "words", "counts")]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ones(n, np.int32)), pa.array(np.full(n, block.number)),
                    part.column("doc_id"), part.column("held_out"),
                    pa.array([data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
                             pa.binary()), *empty], schema=schema)
                if block.bytes >= BLOCK_BYTES:
                    yield from dictionary(block)
                    block = Block(block.number + 1)
        if block.bytes:
            yield from dictionary(block)

    return docs.mapInArrow(task(run), CODED)


# --- counts and classes ---------------------------------------------------------------------

@dataclass
class Counts:
    """Totals of the training tokens and, by class, of the words in it."""

    tokens: int
    words: int
    frequent: list[str]
    discount: float
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.class_tokens)


def ending_class(word: str):
    """Number of the ending class of a column of words."""
    return (F.crc32(F.substring(word, -2, 2).cast("binary")) % ENDINGS).cast("int")


def count_words(places: DataFrame) -> Counts:
    """``places``: one row per distinct word, with its number of training tokens ``n``."""
    seen = places.where("n > 0")
    total = seen.agg(F.sum("n").alias("tokens"), F.count("*").alias("words"),
                     F.sum((F.col("n") == 1).cast("long")).alias("once"),
                     F.sum((F.col("n") == 2).cast("long")).alias("twice")).first()
    top = (seen.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(FREQUENT)
           .select("word").collect())
    frequent = [END] + [r.word for r in top]
    by_class = (seen.where(~F.col("word").isin(frequent))
                .groupBy(ending_class("word").alias("c"))
                .agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect())
    tokens, words = np.zeros((2, len(frequent) + ENDINGS))
    for r in by_class:
        tokens[len(frequent) + r.c], words[len(frequent) + r.c] = r.n, r.words
    at = {w: i for i, w in enumerate(frequent)}
    for r in seen.where(F.col("word").isin(frequent)).select("word", "n").collect():
        tokens[at[r.word]], words[at[r.word]] = r.n, 1
    once, twice = total.once or 0, total.twice or 0
    return Counts(total.tokens or 0, total.words or 0, frequent,
                  min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5)), tokens, words)


def scored_texts(coded: DataFrame, replies: DataFrame, counts: Counts) -> DataFrame:
    """Base score, score inside the classes and the classes of every text."""
    frequent = len(counts.frequent)
    fields = [f.split(" ")[0] for f in SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = n = kind = None
        parts: list[tuple[np.ndarray, ...]] = []
        base = inside = known = None
        for batch in batches:
            at = 0
            numbers, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for end in [*edges.tolist(), batch.num_rows]:
                part = batch.slice(at, end - at)
                if end == at:
                    continue
                if numbers[at] != block:
                    block, parts, base = numbers[at], [], None
                if kinds[at] == 0:
                    parts.append(tuple(part.column(c).to_numpy(zero_copy_only=False)
                                       for c in ("place", "n", "c")))
                else:
                    if base is None:
                        place, n, kind = (np.concatenate(x) for x in zip(*parts))
                        parts = []
                        order = np.argsort(place)
                        n, kind = n[order].astype(float), kind[order].astype(np.int64)
                        base = np.log10((n + 0.5) / (counts.tokens + 0.5 * (counts.words + 1)))
                        inside = np.log10(within(n, kind, counts))
                        known = n > 0
                    yield texts(part, base, inside, known, kind)
                at = end

    def texts(part, base, inside, known, kind) -> pa.RecordBatch:
        data = [np.frombuffer(c.as_py(), "<u4") for c in part.column("codes")]
        return pa.RecordBatch.from_arrays([
            part.column("doc_id"), part.column("held_out"),
            pa.array([len(c) for c in data], pa.int64()),
            pa.array([int(known[c].sum()) for c in data], pa.int64()),
            pa.array([float(base[c].sum()) for c in data]),
            pa.array([float(inside[c].sum()) for c in data]),
            pa.array([kind[c].astype("<u2").tobytes() for c in data], pa.binary())], fields)

    empty = F.lit(None)
    rows = replies.select(F.lit(0).alias("kind"), "block", "place", "n", F.when(
        F.col("word").isin(counts.frequent), F.array_position(
            F.array(*map(F.lit, counts.frequent)), F.col("word")).cast("int") - 1)
        .otherwise(frequent + ending_class("word")).alias("c"),
        empty.cast("bigint").alias("doc_id"), empty.cast("boolean").alias("held_out"),
        empty.cast("binary").alias("codes"))
    both = rows.unionByName(coded.where("kind = 1").select(
        "kind", "block", empty.cast("int").alias("place"), empty.cast("bigint").alias("n"),
        empty.cast("int").alias("c"), "doc_id", "held_out", "codes"))
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(task(run), SCORED)


def within(n: np.ndarray, kind: np.ndarray, counts: Counts) -> np.ndarray:
    """Probability of words with ``n`` training tokens in their classes."""
    tokens, words = counts.class_tokens[kind], counts.class_words[kind]
    single = kind < len(counts.frequent)  # a class of one word
    seen = np.where(n > 0, n - counts.discount, counts.discount * words) / np.maximum(tokens, 1)
    return np.where(single | (tokens == 0), 1.0, seen)


# --- the model ------------------------------------------------------------------------------

class Model:
    """Vectors of the classes. Contexts are (class two before, class one before)."""

    def __init__(self, vectors: np.ndarray, positions: np.ndarray, outputs: np.ndarray,
                 bias: np.ndarray):
        self.vectors, self.positions, self.outputs, self.bias = vectors, positions, outputs, bias

    @classmethod
    def start(cls, frequency: np.ndarray, width: int = WIDTH, seed: int = 0) -> "Model":
        r = np.random.default_rng(seed)
        n = len(frequency)
        return cls(r.normal(0, 0.1, (n, width)).astype("f4"), np.ones((2, width), "f4"),
                   r.normal(0, 0.1, (n, width)).astype("f4"), np.log(frequency).astype("f4"))

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.positions, self.outputs, self.bias]

    def to_bytes(self) -> bytes:
        return b"".join(p.astype("<f4").tobytes() for p in self.parts())

    def like(self, data: bytes) -> "Model":
        out, at = [], 0
        flat = np.frombuffer(data, "<f4")
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).copy())
            at += p.size
        return Model(*out)

    def train(self, before: np.ndarray, target: np.ndarray, noise: np.ndarray,
              rng: np.random.Generator, sums: list[np.ndarray], rate: float = RATE) -> None:
        """One pass of noise-contrastive Adagrad steps. ``before``: (m, 2) contexts;
        ``noise``: probability of each class as noise; ``sums``: of squared gradients."""
        cumulative = np.cumsum(noise)
        log_noise = np.log(NOISE * noise)
        for k in range(0, len(target), BATCH):
            c, w = before[k:k + BATCH], target[k:k + BATCH]
            drawn = np.searchsorted(cumulative, rng.random(NOISE) * cumulative[-1], "right")
            drawn = np.minimum(drawn, len(noise) - 1)
            near = [self.vectors[c[:, i]] for i in range(2)]
            h = near[0] * self.positions[0] + near[1] * self.positions[1]
            q, qn = self.outputs[w], self.outputs[drawn]
            real = np.einsum("ij,ij->i", h, q) + self.bias[w] - log_noise[w]
            fake = h @ qn.T + self.bias[drawn] - log_noise[drawn]
            gr = (1 / (1 + np.exp(np.clip(real, -30, 30)))).astype("f4")  # up
            gf = -(1 / (1 + np.exp(-np.clip(fake, -30, 30)))).astype("f4")
            gh = gr[:, None] * q + gf @ qn
            n = len(self.bias)
            out = np.zeros_like(self.outputs)
            add_rows(out, w, gr[:, None] * h)
            add_rows(out, drawn, gf.T @ h)
            bias = np.bincount(w, gr, minlength=n) + np.bincount(drawn, gf.sum(0), minlength=n)
            vectors = np.zeros_like(self.vectors)
            for i in range(2):
                add_rows(vectors, c[:, i], gh * self.positions[i])
            positions = np.stack([(gh * x).sum(0) for x in near])
            for p, g, s in zip(self.parts(), (vectors, positions, out, bias), sums):
                g = g / len(w) ** 0.5
                s += g * g
                p += (rate * g / np.sqrt(s + 1e-3)).astype("f4")

    def normalised(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (class two before, class), (class one before, class), and the log
        of the normaliser of every pair of classes before."""
        n = len(self.bias)
        far = (self.vectors * self.positions[0]) @ self.outputs.T
        near = (self.vectors * self.positions[1]) @ self.outputs.T + self.bias
        log_z = np.empty((n, n), "f4")
        for a in range(n):  # a batch: all contexts with the same class two before
            x = near + far[a]
            top = x.max(1)
            log_z[a] = top + np.log(np.exp(x - top[:, None]).sum(1))
        return far, near, log_z


def add_rows(out: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """out[index] += rows, with repeated indices."""
    order = np.argsort(index, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(index[order]) > 0]))
    out[index[order][first]] += np.add.reduceat(rows[order], first, axis=0)


def contexts(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(class two before, class one before) and class of all tokens; a text starts
    after ends (class 0)."""
    target = np.concatenate(classes).astype(np.int64)
    starts = np.cumsum([0, *map(len, classes)])[:-1]
    before = np.zeros((len(target), 2), np.int64)
    before[1:, 1], before[2:, 0] = target[:-1], target[:-2]
    before[starts] = 0
    second = starts + 1
    before[second[second < len(target)], 0] = 0
    before[starts] = 0
    return before, target


def fit(texts: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """Train on the texts not held out, each in one of the rounds."""
    spark = texts.sparkSession
    frequency = (counts.class_tokens + 0.5) / (counts.class_tokens + 0.5).sum()
    model = Model.start(frequency)
    sums = [np.zeros_like(p, "f8") for p in model.parts()]
    learn = texts.where(~F.col("held_out")).select("doc_id", "classes")
    for k in range(rounds):
        held = spark.sparkContext.broadcast((model, sums, frequency))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, before, noise = held.value
            own, squares = start.like(start.to_bytes()), [s.copy() for s in before]
            rng, tokens = np.random.default_rng(k), 0
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    classes = [np.frombuffer(c.as_py(), "<u2")
                               for c in batch.column("classes")[at:at + 512]]
                    where, target = contexts(classes)
                    mixed = rng.permutation(len(target))
                    own.train(where[mixed], target[mixed], noise, rng, squares)
                    tokens += len(target)
            if tokens:
                second = b"".join(s.astype("<f4").tobytes() for s in squares)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tokens]), pa.array([own.to_bytes()]), pa.array([second])],
                    ["tokens", "model", "squares"])

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens, total = 0, None
            for batch in batches:
                for n, *data in zip(*(c.to_pylist() for c in batch.columns)):
                    add = [n * np.frombuffer(x, "<f4").astype("f8") for x in data]
                    total = add if total is None else [a + b for a, b in zip(total, add)]
                    tokens += n
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tokens]), *(pa.array([(x / tokens).astype("<f4").tobytes()])
                                           for x in total)], ["tokens", "model", "squares"])

        schema = "tokens bigint, model binary, squares binary"
        mine = learn.where(F.pmod(F.xxhash64("doc_id", "classes"), F.lit(rounds)) == k)
        trained = mine.mapInArrow(task(run), schema)
        # means of means: what reaches the driver grows with the square root of the corpus
        groups = max(1, int((counts.tokens / TASK_TOKENS) ** 0.5))
        rows = (trained.repartition(groups).mapInArrow(task(mean), schema)
                .sort("tokens", "model").collect())
        if rows:
            total = sum(r.tokens for r in rows)
            average = [sum(r.tokens * np.frombuffer(r[name], "<f4").astype("f8") for r in rows) / total
                       for name in ("model", "squares")]
            model = model.like(average[0].astype("<f4").tobytes())
            sums = [x.astype("f8") for x in
                    model.like(average[1].astype("<f4").tobytes()).parts()]
        held.unpersist()
    return model


def with_scores(texts: DataFrame, model: Model, counts: Counts) -> DataFrame:
    held = texts.sparkSession.sparkContext.broadcast(model.normalised())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far, near, log_z = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                classes = [np.frombuffer(c.as_py(), "<u2") for c in part.column("classes")]
                before, target = contexts(classes)
                log_p = (far[before[:, 0], target] + near[before[:, 1], target]
                         - log_z[before[:, 0], before[:, 1]])
                ends = np.cumsum([0, *map(len, classes)])
                total = np.concatenate([[0.0], np.cumsum(log_p, dtype="f8")])
                score = np.diff(total[ends]) / np.log(10) + part.column("within").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known",
                                                "base_score")), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return texts.mapInArrow(task(run), "doc_id bigint, held_out boolean, n_tokens bigint, "
                                 "n_known bigint, base_score double, score double").select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def language_model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    ship_package(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    coded = staged(coded_texts(docs.select(
        doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, 5) == 1, F.lit(False)).alias("held_out"),
        F.col("text"))), "coded")
    words = (coded.where("kind = 0")
             .select("block", "first",
                     F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w"))
             .select("block", (F.col("first") + F.col("i")).alias("place"),
                     F.col("w.words").alias("word"), F.col("w.counts").alias("n")))
    places = staged(words.groupBy("word").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("block", "place")).alias("at")), "words")
    counts = count_words(places)
    replies = places.select("word", "n", F.explode("at").alias("a")).select("word", "n", "a.*")
    texts = staged(scored_texts(coded, replies, counts), "scored")
    return with_scores(texts, fit(texts, counts), counts)
