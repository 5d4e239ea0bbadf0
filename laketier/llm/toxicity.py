"""Operator 2: toxicity by a weighted finite-state pattern grammar.

Small transducers read a clause word by word, each keeping a state of its own:
insults and threats emit their weight, a target nearby strengthens a match (before
it, or after it: a second machine reads the clause from its end), a negation before it or a verb of reported speech in front of it marks it as such.
The composition of each direction is one transition table (``compose``); a clause is scored as a
whole by what its matches emit, never a word by itself: matches land in separate
sums by their marks, and a logistic model over a document's sums gives the score.

The patterns of the insult transducer are words and stems (word beginnings). Some
come with the grammar; the others, and all weights, are learned from labelled rows:
those far commoner in toxic texts than chance allows. The logistic weights are drawn
to the grammar's own where the labels say nothing.

Learning takes about ``SAMPLE`` texts of either label, chosen by a hash of the id,
and keeps ``PATTERNS`` patterns at most; scoring reads every whole text.

Defined cases: NULL and empty texts have no clause and score as the model's constant;
without labels the grammar's own weights are used; of several labels for an id the
larger counts; rows with NULL or repeated ids are scored one by one, NULL ids are not
held out and not learned from; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketier.llm.common import remainder, ship_package, task
from laketier.llm.tokens import slices, split_blanks

SAMPLE = 8000
PATTERNS = 4000
STEMS = (4, 5, 6, 7)  # lengths of learned word beginnings
LEAST_TEXTS, LEAST_Z, LEAST_ODDS = 4, 6.0, 1.5
THRESHOLD = 0.7
STOPS = '.!?;:"»“”…'  # end a clause

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
OWN_WEIGHT = 4.0
# The grammar's own words: English, and the closed classes of the other languages.
OWN = {
    INSULT: "dumb imbecile filthy vermin cretin bastard jerk".split(),
    THREAT: "kill hurt destroy burn shoot stab strangle beat smash crush punish".split(),
    TARGET: "you your yours u they them their he she him her people du dich dir dein ihr euch sie "
            "tu toi ton ta vous votre ils elles tú te usted ustedes ellos".split(),
    NEGATION: "not no never neither isn't aren't don't doesn't nicht kein keine nie niemals pas "
              "jamais ne nunca ni tampoco".split(),
    REPORT: "said says say wrote writes called calls quoted claimed reported sagte sagt schrieb "
            "nannte dit disait écrit appelé dijo dice escribió llamó".split(),
}
FEATURES = ("plain", "targeted", "negated", "reported", "threat", "strongest", "density")
# Logistic weights the fit is drawn to, and the constant before any evidence.
OWN_MODEL = np.array([1.0, 1.2, 0.4, 0.3, 0.8, 0.5, 0.5]), -4.0


@dataclass(frozen=True)
class Transducer:
    """``step`` gives the next state, ``mark`` whether a match read now gets the mark."""

    states: int
    step: Callable[[int, int], int]
    mark: Callable[[int, int], bool]


def near(symbol: int, reach: int) -> Transducer:
    """Marks matches at most ``reach`` words after ``symbol`` (state: words left)."""
    return Transducer(reach + 1, lambda s, c: reach if c == symbol else max(0, s - 1),
                      lambda s, c: s > 0)


def after(symbol: int) -> Transducer:
    """Marks matches anywhere after ``symbol`` in the clause."""
    return Transducer(2, lambda s, c: 1 if s or c == symbol else 0, lambda s, c: s == 1)


MODIFIERS = (near(TARGET, 4), near(NEGATION, 3), after(REPORT))
#: Read from the clause's end, so they mark matches by what follows; bits as above.
FOLLOWERS = (near(TARGET, 4),)


def compose(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The product machine: next state and set of marks (bit i: part i), by state and
    class. State 0 is the start."""
    states = list(product(*(range(p.states) for p in parts)))
    number = {s: i for i, s in enumerate(states)}
    move = np.zeros((len(states), 6), np.int64)
    marks = np.zeros((len(states), 6), np.int64)
    for s, i in number.items():
        for c in range(6):
            move[i, c] = number[tuple(p.step(x, c) for p, x in zip(parts, s))]
            marks[i, c] = sum(p.mark(x, c) << k for k, (p, x) in enumerate(zip(parts, s)))
    return move, marks


@dataclass
class Grammar:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=lambda: OWN_MODEL[0].copy())
    constant: float = OWN_MODEL[1]

    def __post_init__(self):
        self.machine = compose(MODIFIERS)
        self.backward = compose(FOLLOWERS)
        self.closed = {w: c for c in (THREAT, TARGET, NEGATION, REPORT) for w in OWN[c]}

    def read(self, word: str) -> tuple[int, float]:
        """Class and weight of a word; the strongest pattern that it fits counts."""
        word = word.strip("'")
        if "'" in word and word not in self.closed:
            word = word[:word.index("'")]
        best = self.words.get(word, 0.0)
        for n in STEMS:
            if n > len(word):
                break
            best = max(best, self.stems.get(word[:n], 0.0))
        return (INSULT, best) if best else (self.closed.get(word, OTHER), OWN_WEIGHT)

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row of ``FEATURES`` per text: what the matches of its clauses emit."""
        out = np.zeros((len(texts), len(FEATURES)))
        words, codes, bounds = split_blanks(cut(pc.utf8_lower(pc.fill_null(texts, ""))))
        if not len(codes):
            return out
        plain = words.to_pylist()
        read = [self.read(w.rstrip(STOPS)) for w in plain]
        kind = np.fromiter((c for c, _ in read), np.int64, len(read))
        weight = np.fromiter((w for _, w in read), float, len(read))
        ends = np.fromiter((w[-1:] in STOPS and w != "" for w in plain), bool, len(plain))
        text = np.repeat(np.arange(len(texts)), np.diff(bounds))
        kinds = kind[codes]
        stop = ends[codes]
        first = np.concatenate([[True], stop[:-1] | (text[1:] != text[:-1])])
        clause = np.cumsum(first) - 1
        matched = np.unique(clause[(kinds == INSULT) | (kinds == THREAT)])
        begin = np.append(np.flatnonzero(first), len(codes))
        move, marks = self.machine
        back_move, back_marks = self.backward
        for c in matched.tolist():
            a, b = begin[c], begin[c + 1]
            row = out[text[a]]
            clause_kinds = kinds[a:b].tolist()
            state, follows = 0, []
            for k in reversed(clause_kinds):
                if k == INSULT or k == THREAT:
                    follows.append(int(back_marks[state, k]))
                state = back_move[state, k]
            state, found = 0, []
            for k, w in zip(clause_kinds, weight[codes[a:b]].tolist()):
                if k == INSULT or k == THREAT:
                    found.append((k, w, int(marks[state, k]) | follows.pop()))
                state = move[state, k]
            for k, w, mark in found:
                if mark & 4:
                    row[3] += w
                elif mark & 2:
                    row[2] += w
                elif k == THREAT:  # without a target a threat verb is an ordinary verb
                    row[4] += w if mark & 1 else 0.0
                else:
                    row[1 if mark & 1 else 0] += w
                if k == INSULT:
                    row[5] = max(row[5], w)
        out[:, 6] = 100 * out[:, :5].sum(1) / np.maximum(np.diff(bounds), 1)
        return np.log1p(out)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.coefficients + self.constant)))


def cut(texts: pa.Array) -> pa.Array:
    """Texts as learning reads them: runs of letters (and apostrophes between them) apart,
    and the signs that end a clause after the word before them."""
    texts = pc.replace_substring_regex(texts, rf"[^\p{{L}}'{STOPS}]+", " ")
    return pc.replace_substring_regex(texts, rf" ?([{STOPS}])[{STOPS} ]*", r"\1 ")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0,
                 steps: int = 50) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps, drawn to ``OWN_MODEL``."""
    design = np.hstack([x, np.ones((len(x), 1))])
    own = np.append(*OWN_MODEL)
    pull = np.append(np.full(x.shape[1], ridge), 0.01 * ridge)
    beta = own.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - pull * (beta - own)
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def beginnings(words: str, length: int) -> Column:
    """The first ``length`` letters of the words that have them, starred."""
    return F.transform(F.filter(words, lambda w: F.length(w) >= length),
                       lambda w: F.concat(F.substring(w, 1, length), F.lit("*")))


def patterns(sample: DataFrame, toxic: int, clean: int) -> list:
    """Words and stems with their weight (log odds), the most telling first."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    stems = [beginnings("words", n) for n in STEMS]
    total = max(1, toxic + clean)
    expected = (F.col("t") + F.col("c")) * (toxic / total)
    odds = (F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1)))
    return (sample.select("toxic", words.alias("words"))
            .select("toxic", F.explode(F.array_distinct(F.concat("words", *stems))).alias("pattern"))
            .groupBy("pattern").agg(F.sum("toxic").alias("t"),
                                    F.sum(1 - F.col("toxic")).alias("c"))
            .where(F.col("t") >= LEAST_TEXTS)
            .withColumn("z", (F.col("t") - expected) / F.sqrt(expected * (1 - toxic / total)))
            .withColumn("odds", odds)
            .where((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
            .orderBy(F.desc("z"), "pattern").limit(PATTERNS).collect())


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Learn from ``labels`` (doc_id, toxic) and the texts they name."""
    ship_package(docs.sparkSession)
    labels = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
              .agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, sample / n) for k, n in sizes.items()}
    own = {w: OWN_WEIGHT for w in OWN[INSULT]}
    if len(share) < 2:
        return Grammar(own)
    # about 2 * sample ids: small enough to broadcast whatever the table's size
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (1 << 20) * F.when(
        F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("text", "toxic"))
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    learned, stems = {}, {}
    for r in patterns(rows, toxic, clean):
        (stems if r.pattern.endswith("*") else learned)[r.pattern.rstrip("*")] = float(r.odds)
    grammar = Grammar({**own, **learned}, stems)
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                x = held.value.features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[:, i].copy()) for i in range(x.shape[1])), part.column("toxic")],
                    [*FEATURES, "toxic"])

    data = rows.mapInArrow(task(emit), ", ".join(f"{f} double" for f in FEATURES) + ", toxic int").toArrow()
    if data.num_rows:
        x = np.stack([data[f].to_numpy() for f in FEATURES], 1)
        y = data["toxic"].to_numpy()
        weight = np.where(y == 1, 1 / share[1], 1 / share[0])
        order = np.lexsort(np.vstack([x.T, y]))  # the same sums in any order of the rows
        grammar.coefficients, grammar.constant = fit_logistic(
            x[order], y[order], weight[order] / weight.mean())
    return grammar


def score_texts(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score, predicted and the emitted sums for every row."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                x = held.value.features(part.column("text"))
                score = held.value.score(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score),
                     pa.array((score >= THRESHOLD).astype(np.int32)),
                     *(pa.array(x[:, i].copy()) for i in range(x.shape[1]))],
                    ["doc_id", "score", "predicted", *FEATURES])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).mapInArrow(
        task(run), "doc_id bigint, score double, predicted int, "
             + ", ".join(f"{f} double" for f in FEATURES)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    grammar = fit(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    return score_texts(docs, grammar).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score", "predicted")
