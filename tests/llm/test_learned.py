"""Language identification, toxicity and language-model scores."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from laketier.llm import language, log_bilinear, toxicity
from laketier.llm.language import language_id, viterbi
from laketier.llm.log_bilinear import language_model_scores

SF = "/root/testdata/sf0.01"


def rest(i, n):
    return None if i is None else zlib.crc32(str(i).encode()) % n


# --- language -------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [2, 3, 100])
def test_viterbi_equals_brute_force(block):
    r = np.random.default_rng(block)
    for _ in range(80):
        labels = int(r.integers(1, 4))
        bounds = np.concatenate([[0], np.cumsum(r.integers(0, 8, 4))])
        scores, penalty = r.normal(size=(bounds[-1], labels)), float(r.choice([0.3, 1.0, 2.5]))
        found = viterbi(scores, bounds, penalty, block)
        for a, b in zip(bounds[:-1], bounds[1:]):
            def value(path, part=scores[a:b]):
                return (sum(part[t, k] for t, k in enumerate(path))
                        - penalty * sum(x != y for x, y in zip(path, path[1:])))
            best = max(map(value, itertools.product(range(labels), repeat=b - a)))
            assert value(found[a:b]) == pytest.approx(best)


GREEK = "και το να της που για με στην από είναι δεν θα τον αυτό ένα"
RUSSIAN = "и в не на что он с как это по но они мы все она так его"
DUTCH = "de het een van en in is dat op te zijn met voor niet aan"
ITALIAN = "il di che e la per un in con non una sono è lo come gli"


def test_spans_of_mixed_texts_and_odd_rows(documents):
    r = random.Random(4)
    langs = {"el": GREEK, "ru": RUSSIAN, "nl": DUTCH, "it": ITALIAN}

    def text(lang, n):
        return " ".join(r.choice(langs[lang].split()) for _ in range(n))

    rows = [(i, text(lang, 30), lang) for i, lang in enumerate([*langs] * 30)]
    mixed = text("nl", 40) + " " + text("it", 15) + " " + text("ru", 5)
    odd = [(1000, mixed, None), (1001, None, "nl"), (1002, "", "nl"), (1003, "12 + 3 !!", "it"),
           (1004, "ABC 漢字 漢字", None), (1005, "漢字", None), (None, text("it", 20), "it"),
           (3, text("ru", 9), "ru"), (3, text("ru", 9), None), (1006, text("el", 20_000), None)]
    got = {}
    for row in language_id(documents(rows + odd)).collect():
        got.setdefault(row.doc_id, []).append(row)
    assert all(len(got[i]) == 1 for i, _, _ in rows if i != 3) and len(got[3]) == 3
    assert sum(got[i][0].lang_pred == lang for i, _, lang in rows if i != 3) >= 118
    assert all(x.held_out == (rest(i, 5) == 0) for i, v in got.items() for x in v)
    assert [s.lang for s in got[1000][0].spans] == ["nl", "it", "ru"]
    assert [abs(s.words - n) <= 2 for s, n in zip(got[1000][0].spans, (40, 15, 5))] == [True] * 3
    assert got[1000][0].lang_pred == "nl" and 0.5 < got[1000][0].score < 0.8
    for i in (1001, 1002, 1003):
        assert (got[i][0].lang_pred, got[i][0].score, got[i][0].spans) == ("und", 0.0, [])
    assert got[1005][0].lang_pred in langs and got[1005][0].score == 0.0
    assert got[1006][0].lang_pred == "el" and got[1006][0].score == 1.0
    assert got[None][0].lang_pred == "it" and not got[None][0].held_out
    none = documents(rows)
    assert language_id(none.where("doc_id < 0")).collect() == []
    assert {x.lang_pred for x in language_id(none.withColumn("lang", language.F.lit(None).cast("string"))
                                             ).collect()} == {"und"}


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)


# --- toxicity -------------------------------------------------------------------------------

def test_composition_runs_all_transducers_at_once():
    move, marks = toxicity.compose(toxicity.MODIFIERS)
    for word in itertools.product(range(6), repeat=5):
        state, parts = 0, [0] * len(toxicity.MODIFIERS)
        for c in word:
            want = sum(p.mark(s, c) << k for k, (p, s) in enumerate(zip(toxicity.MODIFIERS, parts)))
            assert marks[state, c] == want
            state = move[state, c]
            parts = [p.step(s, c) for p, s in zip(toxicity.MODIFIERS, parts)]


def test_clauses_not_words_are_scored():
    import pyarrow as pa
    grammar = toxicity.Grammar({"idiot": 4.0}, {"blarg": 5.0})
    texts = ["You are an idiot.", "An idiot passed by.", "You are not an idiot.",
             "The paper said he was an idiot.", "I will kill you, they said", "You will kill time.",
             "We beat eggs.", "Not today. Idiot!", None, "", "blargifications", "a good day"]
    x = grammar.features(pa.array(texts, pa.string()))
    column = {f: i for i, f in enumerate(toxicity.FEATURES)}
    assert [toxicity.FEATURES[row[:5].argmax()] if row.any() else None for row in x] == [
        "targeted", "plain", "negated", "reported", "threat", "threat", None, "plain", None, None,
        "plain", None]
    score = grammar.score(x)
    assert score[0] > score[1] > score[2] > score[11] and score[0] > score[3] > score[11]
    assert x[10, column["strongest"]] == pytest.approx(math.log1p(5.0))
    assert ((score > 0) & (score < 1)).all() and score[8] == score[9] == score[11]


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in got)
    assert hits >= 0.7 * sum(r.toxic for r in got)
    assert sum(r.predicted and not r.toxic for r in got) <= 1


def test_toxicity_learns_words_and_stems_and_takes_odd_rows(spark, documents, words):
    r = random.Random(9)
    rows = [(i, words(30)) for i in range(200)]
    toxic = {i for i in range(0, 200, 3)}
    rows = [(i, t + (" zorkfest" + r.choice(["a", "en", "ion"]) if i in toxic else "")) for i, t in rows]
    odd = [(900, None), (901, ""), (902, "zorkfestival, zorkfesten"), (None, "idiot"), (903, words(9)),
           (903, "x")]
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows]
                                   + [(None, 1, 1), (5, None, None), (6, 0, 1), (7, 1, 5)],
                                   "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(documents(rows + odd), labels).collect()
    assert len(got) == len(rows) + len(odd)
    by = {x.doc_id: x for x in got}
    assert by[902].predicted == 1 and by[900].score == by[901].score < 0.5
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 200]
    assert all(x.predicted == int(x.doc_id in toxic) for x in held if x.doc_id not in (6, 7))
    assert all(x.held_out == (rest(x.doc_id, 3) == 1) and 0 <= x.score <= 1 for x in got)
    none = documents(rows).where("doc_id < 0")
    assert toxicity.toxicity(none, labels).collect() == []
    assert len(toxicity.toxicity(documents(rows), labels.where("toxic < 0")).collect()) == 200


# --- language model -------------------------------------------------------------------------

def test_model_is_normalised_and_learns():
    r = np.random.default_rng(0)
    n = 12
    chain = r.dirichlet(np.full(n, 0.2), n)
    data = [0]
    for _ in range(60_000):
        data.append(int(r.choice(n, p=chain[data[-1]])))
    before, target = log_bilinear.contexts([np.array(data)])
    frequency = np.bincount(target, minlength=n) + 0.5
    frequency = frequency / frequency.sum()
    model = log_bilinear.Model.start(frequency, 8)
    sums = [np.zeros_like(p, "f8") for p in model.parts()]
    for _ in range(4):
        model.train(before, target, frequency, r, sums)
    far, near, log_z = model.normalised()
    every = far[:, None, :] + near[None, :, :] - log_z[:, :, None]
    assert np.exp(every).sum(2) == pytest.approx(np.ones((n, n)), abs=1e-4)
    score = every[before[:, 0], before[:, 1], target].mean()
    best = np.log(chain[before[1:, 1], target[1:]] + 1e-12).mean()
    base = np.log(frequency[target]).mean()
    assert base + 0.7 * (best - base) < score < best + 0.02


def test_contexts_start_after_ends():
    before, target = log_bilinear.contexts([np.array([5, 6, 0]), np.array([0]), np.array([7, 0])])
    assert target.tolist() == [5, 6, 0, 0, 7, 0]
    assert before.tolist() == [[0, 0], [0, 5], [5, 6], [0, 0], [0, 0], [0, 7]]


def brute_base(rows):
    count = Counter()
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    for (i, _), w in zip(rows, tokens):
        if rest(i, 5) != 1:
            count.update(w)
    n, v = sum(count.values()), len(count)
    return sorted(((i, rest(i, 5) == 1, len(w), sum(count[x] > 0 for x in w), n,
                    round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
                   for (i, _), w in zip(rows, tokens)), key=str)


@pytest.mark.parametrize("block_bytes", [48 << 20, 1])
def test_base_scores_equal_brute_force(documents, words, block_bytes, monkeypatch):
    monkeypatch.setattr(log_bilinear, "BLOCK_BYTES", block_bytes)
    rows = [(i, words(random.Random(i).randint(0, 80))) for i in range(120)] + [
        (500, None), (501, ""), (502, " \n"), (503, "A\x1cb É é"), (None, words(20)),
        (7, words(9)), (7, words(9)), (504, words(20_000))]
    got = language_model_scores(documents(rows)).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                    round(r.base_score, 6)) for r in got), key=str) == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert language_model_scores(documents(rows).where("doc_id < 0")).collect() == []
    alone = language_model_scores(documents([r for r in rows if rest(r[0], 5) == 1])).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in alone)


def test_words_of_a_class_and_its_unknown_sum_to_one():
    counts = log_bilinear.Counts(30, 5, [" ", "a"], 0.6, np.array([9, 8, 13, 0.]), np.array([1, 1, 3, 0.]))
    seen = log_bilinear.within(np.array([9., 8., 7., 5., 1., 0., 0.]), np.array([0, 1, 2, 2, 2, 2, 3]), counts)
    assert seen[:2].tolist() == [1, 1] and seen[2:6].sum() == pytest.approx(1) and seen[6] == 1


def test_scores_beat_the_base_on_held_out_documents(spark):
    got = language_model_scores(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.85 * len(got)
