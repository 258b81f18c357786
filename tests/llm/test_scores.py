from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapseflow.llm import labelled, quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int"


def auc(scores, labels) -> float:
    one = [s for s, x in zip(scores, labels, strict=True) if x]
    none = [s for s, x in zip(scores, labels, strict=True) if not x]
    return sum((a > b) + 0.5 * (a == b) for a in one for b in none) / (len(one) * len(none))


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(360):
        text = prose(i, rng.randrange(20, 120))
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            words = text.split()
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grobble", "snark" + rng.choice(["le", "ify", "ed"]), "fizzwit"]))
            text = " ".join(words)
        elif rng.random() < 0.1:
            text += " a snark hunt"
        if bad:
            text = {0: text.upper().replace(" ", "!! "), 1: text.replace(" ", " | "), 2: " ".join(w + " " + w for w in text.split())}[i % 3]
        docs.append((i, text))
        if i % 10:
            labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def test_quality_of_held_out_texts(spark, make, corpus, odd_texts):
    docs, labels = corpus
    rows = make(docs + [(1000 + i, t) for i, t in enumerate(odd_texts)] + [(None, "no id"), (3, docs[3][1])], clashing=True)
    got = quality.quality_scores(rows, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs) + len(odd_texts) + 2
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    held = [(by_id[i], q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert auc(*zip(*held, strict=True)) > 0.97
    share = np.mean([q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1])
    assert math.isclose(by_id[1000], share) and by_id[1000] == by_id[1001] == by_id[1002]


def test_votes_equal_brute_force():
    rng = np.random.default_rng(2)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    model = quality.Model(np.ones(quality.FEATURES), np.eye(8), unit(rng.normal(size=(90, 8))), rng.integers(0, 2, 90).astype(float))
    vectors = np.concatenate([unit(rng.normal(size=(700, 8))), np.zeros((1, 8), np.float32)])
    got = quality.votes(model, vectors, 5)
    for v, score in zip(vectors[:-1], got[:-1], strict=True):
        sims = sorted(((float(model.vectors[i] @ v), model.labels[i]) for i in range(90)), reverse=True)[:5]
        weight = sum(max(s, 0) for s, _ in sims)
        assert math.isclose(score, sum(max(s, 0) * x for s, x in sims) / weight, abs_tol=1e-5)
    assert got[-1] == model.labels.mean()


def test_ties_go_to_the_first_rows():
    same = np.tile(np.array([[1, 0]], np.float32), (9, 1))
    labels = np.array([1, 1, 0, 1, 0, 0, 0, 0, 0], float)
    model = quality.Model(np.ones(quality.FEATURES), np.eye(2), same, labels)
    assert quality.votes(model, same[:1], 4).tolist() == [0.75]
    # Nearer ones still come before the tied ones.
    model.vectors[8] = [0.6, 0.8]
    got = quality.votes(model, np.array([[0.6, 0.8]], np.float32), 2)
    assert math.isclose(got[0], 0.6 / 1.6, abs_tol=1e-6)


def test_one_id_on_a_third_of_the_rows(spark, make, corpus):
    docs, labels = corpus
    hot = [(1, f"{docs[1][1]} {'x' * (k % 3)}") for k in range(180)]
    labels = spark.createDataFrame(labels, LABELS)
    sample = labelled.labelled_sample(make(docs + hot), labels, "quality", F.lit(True), 50)
    rows = sample.collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == 50
    sample = labelled.labelled_sample(make(docs + hot), labels, "toxic", F.lit(True), 10_000)
    assert sample.count() == sample.select("doc_id").distinct().count() == 324
    assert quality.quality_scores(make(docs + hot), labels).count() == len(docs) + 180


def test_features_count_whole_texts(prose):
    text = prose(1, 5000)
    where, feature, count = quality.features(pa.array([text, None, text + " x x"]))
    assert count[where == 0].sum() == 3 * 5000 and not (where == 1).any() and count[where == 2].sum() == 3 * 5002
    assert (np.diff(where) >= 0).all()
    repeats = {w: c for w, f, c in zip(where, feature, count, strict=True) if f == quality.FEATURES - 1}
    assert repeats.get(2, 0) == repeats.get(0, 0) + 1


def test_nothing_to_learn_from(spark, make):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(1, None, None), (2, 7, 5), (99, 1, 1), (None, 1, 1)], LABELS)
    for labels in (none, odd):
        rows = quality.quality_scores(make([(1, "a b"), (2, None)]), labels).collect()
        assert [r["score"] for r in rows] == [0.5, 0.5]
        assert toxicity.toxicity_scores(make([(1, "a b"), (2, None)]), labels).where("predicted = 0").count() == 2
        assert quality.quality_scores(make([]), labels).count() == 0
        assert toxicity.toxicity_scores(make([]), labels).count() == 0


def test_quality_stage_keeps_columns(spark, make, corpus):
    docs, labels = corpus
    rows = make(docs, clashing=True)
    got = quality.of_quality(rows, spark.createDataFrame(labels, LABELS))
    assert got.columns == rows.columns
    clean = {i for i, q, _ in labels if q}
    kept = {r["doc_id"] for r in got.collect()}
    assert len(clean & kept) > 0.97 * len(clean) and len(kept) < 0.85 * len(docs)


def test_toxicity_of_held_out_texts(spark, make, corpus, odd_texts):
    docs, labels = corpus
    rows = make(docs + [(1000 + i, t) for i, t in enumerate(odd_texts)] + [(None, "no id")], clashing=True)
    got = toxicity.toxicity_scores(rows, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs) + len(odd_texts) + 1
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    held = [(by_id[i]["score"], x) for i, _, x in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert auc(*zip(*held, strict=True)) > 0.95
    assert all(by_id[1000 + k]["predicted"] == 0 for k in range(4))


def test_disguised_words_and_exceptions():
    lexicon = toxicity.Lexicon({" clown ": 3.0, " idio": 2.0}, {" class clown "}, (-2.0, 2.0, 0.0))
    matcher = lexicon.automaton()

    def weight(text):
        return toxicity.weight_of(matcher, toxicity.folded(text))

    assert weight("such a CLOWN, an 1d10tic сlоwn") == 8.0
    assert weight("c1own ｉｄｉｏｔ i​diot") == 7.0
    assert weight("class clown") == 0.0 and weight("class clown clown") == 3.0
    assert weight("clowns vidiot") == 0.0
    assert toxicity.score_of(lexicon, matcher, "a clown") > 0.5 > toxicity.score_of(lexicon, matcher, None)


def test_exceptions_against_brute_force():
    lexicon = toxicity.Lexicon({" ab ": 1.0, " cd": 2.0}, {" x ab ", " ab cd ", " cd x "}, (-2.0, 2.0, 0.0))
    matcher = lexicon.automaton()
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.choice(["ab", "cd", "cde", "x"]) for _ in range(rng.randrange(9))]
        want = 0.0
        for i, w in enumerate(words):
            near = {(i - 1, "x", "ab"), (i - 1, "ab", "cd"), (i, "ab", "cd"), (i, "cd", "x")}
            spared = any(0 <= k < len(words) - 1 and words[k : k + 2] == [a, b] for k, a, b in near)
            want += 0.0 if spared else {"ab": 1.0, "cd": 2.0, "cde": 2.0}.get(w, 0.0)
        assert toxicity.weight_of(matcher, toxicity.folded(" ".join(words))) == want, words
    # Very many exceptions in one text take time in proportion.
    assert toxicity.weight_of(matcher, toxicity.folded("x ab " * 100_000 + "ab")) == 1.0


def test_enclosed_and_mathematical_letters():
    assert toxicity.folded("𝐜𝐥𝐨𝐰𝐧 𝔠𝔩𝔬𝔴𝔫 ⓒⓛⓞⓦⓝ 🄲🄻🄾🅆🄽 ﬁne") == " clown clown clown clown fine "


def test_longer_texts_weigh_less():
    lexicon = toxicity.Lexicon({" scum ": 3.0}, set(), (-6.0, 0.5, 1.0))
    matcher = lexicon.automaton()
    scores = [toxicity.score_of(lexicon, matcher, "scum " + "fine word " * n) for n in (1, 10, 100, 1000)]
    assert scores == sorted(scores, reverse=True) and scores[0] > 0.5 > scores[-1]
