from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from lapseflow.llm import fingerprints as d
from lapseflow.llm import tokens


def brute(docs):
    order = sorted(docs, key=lambda r: -r[0])
    out = {}
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + after[:third]
        out[key] = (len(text), hashlib.sha256(new.encode()).hexdigest())
    return out


def test_edits_equal_brute_force(make, prose, odd_texts):
    texts = [*odd_texts, "é漢😀 abc", "x", *[prose(i, 5 + 7 * i) for i in range(30)]]
    docs = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows = make(docs, clashing=True).repartition(5)
    got = d.compared_with_next(rows).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute(docs)
    assert len(got) == len(docs) and all(0 <= r[n] <= 1 for r in got for n in ("near_edited", "near_next"))
    by_id = {r["doc_id"]: r for r in got}
    known = d.lexicon(make(docs))
    for i, text in docs:
        assert by_id[i]["fingerprint"] == d.fingerprints(pa.array([text], pa.string()), known)[0]
    order = sorted(by_id, reverse=True)
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        assert by_id[i]["near_next"] == d.likeness(by_id[i]["fingerprint"], by_id[after]["fingerprint"])


def test_lexicon_counts_all_texts(make, prose):
    docs = [(i, f"{prose(i % 7, 40)} common word{i}") for i in range(70)] + [(None, None)]
    counts = {}
    for _, text in docs:
        for w in set(tokens.spelled(text, tokens.ALNUM)):
            counts[w] = counts.get(w, 0) + 1
    want = sorted(w for w, n in counts.items() if 0.05 * 71 <= n <= 0.5 * 71)
    hashes = tokens.words(pa.array([w.decode() for w in want]), tokens.ALNUM).hashes
    keys = tokens.shingles(tokens.words(pa.array([w.decode() for w in want]), tokens.ALNUM), 1)[0]
    assert len(hashes) == len(want)
    assert d.lexicon(make(docs), 0.05, 0.5).tolist() == sorted(keys.tolist())


def test_likeness_tells_edits_from_other_texts(make, prose):
    docs = [(i, prose(i, 120)) for i in range(60)]
    got = d.compared_with_next(make(docs)).collect()
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.95


def test_order_of_words_and_equal_texts():
    known = np.zeros(0, np.uint64)
    a, b, c, e, f = d.fingerprints(pa.array(["one two three", "three, two ONE one", "one two four", None, "?"]), known)
    assert a == b != c and d.likeness(a, b) == 1 and d.likeness(a, c) < 1
    assert e == f and d.likeness(e, f) == 1 and d.likeness(a, e) == 0


def test_few_rows(make, prose):
    assert d.compared_with_next(make([])).count() == 0
    alone = d.compared_with_next(make([(4, prose(1, 30))])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1
    rows = d.compared_with_next(make([(None, "a b c"), (7, "d e f"), (7, "d e f"), (7, "x y z")])).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == [7, 7, 7, None]


def test_a_third_of_copies_is_told_from_other_texts(make, prose):
    # All words of the copies stand in too many documents for the lexicon, those of the others don't.
    docs = [(i, prose(777, 90) if i % 3 == 0 else prose(i, 90)) for i in range(90)]
    got = {r["doc_id"]: r for r in d.compared_with_next(make(docs)).collect()}
    known = d.lexicon(make(docs))
    copies = [got[i] for i in range(0, 90, 3)]
    assert d._lexical(*d._distinct(pa.array([prose(777, 90)])), known)[1].all()
    # By words in the lexicon alone, the edited text would share none with the copy.
    assert all(r["near_edited"] > 0.1 > r["near_next"] for r in copies)
    assert len({r["fingerprint"] for r in copies}) == 1


def test_like_is_compared_with_like(prose):
    words = prose(5, 60).split()
    text, other = " ".join(words), " ".join(words[:40] + ["x", "y", "z"] * 7)
    # The lexicon holds three words, which only the edited text has; or none; or all.
    for known in (["x", "y", "z"], [], [*words, "x", "y", "z"]):
        band = np.sort(d._distinct(pa.array(known, pa.string()))[0])
        row = d._compared([(1, text), (2, other)], band)[0]
        assert row[6] > 0.3
    both = d.fingerprints(pa.array([text, other]), np.zeros(0, np.uint64))
    assert d._compared([(1, text), (2, other)], np.sort(d._distinct(pa.array(["x", "y", "z"]))[0]))[0][6] == d.likeness(*both)
