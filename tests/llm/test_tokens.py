from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lapseflow.llm import tokens

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB 0é\n\x00!ß漢.\x0b", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_follow_the_patterns(texts):
    for lut, pattern in ((tokens.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (tokens.SOLID, r"[^\x20\x09-\x0D]+")):
        found = tokens.words(pa.array(texts, pa.string()), lut)
        lower = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in texts]
        want = [re.findall(pattern, t) for t in lower]
        assert np.diff(found.bounds).tolist() == [len(w) for w in want]
        assert [[w.decode() for w in tokens.spelled(t, lut)] for t in texts] == want
        spelled = [w for ws in want for w in ws]
        assert len(set(found.hashes.tolist())) == len(set(spelled))
        assert len(set(zip(found.hashes.tolist(), spelled, strict=True))) == len(set(spelled))


def test_pieces_do_not_change_words(monkeypatch, prose):
    column = pa.array([prose(1, 500), None, "x" * 9000 + " end", prose(2, 50)])
    whole = tokens.words(column, tokens.ALNUM)
    monkeypatch.setattr(tokens, "PIECE", 100)
    pieces = tokens.words(column, tokens.ALNUM)
    assert (whole.hashes == pieces.hashes).all() and (whole.bounds == pieces.bounds).all()


def test_sliced_columns():
    column = pa.array(["a b", "c", "d e f"]).slice(1, 2)
    assert np.diff(tokens.words(column, tokens.ALNUM).bounds).tolist() == [1, 3]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=20), min_size=1, max_size=6), st.integers(1, 3))
def test_shingles_are_the_sets(texts, size):
    keys, bounds = tokens.shingles(tokens.words(pa.array(texts), tokens.SOLID), size)
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    got = [set(keys[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
    for a, x in zip(got, sets, strict=True):
        for b, y in zip(got, sets, strict=True):
            assert len(a & b) == len(x & y)
