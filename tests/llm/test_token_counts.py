from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapseflow.llm import token_counts as d
from lapseflow.llm.queries import QUERIES

LIBRARY = Tokenizer.from_file(d.VOCABULARY)
WORDS = d.vocabulary()
SPECIAL = "<|endoftext|>"


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


ODD = [
    "",
    " ",
    "   ",
    "\n\n  x",
    "a  b   c\t\td \n e",
    "don't we'll they've I'm he'd she's we're 'tis ''s '''ll x's's 's 'S 're've \n's  's",
    "'sam 'llama 'tt 'd1 '1 'm\n'v 'r 'l 'l' '",
    "1'2 3's 12345678901234567890",
    "ünïcödé 漢字かな交じり文 emoji 🤖🤖 ½ ²³ ٣٤   x​y z",
    f"{SPECIAL}a{SPECIAL}{SPECIAL} b <|endoftext|",
    "x" * 5000,
    "ab" * 3000,
    "".join(random.Random(1).choices("abcdefghij", k=4000)),
    "".join(random.Random(2).choices("漢字かな交じり文のテスト", k=3000)),
    " " * 3000 + "x" + "\n" * 700,
    "=" * 999 + "-" * 2001,
    "\x00\x01\x7f\x1c\x1d\x85",
]


def test_counts_equal_the_library():
    assert d.count_tokens(ODD, WORDS).tolist() == library(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" 'stmdrevl\n\t1aé漢!"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8))
def test_counts_equal_the_library_on_any_text(texts):
    assert d.count_tokens(texts, WORDS).tolist() == library(texts)


def test_every_character_is_classed_as_the_library_does():
    # Between letters, numbers and others, each code point in turn.
    codes = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3400 or 0xA000 <= c < 0xAC00 or 0xD700 <= c < 0x20000 or c % 97 == 0)]
    for low in range(0, len(codes), 20_000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}\n" for c in codes[low : low + 20_000])
        want = [span[0] for _, span in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(points), bool)
        first[0] = True
        assert np.flatnonzero(d.pre_token_starts(points, first, d._classes(WORDS))).tolist() == want


def test_pieces_change_nothing(monkeypatch):
    texts = [("don't  stop " * 400) + "\n\n" + "漢字 " * 300, "x" * 3000 + " y", "a\n" * 999]
    want = library(texts)
    monkeypatch.setattr(d, "PIECE", 64)
    classes = d._classes(WORDS)
    for text in texts:
        parts = list(d.pieces(text, classes, 64))
        assert "".join(parts) == text and len(parts) < len(text)
    assert d.count_tokens(texts, WORDS).tolist() == want


def test_linked_merging_equals_rounds(monkeypatch):
    texts = ["".join(random.Random(i).choices("abcdeABC", k=700)) for i in range(5)] + ["aaaa" * 250]
    want = library(texts)
    for long in (2, 10_000):
        monkeypatch.setattr(d, "LONG", long)
        assert d.count_tokens(texts, WORDS).tolist() == want


def test_other_kinds_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        d.vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_rows_are_counted_one_by_one(spark, make, odd_texts):
    texts = [*odd_texts, "same words", "same words"]
    docs = make([*enumerate(texts), (None, "no id"), (0, "same id")], clashing=True)
    docs = docs.selectExpr("*", "1 AS n_tokens", "2 AS n_bytes", "3 AS over_limit", "4 AS _text")
    got = d.token_counts(docs, limit=100).collect()
    assert len(got) == len(texts) + 2
    assert got[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    want = sorted((len((t or "").encode()), n) for t, n in zip([*texts, "no id", "same id"], library([t or "" for t in [*texts, "no id", "same id"]]), strict=True))
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert d.token_counts(docs.limit(0)).count() == 0


def test_totals(spark, make):
    docs = make([(1, "one two"), (2, "three"), (3, None)])
    (row,) = d.token_totals(d.token_counts(docs, limit=1), docs).collect()
    assert (row["source"], row["documents"], row["n_tokens"], row["over_limit"]) == ("src", 3, sum(library(["one two", "three"])), 1)


def test_query_equals_the_library(spark, folder):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op11_token_counts"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    counts = library([r["text"] or "" for r in rows])
    assert got == {r["doc_id"]: (len((r["text"] or "").encode()), n, n > 1024) for r, n in zip(rows, counts, strict=True)}
