from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lapseflow.llm import collocations as d

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows) -> dict[str, Counter]:
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def brute(rows, least, covered=50, reported=2000) -> list[tuple]:
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * c >= covered * a for q, c in candidates.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def corpus(seed: int, texts: int) -> list[tuple]:
    """Texts over few words, so that phrases repeat; one word and one pair lead a third of all windows."""
    pick = random.Random(seed)
    words = ["the", "of", "Ä", "ä", "x\x00", "'s", "日本", "a", "b", "c", "d", *[f"w{i}" for i in range(40)]]
    out = []
    for _ in range(texts):
        parts = []
        for _ in range(pick.randrange(60)):
            parts += ["of", "THE"] if pick.random() < 0.3 else [pick.choice(words)]
            parts.append(pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]))
        out.append(("".join(f"{p} " if p in ("of", "THE") else p for p in parts), pick.choice(["en", "en", "en", "de", None])))
    return out


@pytest.fixture(scope="module")
def rows():
    return [*corpus(1, 300), (None, "en"), ("", "en"), (" \t", "fr"), ("...", None), ("one", "it"), *[("same old line again", "en")] * 40]


@pytest.mark.parametrize(("chunk", "groups"), [(1 << 23, None), (700, 60), (10_000, 500)])
def test_equals_brute_force_whatever_the_layout(spark, rows, chunk, groups):
    # Small chunks cut texts apart, many groups make words and pairs heavy.
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA).repartition(5)
    docs = docs.selectExpr("*", *[f"1 AS {c}" for c in ("w1", "w2", "w3", "n", "f", "size", "rank", "phrase", "part", "bucket", "whole", "a", "l", "r")])
    assert rows_of(d.collocations(docs, least=4, chunk=chunk, groups=groups)) == brute(rows, 4)


def test_windows_under_heavy_leads_are_split(spark, rows):
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    total, heavy = d.heavy_leads(d._pieces(docs, "lang", "text"), share=0.05)
    assert total == sum(c for f in counted(rows).values() for p, c in f.items() if len(p) == 1)
    assert {r["kind"] for r in heavy.collect()} == {1, 2}


def test_counts_of_frequent_phrases_are_exact(spark, rows):
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    got = d.phrase_counts(d.longest_windows(docs, least=3, chunk=500, groups=300), 3).collect()
    want = {(lang, *p): c for lang, f in counted(rows).items() for p, c in f.items() if c >= 3}
    assert {(r["lang"], *[w for w in (r["w1"], r["w2"], r["w3"]) if w]): r["f"] for r in got if r["size"]} == want


def test_groups_stay_whole_whatever_is_held(spark, rows):
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    whole = pa.RecordBatch.from_arrays([pa.array([x or "und" for _, x in rows]), pa.array([t or "" for t, _ in rows])], names=["lang", "text"])
    rows = [d._by_lead(c, names, [np.zeros(0, np.uint64)] * 2) for c, names in d._chunks([whole], 5000)]
    batches = pa.Table.from_batches(rows).sort_by([(c, "ascending") for c in ("lang", "w1", "whole", "part")]).to_batches(max_chunksize=7)
    for most in (1, 3000, 1 << 24):
        tables = list(d._whole_groups(iter(batches), most))
        seen = [{(r["lang"], r["w1"]) for r in t.select(["lang", "w1"]).to_pylist()} for t in tables]
        assert sum(len(x) for x in seen) == len(set().union(*seen)) and sum(len(t) for t in tables) == sum(len(b) for b in batches)
        sums = pa.Table.from_batches([d._summed(t, 4) for t in tables])
        assert sum(sums["n"].to_pylist()) == d.heavy_leads(d._pieces(docs, "lang", "text"))[0]


def test_report_is_cut_per_language_with_ties(spark):
    rows = [(f"p{i} q{i}. ", "en") for i in range(30) for _ in range(12 + i % 2)] + [("u v. " * 11, "de")]
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    assert rows_of(d.collocations(docs, reported=10)) == brute(rows, 10, reported=10)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_123, 4_000_000_000_457, 5_000_000_000_011
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert df.select(d._score(df.a, df.l, df.r)).first()[0] == 10**6 * a * a // (left * right)


def test_empty_and_very_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(d.collocations(empty)) == []
    # No piece ends, and one text is many chunks.
    rows = [("ab cd ef " * 20_000, "en"), ("x" * 100_000, "en")]
    docs = spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(rows)], SCHEMA)
    assert rows_of(d.collocations(docs, chunk=1000)) == brute(rows, 10)
