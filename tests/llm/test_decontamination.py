from __future__ import annotations

import hashlib

from lapseflow.llm import decontamination as d
from lapseflow.llm import tokens


def brute(docs, items, window=d.WINDOW, near=d.NEAR):
    split = {k: tokens.spelled(t, tokens.ALNUM) for k, t in items}
    texts = [(k, tokens.spelled(t, tokens.ALNUM)) for k, t in docs]
    count = {}
    for _, w in texts:
        for x in w:
            count[x] = count.get(x, 0) + 1
    out = []
    for k, w in texts:
        hits, found, close = set(), set(), set()
        for item, words in split.items():
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i : i + window]
                for p in range(len(w) - len(part) + 1):
                    if w[p : p + len(part)] == part:
                        hits.update(range(p, p + len(part)))
                        found.add(str(item))
                rare = min(part, key=lambda x: (count.get(x, 0), x))
                for p, x in enumerate(w):
                    if x == rare and all(t in w[max(0, p - near) : p + near + 1] for t in part):
                        close.add(item)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((k, len(w), len(hits), len(found), sha, bool(hits), len(close)))
    return sorted(out, key=str)


def test_equals_brute_force(spark, make, prose, odd_texts):
    items = [(1, prose(1, 30)), (10, prose(2, 12)), (2, "Short one"), (3, None), (4, "..."), (5, prose(1, 30)), (6, "the the the")]
    a, b = prose(1, 30).split(), prose(2, 12).split()
    texts = [
        *odd_texts,
        prose(7, 50) + " " + prose(1, 30).upper() + "! " + prose(8, 9),
        " ".join(a[5:15]),
        " ".join(a[5:14]),
        " ".join(b[:6] + ["new", "words"] + b[6:]),
        "a short, ONE",
        "one short",
        "the the the the",
        " ".join(a[3:20] + b),
    ]
    docs = list(enumerate(texts)) + [(None, prose(2, 12)), (5, " ".join(a[:10])), (5, " ".join(a[:10]))]
    benchmark = spark.createDataFrame(items + [(None, prose(7, 50))], "item_id bigint, text string")
    got = d.contamination(make(docs, clashing=True), benchmark).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_blocks_of_items_change_nothing(spark, make, prose, monkeypatch):
    docs = make([(i, prose(i % 5, 40)) for i in range(9)])
    benchmark = spark.createDataFrame([(i, prose(i, 25)) for i in range(4)], "item_id bigint, text string")
    one = sorted(map(tuple, d.contamination(docs, benchmark).collect()))
    blocks = d.item_blocks
    monkeypatch.setattr(d, "item_blocks", lambda b, w: blocks(b, w, 100))
    assert sorted(map(tuple, d.contamination(docs, benchmark).collect())) == one


def test_segments_change_nothing(spark, make, prose, monkeypatch):
    docs = make([(i, prose(i % 5, 40)) for i in range(9)])
    benchmark = spark.createDataFrame([(i, prose(i, 25)) for i in range(4)], "item_id bigint, text string")
    one = sorted(map(tuple, d.contamination(docs, benchmark).collect()))
    monkeypatch.setattr(d, "SEGMENT", 300)
    assert sorted(map(tuple, d.contamination(docs, benchmark).collect())) == one


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert d.contamination(make([]), none).count() == 0
    assert [tuple(r)[1:4] for r in d.contamination(make([(1, "a b")]), none).collect()] == [(2, 0, 0)]
    assert d.without_contaminated(make([(1, "a b"), (None, None)]), none).count() == 2


def test_stage_drops_contaminated_only(spark, make, prose):
    benchmark = spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string")
    docs = make(
        [(1, "x " + prose(1, 20)), (2, prose(3, 20)), (None, prose(1, 20)), (None, prose(4, 20)), (1, prose(5, 20)), (4, None)],
        clashing=True,
    ).selectExpr("*", "doc_id AS _gone")
    got = d.without_contaminated(docs, benchmark)
    assert set(got.columns) == set(docs.columns)
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 2, 4, None]
    assert {r["text"] for r in got.collect()} == {prose(3, 20), prose(4, 20), prose(5, 20), None}
