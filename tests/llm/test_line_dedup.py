from __future__ import annotations

import re

from lapseflow.llm import bounds
from lapseflow.llm import line_dedup as d


def within_one(a: list[str], b: list[str]) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    """Documents in the order of ids; each line against all earlier ones."""
    seen: list[list[str]] = []
    out = []
    for key, text in docs:
        if text is None:
            out.append((key, None, 0, 0, False))
            continue
        kept, dropped, left = [], 0, 0
        for line in text.split("\n"):
            words = re.sub(r"[ \t\n\x0b\f\r]+", " ", line.lower()).strip(" ").split(" ")
            long = len(words) >= d.MIN_WORDS
            gone = long and any(
                w == words or len(words) >= d.NEAR_WORDS and len(w) >= d.NEAR_WORDS and within_one(words, w) for w in seen
            )
            if long:
                seen.append(words)
                left += not gone
            dropped += gone
            if not gone:
                kept.append(line)
        out.append((key, "\n".join(kept), len(text.split("\n")), dropped, dropped > 0 and left == 0))
    return sorted(out, key=str)


def test_equals_brute_force(make, prose, odd_texts):
    base = prose(3, 12).split()
    changed = [
        base,
        base[:4] + ["other"] + base[5:],
        base[:4] + base[5:],
        base[:4] + ["more"] + base[4:],
        base[1:],
        base + ["end"],
        base[:2] + ["two", "new"] + base[4:],
        base[::-1],
        base[:7],
        base[:6] + ["x"],
    ]
    lines = [" ".join(x) for x in changed]
    texts = [
        *odd_texts,
        *lines,
        "\n".join([lines[0].upper(), "", "As.", prose(5, 9), "As."]),
        "\n".join([prose(5, 9), f"  {prose(5, 4)}  {prose(6, 4)}", prose(7, 3), prose(7, 3)]),
        prose(99, 30_000) + " tail",
    ]
    docs = list(enumerate(texts))
    got = d.dedup_lines(make(docs, clashing=True)).select("doc_id", "text", "n_lines", "n_dropped", "emptied")
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_many_lines_that_differ_in_one_word(make, prose):
    # All lines of a template meet in one key and only the earliest stays.
    docs = [(i, f"{prose(1, 5)} number{i} {prose(2, 5)}\n{prose(50 + i, 9)}") for i in range(300)]
    got = {r["doc_id"]: (r["n_dropped"], r["emptied"]) for r in d.dedup_lines(make(docs)).collect()}
    assert got[0] == (0, False)
    assert all(got[i] == (1, False) for i in range(1, 300))


def test_nothing_is_broadcast_beyond_its_bytes(make, prose, monkeypatch):
    line = prose(1, 12)
    rows = make([(i, f"{line}\n{prose(i % 40, 9)}\nend {i} of it") for i in range(200)])
    small = sorted(map(tuple, d.dedup_lines(rows).collect()), key=str)
    monkeypatch.setattr(bounds, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, d.dedup_lines(rows).collect()), key=str) == small


def test_bytes_count_texts_and_arrays(spark):
    rows = [(1, "abc", [1, 2, 3]), (None, None, None), (2, "é", [])]
    assert bounds.n_bytes(spark.createDataFrame(rows, "n int, t string, a array<int>")) == 3 * 8 + (3 + 8 + 2) + (32 + 8 + 8)
    assert bounds.n_bytes(spark.createDataFrame([], "t string")) == 0


def test_without_ids_and_repeated_rows(make, prose):
    line, other = prose(1, 10), prose(2, 10)
    rows = make([(None, line), (1, line), (2, other), (2, other), (2, prose(3, 10) + "\n" + other), (3, other)])
    got = sorted(((r["doc_id"], r["text"]) for r in d.dedup_lines(rows).collect()), key=str)
    # Rows with equal id and text keep the same lines; of an id's texts one hash comes first.
    assert (None, line) in got and (1, "") in got and (3, "") in got
    assert sum(t.endswith(other) for i, t in got if i == 2) in (1, 2)


def test_stage(make, prose):
    rows = make([(1, prose(1, 10)), (2, prose(1, 10) + "\nAs."), (3, prose(1, 10) + "\n" + prose(4, 10)), (4, None), (5, "")], clashing=True)
    got = d.without_repeated_lines(rows)
    assert got.columns == rows.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["text"] is not None) == [(1, prose(1, 10)), (3, prose(4, 10)), (5, "")]
    assert got.where("doc_id = 4").count() == 1


def test_empty_table(make):
    assert d.dedup_lines(make([])).count() == 0
