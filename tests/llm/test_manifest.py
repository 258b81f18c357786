from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lapseflow.llm import manifest as d

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict) -> str:
    values = [row[c] for c in d.FIELDS]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes: list[str]) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        low = found[-1]
        found.append([h(*low[i : i + 3]) for i in range(0, len(low), 3)])
    return found


def climb(tree: list[list[str]], at: int, digest: str) -> tuple[list[str], str]:
    siblings = []
    for nodes in tree[:-1]:
        low = at - at % 3
        run = nodes[low : low + 3]
        siblings += [x for k, x in enumerate(run) if k != at - low]
        run[at - low] = digest
        digest, at = h(*run), at // 3
    return siblings, digest


def brute(rows: list[dict], seen) -> list[tuple]:
    trees: dict[bytes, list[dict]] = {}
    for row in rows:
        trees.setdefault(b"" if row["source"] is None else b"=" + row["source"].encode(), []).append(row)
    for own in trees.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(trees)
    built = {n: levels([leaf(r) for r in trees[n]]) for n in names}
    top = levels([built[n][-1][0] for n in names])
    root = top[-1][0]
    out = []
    for k, n in enumerate(names):
        for i, row in enumerate(trees[n]):
            low, digest = climb(built[n], i, leaf(seen(row)))
            high, digest = climb(top, k, digest)
            out.append((row["doc_id"], leaf(row), built[n][-1][0], root, h(*low, *high), digest, digest == root))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def unbroken(row: dict) -> dict:
    if row["doc_id"] is None or row["text"] is None or crc32(str(row["doc_id"]).encode()) % 2:
        return row
    return row | {"text": row["text"].replace("\n", "")}


CUT = {"text": F.when(d.remainder("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))}


@pytest.fixture(scope="module")
def documents():
    """A source of many rows, small ones of all sizes, nulls everywhere, shared ids and equal rows."""
    rows = [dict(doc_id=i, text=f"line {i}\nend" if i % 3 else "plain", lang="en", source="hot", n_chars=i) for i in range(100)]
    rows += [dict(doc_id=i, text="a\nb", lang=None, source=f"s{k}ä", n_chars=None) for k in range(14) for i in range(k + 1)]
    rows += [dict(doc_id=None, text=None, lang=None, source=None, n_chars=None)] * 3
    rows += [dict(doc_id=7, text="\n", lang="de", source="hot", n_chars=1), dict(doc_id=7, text="", lang="de", source="", n_chars=0)]
    rows += [dict(doc_id=8, text="x\n" * 50_000, lang="de", source="hot", n_chars=1)] * 5
    return rows


@pytest.mark.parametrize("depth", [1, 6])
def test_equals_brute_force_whatever_the_blocks(spark, documents, depth):
    # Small blocks take several rounds.
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in documents], SCHEMA).repartition(5)
    clashing = docs.selectExpr("*", "1 AS tree", "2 AS digest", "3 AS position", "4 AS block", "5 AS part", "6 AS key", "7 AS leaf", "8 AS _tie")
    assert rows_of(d.merkle_manifest(clashing, CUT, depth=depth)) == brute(documents, unbroken)


def test_untouched_rows_verify(spark, documents):
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in documents], SCHEMA)
    assert rows_of(d.merkle_manifest(docs)) == brute(documents, lambda r: r)


@pytest.mark.parametrize("n", [0, 1, 10])
def test_small_tables(spark, n):
    rows = [dict(doc_id=i, text="t\n", lang="en", source="a", n_chars=2) for i in range(n)]
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows], SCHEMA)
    assert rows_of(d.merkle_manifest(docs, CUT)) == brute(rows, unbroken) if n else rows_of(d.merkle_manifest(docs, CUT)) == []


def test_folding_never_reads_what_stands_before():
    tree = d.Subtree([h(str(i)).encode() for i in range(27)], None)
    for digests, _ in tree.levels:
        # Only siblings to the right of the last slot are still known.
        digests[:26] = [b"gone"] * len(digests[:26])
    whole = levels([h(str(i)) for i in range(27)])
    assert tree.fold(26, b"other").decode() == climb(whole, 26, "other")[1]
    assert tree.top.decode() == whole[-1][0]


def test_positions_are_counted_over_ranges(spark):
    rows = [("a", i // 50, b"%03d" % (i % 7)) for i in range(500)] + [("b", 0, b"x")] * 300 + [("c", 1, b"y")]
    got = d.numbered(spark.createDataFrame(rows, "tree string, key bigint, digest binary").repartition(6), ["key", "digest"]).collect()
    for tree, n in (("a", 500), ("b", 300), ("c", 1)):
        own = sorted((r["position"], r["key"], bytes(r["digest"])) for r in got if r["tree"] == tree)
        assert [p for p, *_ in own] == list(range(n)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
