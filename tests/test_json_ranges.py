"""One document read range by range equals the whole, wherever the ranges are cut."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from lapseflow.sources import auctions, files, json_ranges
from lapseflow.sources.json_ranges import Place, Range

TEXTS = st.text(alphabet='ab"\\[]{},: \nä漢 ', max_size=8)
INNER = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(), TEXTS),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(TEXTS, inner, max_size=3)),
    max_leaves=5,
)
OBJECTS = st.dictionaries(TEXTS, INNER, max_size=3)


def read(path: str, length: int, size: int, block: int = 1 << 20) -> list:
    """What the passes do, in one process."""
    pieces = [(low, min(low + size, length)) for low in range(0, length, size)]
    inside, depth, begun, outer, borders = False, 0, [], b"", []
    for low, high in pieces:
        begun.append((low, high, inside, depth))
        text, own = json_ranges.outer_text(path, Place(low, inside, depth), high, block)
        outer, borders = outer + text, borders + own
        ends = json_ranges.outcomes(path, low, high, block)
        inside, depth = ends[inside][0], depth + ends[inside][1]
    out = []
    for low, high in json_ranges.spans(outer, borders, path, "data"):
        for start, stop, inside, depth in begun:
            if start <= high and low < stop:
                part = Range(path, start, stop, inside, depth, low, high)
                reader = json_ranges._Reader({"ranges": "[]", "block": str(block)})
                out += [json.loads(x) for b in reader.read(part) for x in b.column(0).to_pylist()]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(OBJECTS, max_size=5), INNER, st.integers(1, 40), st.integers(1, 9), st.sampled_from([None, 1]), st.booleans())
def test_equals_the_whole_document(tmp_path_factory, data, meta, size, block, indent, ascii_only):
    path = tmp_path_factory.mktemp("ranges") / "document.json"
    text = json.dumps({"meta": meta, "a]{": "\\", "data": data, "rest": [[meta]]}, indent=indent, ensure_ascii=ascii_only)
    path.write_text(text)
    assert read(str(path), path.stat().st_size, size, block) == data


@pytest.mark.parametrize("size", [3, 7, 1000])
@pytest.mark.parametrize(
    "text",
    [
        '{"data": [{"a": 1}, {"b": 2}]',
        '{"data": [{"a": 1}, {"b": "2}]}',
        '{"data": [{"a": 1} {"b": 2}]}',
        '{"data": [{"a": 1},, {"b": 2}]}',
        '{"data": [{"a": 1}, {"b": 2},]}',
        '{"data": [{"a": 1}, 7, {"b": 2}]}',
        '{"data": [{"a": 1}, "x"]}',
        '{"data": [[{"a": 1}]]}',
        '{"data": [{"a": 1}}}',
        '{"data": [{"a": 1}]}}',
        '{"data": [{"a": 1}]} {"data": []}',
        '{"meta": {"x" 1}, "data": [{"a": 1}]}',
        '{"meta": 1 "data": [{"a": 1}]}',
        '{"other": [{"a": 1}]}',
        '{"data": {"a": 1}}',
        '[{"data": [{"a": 1}]}]',
        "",
    ],
)
def test_broken_documents_fail(tmp_path, text, size):
    path = tmp_path / "document.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        read(str(path), len(text), size)


def test_every_escape_at_every_border(tmp_path):
    path = tmp_path / "document.json"
    data = [{"k": "\\" * n + '"' * (n % 3) + "]}", '"\\': [n, {"x": "\\\""}]} for n in range(8)]
    path.write_text(json.dumps({"data": data}))
    for size in range(1, 60):
        assert read(str(path), path.stat().st_size, size, block=size % 7 + 1) == data


def entry(i: int) -> dict:
    return {"domainName": f"n{i}.com", "link": str(i), "description": 'odd "text" [{,}] \\ ' * (i % 5), "price": "$1"}


def test_a_long_document_is_read_by_many_tasks(spark, tmp_path):
    long, short = tmp_path / "long.json", tmp_path / "short.json"
    long.write_text(json.dumps({"meta": {"x": [1]}, "data": [entry(i) for i in range(30_000)]}))
    short.write_text(json.dumps({"meta": {}, "data": [entry(i) for i in range(30_000, 30_010)]}))
    whole = auctions.auction_json(spark, str(tmp_path))
    cut = auctions.auction_json(spark, str(tmp_path), size=1 << 18)
    assert cut.rdd.getNumPartitions() > 8 and whole.rdd.getNumPartitions() < 8
    assert cut.columns == whole.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    read = cut.selectExpr("link", "spark_partition_id() AS part").groupBy("part").count().collect()
    assert sum(r["count"] for r in read) == 30_010 and sum(r["count"] > 100 for r in read) > 8


@pytest.mark.parametrize("at", [0.3, 0.999])
def test_a_long_document_that_is_broken_fails(spark, tmp_path, at):
    text = json.dumps({"data": [entry(i) for i in range(5_000)]})
    # Between two listings.
    cut = text.rindex("}, {", 0, int(len(text) * at)) + 1
    for broken in (text[:cut], text[:cut] + "}" + text[cut:]):
        (tmp_path / "long.json").write_text(broken)
        with pytest.raises(Exception, match="(?i)malformed"):
            auctions.auction_json(spark, str(tmp_path), size=1 << 16).collect()


def test_a_document_of_very_many_ranges_gets_longer_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RANGES", 5)
    (tmp_path / "long.json").write_text(json.dumps({"data": [entry(i) for i in range(2_000)]}))
    cut = auctions.auction_json(spark, str(tmp_path), size=1 << 10)
    assert 1 < cut.selectExpr("spark_partition_id() AS part").distinct().count() <= 5
    assert sorted(int(r["link"]) for r in cut.collect()) == [*range(2_000)]


def test_no_range_is_longer_than_its_reader_bears():
    assert files.range_size([1 << 40], 1 << 16, 1 << 25) == 1 << 25
    assert files.range_size([1 << 40], 1 << 26, 1 << 25) == 1 << 26
    assert files.range_size([100, 200], 1 << 16, 1 << 25) == 1 << 16


def test_a_task_does_not_bring_the_ranges_of_the_others():
    readers = [json_ranges._Reader({"ranges": json.dumps([["p", i, i + 1, False, 0, 0, n] for i in range(n)])}) for n in (1, 5_000)]
    assert len(readers[1].partitions()) == 5_000
    assert len({len(cloudpickle.dumps(r.read)) for r in readers}) == 1
