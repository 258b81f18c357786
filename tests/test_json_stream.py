"""Listings of an envelope, however the stream is cut."""

from __future__ import annotations

import io
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapseflow.sources import json_stream

VALUES = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(), st.text(max_size=12)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=5), inner, max_size=3)),
    max_leaves=6,
)


@settings(max_examples=60, deadline=None)
@given(st.lists(VALUES, max_size=6), VALUES, st.integers(1, 9), st.sampled_from([None, 1]))
def test_equals_the_whole_document(data, meta, piece, indent):
    text = json.dumps({"meta": meta, "data": data, "rest": [meta]}, indent=indent, ensure_ascii=False)
    before, json_stream.PIECE = json_stream.PIECE, piece
    try:
        assert [json.loads(x) for x in json_stream.listings(io.StringIO(text))] == data
    finally:
        json_stream.PIECE = before


@pytest.mark.parametrize("cut", [1, 8, 20, 33, -1])
def test_broken_documents_fail(cut):
    text = json.dumps({"meta": {}, "data": [{"a": 1}, {"b": "x"}]})
    with pytest.raises(ValueError, match="malformed"):
        list(json_stream.listings(io.StringIO(text[:cut])))


@pytest.mark.parametrize("text", ["", "[]", "{}", '{"data": 3}', '{"data": [1 2]}', '{"data" [1]}', '{"other": []}'])
def test_documents_without_listings_fail(text):
    with pytest.raises(ValueError, match="malformed"):
        list(json_stream.listings(io.StringIO(text)))


def test_memory_does_not_follow_the_document():
    class Endless(io.TextIOBase):
        def __init__(self):
            self.left, self.most = 200_000, 0
            self.begun = False

        def read(self, n):
            if not self.begun:
                self.begun = True
                return '{"data": ['
            if not self.left:
                return ""
            self.left -= 1000
            tail = "" if self.left else "]}"
            return ",".join('{"k": "v"}' for _ in range(1000)) + ("," if self.left else "") + tail

    assert sum(1 for _ in json_stream.listings(Endless())) == 200_000


class Counted(io.StringIO):
    """A text that knows how much of it was read."""

    read_so_far = 0

    def read(self, n=-1):
        found = super().read(n)
        self.read_so_far += len(found)
        return found


def test_a_fault_is_reported_within_a_piece():
    text = Counted('{"data": [{"a" 1}, ' + '{"k": "v"}, ' * 500_000 + "{}]}")
    with pytest.raises(ValueError, match="malformed"):
        list(json_stream.listings(text))
    assert text.read_so_far <= 2 * json_stream.PIECE


def test_a_long_value_is_read_a_few_times_over_only(monkeypatch):
    # Each failed try reads as much again as is held.
    tries = []
    cursor = json_stream._Cursor(io.StringIO('"' + "x" * 3_000_000 + '"'))
    own = cursor._decode
    cursor._decode = lambda text, at: (tries.append(len(text)), own(text, at))[1]
    assert len(cursor.value()) == 3_000_002 and sum(tries) < 4 * 3_000_002


def test_values_beyond_the_bound_fail():
    with pytest.raises(ValueError, match="over 1000"):
        list(json_stream.listings(io.StringIO('{"data": [{"k": "' + "x" * 200_000 + '"}]}'), most=1000))


def test_what_is_passed_over_is_not_kept():
    cursor = json_stream._Cursor(io.StringIO("[" + '{"a": "]\\\\\\""},' * 200_000 + "0] 7"))
    cursor.skip()
    assert cursor.value() == "7" and len(cursor._text) <= 2 * json_stream.PIECE
    for text in ("[1, 2", '["a]', "[{]", '["\\'):
        with pytest.raises(ValueError, match="malformed"):
            json_stream._Cursor(io.StringIO(text)).skip()
