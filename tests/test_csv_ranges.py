"""One UTF-16 file read range by range equals the whole, wherever the ranges are cut."""

from __future__ import annotations

import csv
import io
import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapseflow import schemas
from lapseflow.sources import auctions, csv_ranges, files

FIELDS = st.text(alphabet='ab";\n\r, äx漢🙂', max_size=6).map(lambda t: t.replace("\r\n", "\n").replace("\r", ""))


def read(path: str, length: int, size: int) -> list[str]:
    """What the passes do, in one process."""
    out, inside = [], False
    for low in range(0, length, size):
        high = min(low + size, length)
        n, *sound = csv_ranges.quote_counts(path, low, high)
        assert sound[inside]
        out += csv_ranges.records(path, low, high, inside)
        inside = (n + inside) % 2 == 1
    return out


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(FIELDS, min_size=2, max_size=3), max_size=6), st.integers(1, 30), st.sampled_from(["utf-16", "utf-16-be"]), st.sampled_from(["\r\n", "\n"]))
def test_records_are_whole_wherever_a_range_ends(tmp_path_factory, rows, half, encoding, end):
    path = tmp_path_factory.mktemp("ranges") / "market.csv"
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=";", lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode(encoding))
    got = [next(csv.reader(io.StringIO(r, newline=""), delimiter=";")) for r in read(str(path), path.stat().st_size, 2 * half)]
    assert got == rows


@pytest.mark.parametrize("text", ['a;5" pipe\nb;c\n', 'a;"x" y\n', 'a; "x"\n'])
def test_quotes_in_plain_fields_are_noticed(tmp_path, text):
    path = tmp_path / "market.csv"
    path.write_bytes(text.encode("utf-16"))
    assert not csv_ranges.quote_counts(str(path), 0, path.stat().st_size)[1]


def market_file(lines: int, odd: bool = False) -> bytes:
    head = ";".join([*schemas.MARKET_COLUMNS, *schemas.MARKET_EXTRA])
    pick = random.Random(3)
    text = ["sep=;", head]
    for i in range(lines):
        name = pick.choice([f"bücher{i}.de", f'"a ""b""\n;{i}.com"', f"漢{i}.io", ""])
        text.append(f'{name};s;e;{pick.choice(["1", "", chr(34) + "1;2" + chr(34)])};0;0;1;7;{"5" + chr(34) + " x" if odd and i == 7 else "de"};{i};http://x')
    return "\r\n".join(text).encode("utf-16")


def bag(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("odd", [False, True])
def test_a_long_file_is_read_by_many_tasks(spark, tmp_path, odd):
    (tmp_path / "long.csv").write_bytes(market_file(3_000, odd))
    (tmp_path / "short.csv").write_bytes(market_file(20))
    whole = auctions.market_csv(spark, str(tmp_path))
    cut = auctions.market_csv(spark, str(tmp_path), size=10_000)
    assert whole.columns == cut.columns and whole.count() == 3_020
    assert bag(cut) == bag(whole)
    parts = cut.selectExpr("spark_partition_id() AS p").distinct().count()
    assert parts > 10 if not odd else parts < 10


def test_only_short_files_and_hidden_ones(spark, tmp_path):
    (tmp_path / "short.csv").write_bytes(market_file(3))
    (tmp_path / "_SUCCESS").write_bytes(b"")
    assert auctions.market_csv(spark, str(tmp_path)).count() == 3


def test_a_file_of_very_many_ranges_gets_longer_ones(spark, tmp_path, monkeypatch):
    (tmp_path / "long.csv").write_bytes(market_file(3_000))
    whole = bag(auctions.market_csv(spark, str(tmp_path)))
    monkeypatch.setattr(files, "RANGES", 5)
    cut = auctions.market_csv(spark, str(tmp_path), size=1_000)
    assert cut.selectExpr("spark_partition_id() AS part").distinct().count() <= 5
    assert bag(cut) == whole


@pytest.mark.parametrize("block", [2, 6, 64])
def test_blocks_cut_anywhere_change_nothing(tmp_path, block):
    path = tmp_path / "long.csv"
    for data in (market_file(40), market_file(40).decode("utf-16").encode("utf-16-be")):
        path.write_bytes(data)
        inside, size = False, 300
        for low in range(0, len(data), size):
            high = min(low + size, len(data))
            counted = csv_ranges.quote_counts(str(path), low, high)
            assert csv_ranges.quote_counts(str(path), low, high, block=block) == counted
            found = [r for part in csv_ranges.record_blocks(str(path), low, high, inside, block) for r in part]
            assert found == csv_ranges.records(str(path), low, high, inside)
            inside = (counted[0] + inside) % 2 == 1


def test_quotes_in_plain_fields_are_noticed_in_any_block(tmp_path):
    path = tmp_path / "market.csv"
    path.write_bytes(market_file(40, odd=True))
    for block in (2, 6, 64):
        assert not csv_ranges.quote_counts(str(path), 0, path.stat().st_size, block=block)[1]


def test_a_range_is_not_held_whole(tmp_path):
    path = tmp_path / "long.csv"
    path.write_bytes(market_file(1_000) * 80)
    size = path.stat().st_size
    tracemalloc.start()
    try:
        csv_ranges.quote_counts(str(path), 0, size, block=1 << 16)
        read = sum(len(part) for part in csv_ranges.record_blocks(str(path), 0, size, False, 1 << 16))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert read > 70_000 and peak < size / 4
