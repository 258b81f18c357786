"""One long UTF-16 file of separated values read by many tasks.

Ranges are cut between two-byte units. Whether a range begins within quotes depends on how many quotes
stand before it, so a first pass counts them; it also tests, for both cases, that quotes stand where they
open or close a field. A range then reads the records whose line break lies in it, the last one on into
the next range; breaks within quotes end no record. A task holds a block of its range and the records in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.sources.files import opened, range_size

#: Bytes of a range; a shorter file isn't cut.
RANGE = 1 << 24
#: Bytes of the longest record.
MOST = 1 << 26
#: Bytes that are looked at together, whole units.
BLOCK = 1 << 20
_QUOTE, _LINE, _RETURN = 0x22, 0x0A, 0x0D
_MARK = 0xFEFF


def _units(file: pa.NativeFile, low: int, high: int, kind: str) -> np.ndarray:
    file.seek(low)
    raw = file.read(high - low)
    return np.frombuffer(raw[: len(raw) // 2 * 2], kind)


def _order(file: pa.NativeFile) -> str:
    """Byte order by the mark at the beginning; without one the high byte comes first."""
    file.seek(0)
    return "<u2" if file.read(2) == b"\xff\xfe" else ">u2"


def quote_counts(path: str, start: int, stop: int, separator: str = ";", block: int = BLOCK) -> tuple[int, bool, bool]:
    """Quotes in a range, and whether all open or close a field if it begins outside, and if within quotes."""
    count, outside, inside = 0, True, True
    ends = [ord(separator), _LINE, _QUOTE]
    with opened(path) as file:
        kind = _order(file)
        for at in range(start, stop, block):
            # One unit more on each side, if there is one.
            low, high = max(at - 2, 0), min(at + block, stop)
            units = _units(file, low, high + 2, kind)
            quotes = np.flatnonzero(units == _QUOTE)
            quotes = quotes[(quotes >= (at - low) // 2) & (quotes < (high - low) // 2)]
            around = np.full(len(units) + 2, _LINE, units.dtype)
            around[1:-1] = units
            opens = np.isin(around[quotes], [*ends, _MARK])
            closes = np.isin(around[quotes + 2], [*ends, _RETURN])
            # Which of them open if the range begins outside, and which if within quotes.
            even, odd = (slice(count % 2, None, 2), slice(1 - count % 2, None, 2))
            outside &= bool(opens[even].all() and closes[odd].all())
            inside &= bool(closes[even].all() and opens[odd].all())
            count += len(quotes)
    return count, outside, inside


def record_blocks(path: str, start: int, stop: int, inside: bool, block: int = BLOCK) -> Iterator[list[str]]:
    """The records that follow a line break in the range, and the first one of the file, block by block."""
    with opened(path) as file:
        kind = _order(file)
        text = "utf-16-le" if kind == "<u2" else "utf-16-be"

        def breaks(of: np.ndarray, within: bool) -> tuple[np.ndarray, bool]:
            quotes, lines = np.flatnonzero(of == _QUOTE), np.flatnonzero(of == _LINE)
            return lines[(np.searchsorted(quotes, lines) + within) % 2 == 0], bool((len(quotes) + within) % 2)

        def texts(found: list[bytes]) -> list[str]:
            return [x for raw in found if (x := raw.decode(text).removesuffix("\r"))]

        # What was read of the record that goes on in the next block; before the range's first record: none.
        held = b"" if start == 0 else None
        within = inside
        for at in range(start, stop, block):
            units = _units(file, at, min(at + block, stop), kind)
            cuts, within = breaks(units, within)
            raw, found = units.tobytes(), []
            low = int(at == 0 and len(units) > 0 and units[0] == _MARK)
            for cut in cuts.tolist():
                if held is not None:
                    found.append(held + raw[2 * low : 2 * cut])
                held, low = b"", cut + 1
            if held is not None:
                held += raw[2 * low :]
            if found:
                yield texts(found)
        if held is None:
            return
        # On to the end of the last record.
        parts, at, size = [held], stop, 1 << 16
        while len(more := _units(file, at, at + size, kind)):
            found, within_next = breaks(more, within)
            parts.append(more[: found[0] if len(found) else len(more)].tobytes())
            if len(found):
                break
            at, within, size = at + 2 * len(more), within_next, 2 * size
            if at - stop > MOST:
                raise ValueError(f"malformed file {path}: a record of over {MOST} bytes")
        yield texts([b"".join(parts)])


def records(path: str, start: int, stop: int, inside: bool) -> list[str]:
    """All of :func:`record_blocks` at once."""
    return [record for found in record_blocks(path, start, stop, inside) for record in found]


def long_files(spark: SparkSession, files: list[tuple[str, int]], separator: str = ";", size: int = RANGE) -> tuple[DataFrame, list[str]]:
    """(record): the records of the files, given as (path, length), and the files that can't be cut.

    Those are files with quotes in other places, which only a reader from the beginning can tell apart.
    Quotes within quotes are doubled; records end with a line feed, with or without a carriage return. Empty
    lines are no records. Ranges are of ``size`` bytes, longer ones (up to RANGE) where :func:`range_size` says so. The
    driver holds three values per range.
    """
    size = -(-range_size([length for _, length in files], size // 2 * 2, RANGE) // 2) * 2
    pieces = [(path, low, min(low + size, length)) for path, length in files for low in range(0, length, size)]
    layout = "path STRING, start BIGINT, stop BIGINT"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, outside, inside = quote_counts(row["path"], row["start"], row["stop"], separator)
                yield pa.RecordBatch.from_pylist([row | {"n": n, "sound": [outside, inside]}])

    cut = spark.createDataFrame(pieces, layout).repartition(max(len(pieces), 1))
    seen = {(r.path, r.start): r for r in cut.mapInArrow(first, f"{layout}, n BIGINT, sound ARRAY<BOOLEAN>").collect()}
    begun, odd, inside = [], set(), False
    for path, low, high in pieces:
        inside = inside and low > 0
        begun.append((path, low, high, inside))
        found = seen[path, low]
        if not found.sound[inside]:
            odd.add(path)
        inside = (found.n + inside) % 2 == 1
        if high - low < size and inside:
            odd.add(path)
    known = spark.createDataFrame([b for b in begun if b[0] not in odd], f"{layout}, inside BOOLEAN")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for found in record_blocks(**row):
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["record"])

    return known.repartition(max(len(begun), 1)).mapInArrow(read, "record STRING"), sorted(odd)


def parsed(rows: DataFrame, layout: str, separator: str = ";") -> DataFrame:
    return rows.select(F.from_csv("record", F.lit(layout), {"sep": separator, "escape": '"'}).alias("row")).select("row.*")
