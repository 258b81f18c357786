"""One long listing document read by many tasks.

A range of bytes can't tell where it begins: in a string, behind an escape sign, how deep in brackets. A first
pass finds for each range, and each way it may begin, how it ends; put one after another these give
every range's beginning. A second pass, knowing it, collects what stands outside of arrays and
objects of the document's own object: that text, a few bytes, is parsed on the driver, names the
array of listings and shows a document that is broken or cut off. Then the data source
``listing_ranges`` reads the array, one task per range: a range reads the listings whose comma (or the array's
bracket) lies in it, on into the next range to the end of the last one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lapseflow.sources.files import opened, range_size

#: Bytes of a range; a shorter document isn't cut.
RANGE = 1 << 25
#: Bytes that are looked at together.
BLOCK = 1 << 20
#: Bytes of the longest listing, and of all that a document holds beside its listings.
MOST = 1 << 26

_QUOTE, _ESCAPE, _COMMA, _OBJECT = b'"\\,{'
# With this bit set both opening brackets are one sign, and both closing ones.
_FOLD, _OPENS, _CLOSES = 0x20, b"{"[0], b"}"[0]
_BLANK = np.zeros(256, bool)
_BLANK[[*b" \t\r\n"]] = True


@dataclass
class Place:
    """Where scanning stands: before byte ``at``, in a string or not, ``depth`` brackets deep."""

    at: int
    inside: bool = False
    depth: int = 0
    escaped: bool = False


@dataclass
class Block:
    """Bytes from ``at`` on, and their brackets: where, whether in a string, +1 or -1, and the depth behind each."""

    at: int
    raw: np.ndarray
    where: np.ndarray
    quoted: np.ndarray
    step: np.ndarray
    depth: np.ndarray
    depth_before: int


def _unescaped(raw: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """The quotes that no escape sign stands before, and whether the first byte behind is escaped."""
    quotes = np.flatnonzero(raw == _QUOTE)
    signs = np.flatnonzero(raw == _ESCAPE)
    if not len(signs):
        return quotes[1:] if escaped and len(quotes) and quotes[0] == 0 else quotes, False
    # Within a run of escape signs every second one escapes what follows it.
    new = np.ones(len(signs), bool)
    new[1:] = signs[1:] != signs[:-1] + 1
    run = np.flatnonzero(new)
    place = np.arange(len(signs)) - np.repeat(run, np.diff(np.append(run, len(signs))))
    if escaped and signs[0] == 0:
        # The first sign is itself escaped.
        place[: run[1] if len(run) > 1 else len(signs)] += 1
    taken = signs[place % 2 == 0] + 1
    if escaped:
        taken = np.concatenate([[0], taken])
    return np.setdiff1d(quotes, taken, assume_unique=True), bool(len(taken) and taken[-1] == len(raw))


def _blocks(file: pa.NativeFile, place: Place, stop: int, block: int = BLOCK) -> Iterator[Block]:
    """What stands before ``stop``, block by block; ``place`` moves on."""
    file.seek(place.at)
    while place.at < stop:
        raw = np.frombuffer(file.read(min(block, stop - place.at)), np.uint8)
        if not len(raw):
            return
        quotes, escaped = _unescaped(raw, place.escaped)
        folded = raw | _FOLD
        where = np.flatnonzero((folded == _OPENS) | (folded == _CLOSES))
        quoted = (np.searchsorted(quotes, where) + place.inside) % 2 == 1
        step = np.where(folded[where] == _OPENS, 1, -1)
        depth = np.cumsum(np.where(quoted, 0, step)) + place.depth
        found = Block(place.at, raw, where, quoted, step, depth, place.depth)
        place.at += len(raw)
        place.inside = bool((len(quotes) + place.inside) % 2)
        place.escaped = escaped
        place.depth = int(depth[-1]) if len(depth) else place.depth
        yield found


def border(file: pa.NativeFile, at: int) -> int:
    """The first place from ``at`` on that isn't behind an escape sign: there ranges really meet."""
    while at > 0:
        file.seek(at - 1)
        if file.read(1) != bytes([_ESCAPE]):
            break
        at += 1
    return at


def outcomes(path: str, start: int, stop: int, block: int = BLOCK) -> list[tuple[bool, int]]:
    """Whether a range ends in a string, and the change of depth in it, if it begins outside and if inside of one."""
    with opened(path) as file:
        place = Place(border(file, start))
        outside = inside = 0
        for found in _blocks(file, place, border(file, stop), block):
            outside += int(found.step[~found.quoted].sum())
            inside += int(found.step[found.quoted].sum())
    return [(place.inside, outside), (not place.inside, inside)]


def outer_text(path: str, place: Place, stop: int, block: int = BLOCK) -> tuple[bytes, list[int]]:
    """The bytes of a range outside of the outermost object's own arrays and objects, and where these begin and end."""
    kept, borders, size = [], [], 0
    with opened(path) as file:
        place.at = border(file, place.at)
        for found in _blocks(file, place, border(file, stop), block):
            text = found.raw.tobytes()
            before = np.concatenate([[found.depth_before], found.depth[:-1]])
            low = 0 if found.depth_before <= 1 else None
            for i in np.flatnonzero(~found.quoted & ((before <= 1) | (found.depth <= 1))).tolist():
                at = int(found.where[i])
                # Their own brackets stay.
                kept.append(text[at if low is None else low : at + 1])
                size += len(kept[-1])
                low = at + 1 if found.depth[i] <= 1 else None
                if {before[i], found.depth[i]} == {1, 2}:
                    borders.append(at + found.at)
            if low is not None:
                kept.append(text[low:])
                size += len(kept[-1])
            if size > MOST:
                raise ValueError(f"malformed listing document: over {MOST} bytes beside its listings")
    return b"".join(kept), borders


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``stop`` of a document, where it begins, and the document's array from ``low`` to ``high``."""

    path: str
    start: int
    stop: int
    inside: bool
    depth: int
    low: int
    high: int


def spans(outer: bytes, borders: list[int], path: str, key: str) -> list[tuple[int, int]]:
    """Where the arrays ``key`` begin and end, given a document's outer text; the rest of it must be sound."""
    text = outer.decode()
    try:
        if not isinstance(json.loads(text), dict):
            raise ValueError("not an object")
    except ValueError as error:
        raise ValueError(f"malformed listing document {path}: {error}") from None
    decode = json.JSONDecoder().raw_decode
    found, number = [], 0
    at = text.index("{") + 1
    with opened(path) as file:
        while (at := _after_blank(text, at)) < len(text) and text[at] != "}":
            name, at = decode(text, at)
            at = _after_blank(text, _after_blank(text, at) + 1)
            if text[at] in "[{":
                low, high = borders[2 * number : 2 * number + 2]
                number += 1
                if name == key and text[at] == "[":
                    found.append((low, high))
                elif high - low > MOST:
                    raise ValueError(f"malformed listing document {path}: over {MOST} bytes beside its listings")
                else:
                    file.seek(low)
                    json.loads(file.read(high + 1 - low))
            _, at = decode(text, at)
            at = _after_blank(text, at)
            at += text[at] == ","
    if not found:
        raise ValueError(f"malformed listing document {path}: no array {key!r}")
    return found


def _after_blank(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t\r\n":
        at += 1
    return at


def listings(part: Range, block: int = BLOCK, most: int = MOST) -> Iterator[list[bytes]]:
    """The texts of the listings that begin in a range, block by block. Whatever isn't an object is an error."""
    with opened(part.path) as file:
        start, stop = border(file, part.start), border(file, part.stop)
        # Where the listing that is being read follows its comma or bracket; before the range's first one: none.
        since = part.low if start <= part.low else None
        place = Place(start, part.inside, part.depth) if since is None else Place(part.low + 1, False, 2)
        held, begun = b"", False
        for found in _blocks(file, place, part.high + 1, block):
            raw, at = found.raw, found.at
            own = ~found.quoted
            where, depth, step = found.where[own], found.depth[own], found.step[own]
            # The bytes two brackets deep: behind each bracket that ends there, up to the next one.
            lows = np.concatenate([[0], where + 1])
            sizes = np.where(np.concatenate([[found.depth_before], depth]) == 2, np.append(where, len(raw)) - lows, 0)
            flat = np.arange(sizes.sum()) + np.repeat(lows - (np.cumsum(sizes) - sizes), sizes)
            cuts = np.sort(np.concatenate([flat[raw[flat] == _COMMA], where[(depth == 1) & (step < 0)]]))
            first = 0 if since is not None else int(cuts[0]) if len(cuts) else len(raw)
            text, texts, low, done = raw.tobytes(), [], 0, False
            for cut in cuts.tolist():
                if since is not None:
                    texts.append(held + text[low:cut])
                held, low = b"", cut + 1
                since = at + cut
                # Past the range, or behind the array.
                if done := since >= stop or raw[cut] != _COMMA:
                    break
            last = low if done else len(raw)
            # Between commas stands one object, and blanks.
            between = raw[flat[(flat >= first) & (flat < last)]]
            opens = where[(depth == 3) & (step > 0) & (where >= first) & (where < last)]
            group = np.searchsorted(cuts, opens)
            if (
                (~_BLANK[between] & (between != _COMMA)).any()
                or (raw[opens] != _OBJECT).any()
                or (group[1:] == group[:-1]).any()
                or (begun and len(group) and group[0] == 0)
            ):
                raise ValueError(f"malformed listing document {part.path}: a listing that isn't an object, or no comma behind one")
            begun = bool(len(group) and group[-1] == len(cuts)) or (begun and not len(cuts))
            if texts:
                yield texts
            if done or (since is None and place.at >= stop):
                return
            if since is not None:
                held += text[low:]
                if len(held) > most:
                    raise ValueError(f"malformed listing document {part.path}: a listing of over {most} bytes")


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._ranges = [Range(*r) for r in json.loads(options["ranges"])]
        self._block = int(options.get("block", BLOCK))

    def __getstate__(self) -> dict:
        # Every task gets the reader: it must not bring the ranges of all others.
        return {**self.__dict__, "_ranges": []}

    def partitions(self) -> list[Range]:
        return self._ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for texts in listings(partition, self._block):
            found = [t.strip(b" \t\r\n") for t in texts]
            # An empty array is one blank text; any other listing has at most blanks around it.
            if found == [b""] and partition.high - partition.low == len(texts[0]) + 1:
                continue
            if not all(found):
                raise ValueError(f"malformed listing document {partition.path}: a listing is missing")
            yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in found], pa.string())], names=["entry"])


class ListingRanges(DataSource):
    """The listings of long documents, one partition per range; :func:`long_documents` finds the ranges."""

    @classmethod
    def name(cls) -> str:
        return "listing_ranges"

    def schema(self) -> str:
        return "entry STRING"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def long_documents(spark: SparkSession, files: list[tuple[str, int]], key: str = "data", size: int = RANGE, block: int = BLOCK) -> DataFrame:
    """(entry): the text of each element of the array ``key`` of each document, given as (path, length).

    Ranges are of ``size`` bytes, longer ones (up to RANGE) where :func:`range_size` says so. The driver holds a few
    numbers per range. A broken or cut-off document fails: in its outer text before
    anything is read, in a listing when the listing is parsed (``FAILFAST``).
    """
    size = range_size([length for _, length in files], size, RANGE)
    pieces = [(path, low, min(low + size, length)) for path, length in files for low in range(0, length, size)]
    cut = spark.createDataFrame(pieces, "path STRING, start BIGINT, stop BIGINT").repartition(max(len(pieces), 1))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = outcomes(row["path"], row["start"], row["stop"], block)
                row |= {"ends": [s for s, _ in found], "depths": [d for _, d in found]}
                yield pa.RecordBatch.from_pylist([row])

    ends = {(r.path, r.start): r for r in cut.mapInArrow(first, "path STRING, start BIGINT, stop BIGINT, ends ARRAY<BOOLEAN>, depths ARRAY<BIGINT>").collect()}
    begun, inside, depth = {}, False, 0
    for path, low, high in pieces:
        if low == 0:
            inside, depth = False, 0
        begun[path, low] = (path, low, high, inside, depth)
        end = ends[path, low]
        inside, depth = end.ends[inside], depth + end.depths[inside]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                outer, borders = outer_text(row["path"], Place(row["start"], row["inside"], row["depth"]), row["stop"], block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]]), pa.array([row["start"]]), pa.array([outer], pa.binary()), pa.array([borders], pa.list_(pa.int64()))],
                    names=["path", "start", "outer", "borders"],
                )

    known = spark.createDataFrame([*begun.values()], "path STRING, start BIGINT, stop BIGINT, inside BOOLEAN, depth BIGINT").repartition(max(len(begun), 1))
    outers = {(r.path, r.start): r for r in known.mapInArrow(second, "path STRING, start BIGINT, outer BINARY, borders ARRAY<BIGINT>").collect()}
    parts = []
    for path, length in files:
        own = [outers[path, low] for low in range(0, length, size)]
        arrays = spans(b"".join(bytes(r.outer) for r in own), [b for r in own for b in r.borders], path, key)
        for low in range(0, length, size):
            _, _, high, inside, depth = begun[path, low]
            parts += [Range(path, low, high, inside, depth, a, b) for a, b in arrays if low <= b and a < high]
    spark.dataSource.register(ListingRanges)
    return spark.read.format("listing_ranges").option("ranges", json.dumps([astuple(p) for p in parts])).option("block", block).load()
