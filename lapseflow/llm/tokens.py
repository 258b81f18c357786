"""Words of whole Arrow text columns as 64-bit hashes, computed with numpy inside a task.

Texts are cut on bytes: both word classes used here consist of all bytes of non-ASCII characters
and some ASCII bytes, so cutting UTF-8 bytes equals cutting characters. Work goes over pieces of
about ``PIECE`` bytes that end between words, and only hashes are kept of a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
SPACE = 0x20


def _lut(is_word) -> np.ndarray:
    """Byte to lower-cased byte, or to a space outside words."""
    codes = np.arange(256, dtype=np.uint8)
    lower = np.where((codes >= 0x41) & (codes <= 0x5A), codes + 32, codes)
    return np.array([c if is_word(int(c)) else SPACE for c in lower], dtype=np.uint8)


#: ASCII digits, letters and everything beyond ASCII.
ALNUM = _lut(lambda c: 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80)
#: Everything but ASCII white space.
SOLID = _lut(lambda c: c != 0x20 and not 0x09 <= c <= 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` odd 64-bit numbers, the same in every process."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_FACTORS = seeds(64)


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if len(_FACTORS) < n:
        _FACTORS = seeds(1 << int(n - 1).bit_length())
    return _FACTORS


@dataclass
class Words:
    """The words of some texts, in order.

    ``hashes``: one number per word. ``bounds``: text i has the words
    ``bounds[i]`` to ``bounds[i + 1]``.
    """

    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; null texts count as empty. Binary values are taken as they are."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.large_string()).fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def slices(column: pa.Array, most: int, rows: int = 512) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows with about ``most`` bytes of text; a longer text is a range of its own."""
    if not len(column):
        return
    _, starts = text_bytes(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + most, "right")) - 1)
        high = min(high, low + rows)
        yield low, high
        low = high


def words(column: pa.Array, lut: np.ndarray) -> Words:
    return words_of(*text_bytes(column), lut)


def words_of(raw: np.ndarray, starts: np.ndarray, lut: np.ndarray) -> Words:
    """The words of the bytes ``raw``, of which text i has those from ``starts[i]`` to ``starts[i + 1]``."""
    if not len(raw):
        return Words(np.zeros(0, np.uint64), np.zeros(len(starts), np.int64))
    hashes, begins = [], []
    low = 0
    breaks = starts[1:-1]
    while low < len(raw):
        high = min(low + PIECE, len(raw))
        cut = lut[raw[low:high]]
        while high < len(raw) and cut[-1] != SPACE:
            # Go on to the end of the word that the piece would split.
            more = lut[raw[high : high + 4096]]
            gap = np.flatnonzero(more == SPACE)
            more = more[: gap[0] + 1] if len(gap) else more
            cut = np.concatenate([cut, more])
            high += len(more)
        inside = cut != SPACE
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edge = breaks[(breaks >= low) & (breaks < high)] - low
        first[edge] = inside[edge]
        at = np.flatnonzero(first)
        if len(at):
            index = np.flatnonzero(inside)
            begin = np.searchsorted(index, at)
            lengths = np.diff(np.append(begin, len(index)))
            place = np.arange(len(index)) - np.repeat(begin, lengths)
            value = (cut[index].astype(np.uint64) + np.uint64(1)) * _factors(int(lengths.max()))[place]
            hashes.append(mix(np.add.reduceat(value, begin)))
            begins.append(at + low)
        low = high
    if not hashes:
        return Words(np.zeros(0, np.uint64), np.zeros(len(starts), np.int64))
    begin = np.concatenate(begins)
    return Words(np.concatenate(hashes), np.searchsorted(begin, starts, "left"))


def spelled(text: str | None, lut: np.ndarray) -> list[bytes]:
    """The words of one text themselves."""
    return [w for w in (text or "").encode().translate(lut.tobytes()).split(b" ") if w]


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed runs of ``size`` words of each text: all sets one after another, and their bounds.

    A text of fewer words gives its whole sequence as one, a text without words nothing.
    """
    n = len(found.hashes)
    counts = np.diff(found.bounds)
    rolled = np.zeros(n, np.uint64)
    factors = seeds(size, salt=7)
    owner = found.owners()
    left = np.repeat(found.bounds[1:], counts) - np.arange(n)
    for k in range(size):
        here = np.flatnonzero(left > k)
        rolled[here] += mix(found.hashes[here + k] + factors[k]) * factors[k]
    whole = (left >= size) | ((left == counts[owner]) if n else False)
    # A short text's only run gets its length mixed in, so that it differs from a full run.
    keys = mix(rolled + np.where(counts[owner] < size, counts[owner], 0).astype(np.uint64))
    keys, owner = keys[whole], owner[whole]
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(len(found) + 1))


def nested(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the bounds of each row's list."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
