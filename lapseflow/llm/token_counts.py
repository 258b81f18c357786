"""Token counts of byte-level pair encodings, by rank-synchronous merging of ragged arrays.

A batch of texts is cut into pre-tokens with array operations: each character has a class (letter,
number, white space, other), a pre-token begins where the class changes, takes the blank before it,
and contractions are set apart. The distinct pre-tokens of a batch lie one after another in one array
of symbols. In each round every pre-token merges all places of its own lowest-ranked pair at once;
pre-tokens without a known pair drop out with the symbols they have left. A very long pre-token is
first cut where no merge of the vocabulary can reach across, and what is still very long is merged
rank by rank over linked positions, so that a round costs what it merges.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table

#: The vocabulary that is taken unless another is named.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens a training sequence holds.
LIMIT = 1024
#: Characters that are cut and merged at once; a piece ends where a pre-token ends.
PIECE = 1 << 19
#: Pre-tokens of more symbols are merged over linked positions.
LONG = 256
#: Pre-tokens of at most so many bytes are merged once for all their occurrences in a piece.
PACKED = 15

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_NONE = np.int32(2**31 - 1)
_QUOTE, _BLANK = 0x27, 0x20


@dataclass
class Vocabulary:
    """What counting needs of a tokenizer file, as small arrays that travel to the tasks.

    ``symbols``: the symbol of each byte. ``pairs``: left * size + right of all merges, ascending, with
    the ``ranks`` and the ``results`` of the merges. ``joints``: whether any merge joins a text ending
    with a byte to one beginning with another. ``special``: strings that count as one token each.
    ``runs``: first code points and classes of runs of characters of one class.
    """

    symbols: np.ndarray
    size: int
    pairs: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    joints: np.ndarray
    special: list[str]
    runs: tuple[np.ndarray, np.ndarray]

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs; rank ``_NONE`` where there is no merge."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        known = self.pairs[at] == key
        return np.where(known, self.ranks[at], _NONE), self.results[at]


def _byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte (fixed by the format)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


@lru_cache(maxsize=1)
def _class_runs() -> tuple[np.ndarray, np.ndarray]:
    """Classes of all code points as the library's own cutting of texts sees them.

    A code point that this Unicode version calls a letter is one if the library keeps it together
    with a letter, and so on: the two may know different versions.
    """
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern, probe in ((LETTER, r"\p{L}", "a"), (NUMBER, r"\p{N}", "1")):
        found = regex.findall(pattern, everything)
        begins = {span[0] for _, span in cut.pre_tokenize_str("".join(probe + c for c in found))}
        classes[[ord(c) for i, c in enumerate(found) if 2 * i + 1 not in begins]] = kind
    classes[[ord(c) for c in regex.findall(r"\s", everything)]] = SPACE
    first = np.flatnonzero(np.diff(classes, prepend=255))
    return first, classes[first]


@lru_cache(maxsize=4)
def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Read a byte-level pair encoding from a tokenizer file; any other kind is refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not (plain and spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)) or cut.get("add_prefix_space"):
        raise ValueError(f"not a plain byte-level pair encoding: {path}")
    added = spec.get("added_tokens", [])
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"added tokens that take surrounding text: {path}")
    ids = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    size = max(ids.values()) + 1
    left, right, result = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges), strict=True))
    pairs = left * size + right
    order = np.argsort(pairs, kind="stable")
    characters = _byte_characters()
    byte = {c: b for b, c in enumerate(characters)}
    joints = np.zeros((256, 256), bool)
    joints[[byte[a[-1]] for a, _ in merges], [byte[b[0]] for _, b in merges]] = True
    return Vocabulary(
        symbols=np.array([ids[c] for c in characters], np.int32),
        size=size,
        pairs=pairs[order],
        ranks=order.astype(np.int32),
        results=result[order].astype(np.int32),
        joints=joints,
        special=sorted((t["content"] for t in added), key=len, reverse=True),
        runs=_class_runs(),
    )


def _classes(words: Vocabulary) -> np.ndarray:
    first, kinds = words.runs
    return np.repeat(kinds, np.diff(np.append(first, 0x110000)))


def pre_token_starts(codes: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each of the code points; ``first`` marks the beginnings of texts."""
    n = len(codes)
    kind = classes[codes]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    starts = begins.copy()
    # White space before something else gives its last character away.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    starts[last] = True
    # A blank goes to what follows it.
    starts[last[codes[last] == _BLANK] + 1] = False
    # A quote that begins a pre-token takes the end of a contraction.
    quote = np.flatnonzero((codes == _QUOTE) & starts & begins)
    quote = quote[quote + 1 < n]
    quote = quote[begins[quote + 1] & ~first[quote + 1] & (kind[quote + 1] == LETTER)]
    one = quote[np.isin(codes[quote + 1], [ord(c) for c in "stmd"])]
    starts[one + 1] = False
    starts[one[one + 2 < n] + 2] = True
    two = quote[quote + 2 < n]
    two = two[~first[two + 2]]
    pair = codes[two + 1].astype(np.int64) << 32 | codes[two + 2]
    two = two[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    starts[two + 1] = False
    starts[two[two + 3 < n] + 3] = True
    return starts


def merged_lengths(raw: np.ndarray, bounds: np.ndarray, words: Vocabulary) -> np.ndarray:
    """Symbols that survive in each of the byte sequences ``raw[bounds[i]:bounds[i + 1]]``, none empty."""
    lengths = np.diff(bounds)
    counts = np.zeros(len(lengths), np.int64)
    # Long sequences fall into parts at bytes that no merge joins.
    owner = np.arange(len(lengths))
    if len(lengths) and lengths.max() > LONG:
        inside = np.ones(max(len(raw) - 1, 0), bool)
        inside[bounds[1:-1] - 1] = False
        in_long = np.repeat(lengths > LONG, lengths)
        cuts = np.flatnonzero(inside & in_long[1:] & ~words.joints[raw[:-1], raw[1:]]) + 1
        bounds = np.sort(np.concatenate([bounds, cuts]))
        owner = np.searchsorted(bounds, np.concatenate([[0], np.cumsum(lengths)])[:-1], "left")
        owner = np.repeat(np.arange(len(lengths)), np.diff(np.append(owner, len(bounds) - 1)))
        lengths = np.diff(bounds)
    symbols = words.symbols[raw]
    long = np.flatnonzero(lengths > LONG)
    for i in long:
        counts[owner[i]] += _linked(symbols[bounds[i] : bounds[i + 1]], words)
    if len(long):
        keep = lengths <= LONG
        symbols, lengths, owner = symbols[np.repeat(keep, lengths)], lengths[keep], owner[keep]
    alone = lengths < 2
    np.add.at(counts, owner[alone], 1)
    symbols, lengths, owner = symbols[np.repeat(~alone, lengths)], lengths[~alone], owner[~alone]
    while len(lengths):
        ends = np.cumsum(lengths)
        begins = ends - lengths
        ranks = np.full(len(symbols), _NONE, np.int32)
        results = np.zeros(len(symbols), np.int32)
        ranks[:-1], results[:-1] = words.rank(symbols[:-1], symbols[1:])
        ranks[ends - 1] = _NONE
        lowest = np.minimum.reduceat(ranks, begins)
        done = lowest == _NONE
        np.add.at(counts, owner[done], lengths[done])
        hit = np.flatnonzero((ranks == np.repeat(lowest, lengths)) & (ranks != _NONE))
        hit = _alternate(hit)
        symbols[hit] = results[hit]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        left = np.add.reduceat(keep, begins, dtype=np.int64)
        symbols = symbols[keep & np.repeat(~done, lengths)]
        lengths, owner = left[~done], owner[~done]
        single = lengths < 2
        if single.any():
            np.add.at(counts, owner[single], 1)
            symbols = symbols[np.repeat(~single, lengths)]
            lengths, owner = lengths[~single], owner[~single]
    return counts


def _alternate(at: np.ndarray) -> np.ndarray:
    """Of positions that follow each other directly every second one, from the left."""
    if not len(at):
        return at
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    run = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    return at[place % 2 == 0]


def _linked(symbols: np.ndarray, words: Vocabulary) -> int:
    """Surviving symbols of one long sequence: each round merges the places of the lowest rank only."""
    n = len(symbols)
    symbols = symbols.copy()
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    ranks = np.full(n, _NONE, np.int32)
    results = np.zeros(n, np.int32)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []
    left = n

    def look(at: np.ndarray) -> None:
        """Rank the pairs that begin at ``at`` and let them wait for their rank's turn."""
        ends = after[at] >= n
        ranks[at[ends]] = _NONE
        at = at[~ends]
        if not len(at):
            return
        ranks[at], results[at] = words.rank(symbols[at], symbols[after[at]])
        at = at[ranks[at] != _NONE]
        at = at[np.argsort(ranks[at], kind="stable")]
        edges = np.flatnonzero(np.diff(ranks[at], prepend=-1))
        for group in np.split(at, edges[1:]) if len(at) else ():
            rank = int(ranks[group[0]])
            if rank not in waiting:
                waiting[rank] = []
                heapq.heappush(queue, rank)
            waiting[rank].append(group)

    look(np.arange(n))
    while queue:
        rank = heapq.heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[ranks[at] == rank]
        if not len(at):
            continue
        # Places whose pairs share a symbol: every second one, from the left.
        linked = np.zeros(len(at), bool)
        linked[1:] = after[at[:-1]] == at[1:]
        run = np.flatnonzero(~linked)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[place % 2 == 0]
        gone = after[at]
        symbols[at] = results[at]
        ranks[gone] = _NONE
        after[at] = after[gone]
        inner = at[after[at] < n]
        before[after[inner]] = inner
        left -= len(at)
        touched = np.concatenate([at, before[at][before[at] >= 0]])
        look(np.unique(touched))
    return left


def pieces(text: str, classes: np.ndarray, most: int = PIECE) -> Iterator[str]:
    """Parts of a text of about ``most`` characters, cut before white space that follows something else."""
    low = 0
    while len(text) - low > most:
        high = low + most
        while high < len(text):
            codes = np.frombuffer(text[high - 1 : high + 4096].encode("utf-32-le", "replace"), np.uint32)
            kind = classes[codes]
            found = np.flatnonzero((kind[:-1] != SPACE) & (kind[1:] == SPACE))
            if len(found):
                high += int(found[0])
                break
            high += max(len(codes) - 1, 1)
        yield text[low:high]
        low = min(high, len(text))
    yield text[low:]


def _count(parts: list[str], owner: list[int], n: int, words: Vocabulary, classes: np.ndarray) -> np.ndarray:
    """Tokens of each of ``n`` texts, given some of their parts."""
    whole = "".join(parts)
    if not whole:
        return np.zeros(n, np.int64)
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(p) for p in parts])
    first = np.zeros(len(codes), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(pre_token_starts(codes, first, classes))
    text_of = np.repeat(np.array(owner), sizes)[starts]
    raw = np.frombuffer(whole.encode(), np.uint8)
    begin_of = np.flatnonzero((raw & 0xC0) != 0x80)
    bounds = np.append(begin_of[starts], len(raw))
    lengths = np.diff(bounds)
    total = np.zeros(n, np.int64)
    short = lengths <= PACKED
    if short.any():
        at, size = bounds[:-1][short], lengths[short]
        # All bytes and the length in two numbers: equal numbers are equal pre-tokens.
        packed = np.zeros((len(at), PACKED + 1), np.uint8)
        padded = np.concatenate([raw, np.zeros(PACKED, np.uint8)])
        for k in range(PACKED):
            packed[:, k] = np.where(size > k, padded[at + k], 0)
        packed[:, PACKED] = size
        high, low = packed.view(np.uint64).T
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        distinct = order[new]
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(new) - 1
        found = _lengths(raw, at[distinct], size[distinct], words)[index]
        total += np.bincount(text_of[short], found, n).astype(np.int64)
    if not short.all():
        found = _lengths(raw, bounds[:-1][~short], lengths[~short], words)
        total += np.bincount(text_of[~short], found, n).astype(np.int64)
    return total


def _lengths(raw: np.ndarray, at: np.ndarray, size: np.ndarray, words: Vocabulary) -> np.ndarray:
    bounds = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(bounds[-1]) + np.repeat(at - bounds[:-1], size)
    return merged_lengths(raw[index], bounds, words)


def count_tokens(texts: list[str], words: Vocabulary, classes: np.ndarray | None = None) -> np.ndarray:
    """Tokens of each text, as the vocabulary's library counts them without added tokens."""
    classes = _classes(words) if classes is None else classes
    cut = regex.compile("|".join(regex.escape(s) for s in words.special)) if words.special else None
    total = np.zeros(len(texts), np.int64)
    parts: list[str] = []
    owner: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        sections = cut.split(text) if cut else [text]
        total[i] += len(sections) - 1
        for section in sections:
            for part in pieces(section, classes):
                if parts and held + len(part) > PIECE:
                    total += _count(parts, owner, len(texts), words, classes)
                    parts, owner, held = [], [], 0
                parts.append(part)
                owner.append(i)
                held += len(part)
    return total + _count(parts, owner, len(texts), words, classes)


def token_counts(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes, tokens, more than ``limit`` tokens.

    A null text is empty and has no tokens; a null or repeated key is kept, row by row; other columns
    don't matter, whatever their names. An empty table gives an empty result. A very long text is
    counted in pieces that end between pre-tokens. Bytes that aren't UTF-8 count as what
    a decoder replaces them with. No row is moved: the counts come from one pass over the texts.

    Rank ties within a pre-token are places of one pair; they merge from the left, as in the library.
    """
    words = vocabulary(path)
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes(words)
        for batch in batches:
            for low, high in tokens.slices(batch.column(1), 4 * PIECE, rows=len(batch)):
                own = batch.slice(low, high - low)
                _, starts = tokens.text_bytes(own.column(1))
                texts = [x.decode(errors="replace") for x in own.column(1).cast(pa.large_binary()).to_pylist()]
                n = count_tokens(texts, words, classes)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(np.diff(starts)), pa.array(n), pa.array(n > limit)],
                    names=[key, "n_bytes", "n_tokens", "over_limit"],
                )

    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def token_totals(counts: DataFrame, docs: DataFrame, by: str = "source", key: str = "doc_id") -> DataFrame:
    """Documents, bytes, tokens and documents over the limit of each group, e.g. for mixing weights.

    ``key`` names one row of ``docs``. Null groups count as one.
    """
    group = docs.select(key, F.col(by).alias("_by"))
    return (
        counts.join(group, key)
        .groupBy(F.col("_by").alias(by))
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.sum("n_bytes").alias("n_bytes"),
            F.sum("n_tokens").alias("n_tokens"),
            F.count_if("over_limit").alias("over_limit"),
        )
    )


@query("op11_token_counts")
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(table(spark, folder, "documents"))
