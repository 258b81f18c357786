"""I-Match fingerprints with randomised lexicons.

The lexicon holds the words within a band of inverse document frequency: neither those that stand in
more than a share of all documents nor those in fewer than a much smaller share. The lower share bounds
the lexicon, whatever the corpus, to the mean number of distinct words of a document over that
share. A text's distinct lexicon words, sorted, are hashed once in full and once for each of
several random parts of the lexicon. Parts come in levels, each half the size of the one before, so that texts of any
length have levels in which a part holds about one of their words: there, a part's hash
survives an edit that leaves the word alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Shares of all documents between which a lexicon word's document frequency lies.
RAREST, COMMONEST = 0.0005, 0.1
#: Of texts with fewer lexicon words all words count; and so they do of a text that such a one is compared with.
FEWEST = 3
#: Random parts of each level, and levels: parts hold 1/2, 1/4 ... of the lexicon.
PARTS, LEVELS = 16, 13
#: Hexadecimal digits of the full hash, and of a part's.
FULL, DIGITS = 16, 3
#: Bytes of text that are counted before the counts are passed on, and that are hashed at once.
COUNTED, PIECE = 8 << 20, 1 << 19


def _distinct(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct words of each text: hashes and bounds."""
    return tokens.shingles(tokens.words(column, tokens.ALNUM), 1)


def lexicon(docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> np.ndarray:
    """Sorted hashes of the words within the band, from the document frequencies over all texts.

    The shares are of all rows, nulls included; a word in one document is within the band if
    that is share enough.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tokens.slices(batch.column(0), COUNTED, COUNTED):
                seen = [_distinct(batch.column(0).slice(low + a, b - a))[0] for a, b in tokens.slices(batch.column(0).slice(low, high - low), PIECE)]
                words, n = np.unique(np.concatenate(seen), return_counts=True)
                yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    total = docs.count()
    words = docs.select(F.col("text").cast("string")).mapInArrow(count, "word bigint, n bigint")
    band = words.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= rarest * total) & (F.col("n") <= commonest * total))
    return np.sort(band.select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _lexical(keys: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word is of the lexicon, and whether each text has fewer such words than ``FEWEST``."""
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    within = known[at] == keys if len(known) else np.zeros(len(keys), bool)
    seen = np.concatenate([[0], np.cumsum(within)])
    return within, seen[bounds[1:]] - seen[bounds[:-1]] < FEWEST


def fingerprints(column: pa.Array, known: np.ndarray) -> list[str]:
    """A text's full hash and, level by level, the hashes of its parts; a part without words is all zeros."""
    keys, bounds = _distinct(column)
    within, few = _lexical(keys, bounds, known)
    return _coded(keys, bounds, within | np.repeat(few, np.diff(bounds)))


def _coded(keys: np.ndarray, bounds: np.ndarray, use: np.ndarray) -> list[str]:
    """The fingerprints of the words that are used."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))[use]
    keys = keys[use]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    full = tokens.mix(_sums(tokens.mix(keys), bounds) + np.diff(bounds).astype(np.uint64))
    parts = np.zeros((n, LEVELS * PARTS), np.uint64)
    for part, seed in enumerate(tokens.seeds(PARTS, salt=17)):
        lot, value, whose = tokens.mix(keys ^ seed), tokens.mix(keys + seed), owner
        for level in range(LEVELS):
            # Lots below 2 ** (63 - level): the word belongs to the part of this level.
            inside = lot >> np.uint64(63 - level) == 0
            lot, value, whose = lot[inside], value[inside], whose[inside]
            edges = np.searchsorted(whose, np.arange(n + 1))
            # 1 to 4095, so that only parts without words are zero.
            code = 1 + tokens.mix(_sums(value, edges)) % np.uint64(16**DIGITS - 1)
            parts[:, level * PARTS + part] = np.where(np.diff(edges) > 0, code, 0)
    return [f"{f:0{FULL}x}" + "".join(f"{p:0{DIGITS}x}" for p in row) for f, row in zip(full.tolist(), parts.tolist(), strict=True)]


def likeness(a: str, b: str) -> float:
    """From 0 to 1: 1 for equal full hashes, else the share of equal parts at the levels that tell most.

    Those are the levels at which some parts have no word of either text, and the next denser one;
    parts without words on both sides don't count.
    """
    if a[:FULL] == b[:FULL]:
        return 1.0
    empty = "0" * DIGITS
    same = some = 0
    for level in reversed(range(LEVELS)):
        start = FULL + level * PARTS * DIGITS
        pairs = [(a[i : i + DIGITS], b[i : i + DIGITS]) for i in range(start, start + PARTS * DIGITS, DIGITS)]
        filled = [(x, y) for x, y in pairs if x != empty or y != empty]
        same += sum(x == y for x, y in filled)
        some += len(filled)
        if len(filled) == PARTS:
            break
    return same / some if some else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``following``, or all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(rows: list[tuple[int | None, str]], known: np.ndarray) -> list[tuple]:
    """Result columns of each row but the last, which is only the one that follows."""
    changed = [edited(text, rows[i + 1][1]) for i, (_, text) in enumerate(rows[:-1])]
    texts = [t for _, t in rows]
    keys, bounds = _distinct(pa.array(texts + changed, pa.string()))
    within, few = _lexical(keys, bounds, known)
    codes = _coded(keys, bounds, within | np.repeat(few, np.diff(bounds)))
    n = len(texts)
    pairs = [(i, n + i) for i in range(n - 1)] + [(i, i + 1) for i in range(n - 1)]
    # Where only one of two texts has too few lexicon words, all words of both count: like is compared with like.
    unlike = sorted({i for pair in pairs if few[pair[0]] != few[pair[1]] for i in pair if not few[i]})
    whole = dict(enumerate(codes))
    if unlike:
        own = [keys[bounds[i] : bounds[i + 1]] for i in unlike]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        found = np.concatenate(own)
        whole |= dict(zip(unlike, _coded(found, edges, np.ones(len(found), bool)), strict=True))

    def alike(a: int, b: int) -> float:
        return likeness(codes[a], codes[b]) if few[a] == few[b] else likeness(whole[a], whole[b])

    return [
        (
            rows[i][0],
            len(texts[i]),
            hashlib.sha256(changed[i].encode()).hexdigest(),
            codes[i],
            codes[n + i],
            alike(i, n + i),
            alike(i, i + 1),
        )
        for i in range(n - 1)
    ]


_COLUMNS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}
_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[]] * len(_COLUMNS)
    return pa.record_batch([pa.array(list(c), kind) for c, kind in zip(columns, _COLUMNS.values(), strict=True)], names=list(_COLUMNS))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        found = pa.array([pack(x.encode()) for x in batch.column(2).to_pylist()], pa.binary())
        yield pa.record_batch([batch.column(0), batch.column(1), found], names=["doc_id", "text_hash", "packed"])


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    Documents follow each other by descending id, the first after the last; a document alone follows
    itself. Rows without an id come last; rows that share an id stand in the order of
    their texts' hashes. Null texts are empty.

    The texts are sorted by ranges, once, and travel compressed. Within a range a task sees each document's
    successor; the ends of the ranges, two rows each, are compared in a second step.
    """
    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    packed = rows.mapInArrow(_pack, "doc_id bigint, text_hash bigint, packed binary")
    dealt = packed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def with_end(found: list[tuple], kind: str, end: tuple[int | None, str] | None) -> pa.RecordBatch:
            batch = _batch(found)
            n = len(found)
            names = [*batch.schema.names, "part", "kind", "end_id", "end_text"]
            if end is None:
                none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
                return pa.RecordBatch.from_arrays([*batch.columns, *none], names=names)
            blank = [pa.nulls(1, k) for k in _COLUMNS.values()]
            own = [pa.array([part], pa.int32()), pa.array([kind]), pa.array([end[0]], pa.int64()), pa.array([end[1]], pa.string())]
            return pa.RecordBatch.from_arrays([*blank, *own], names=names)

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            # A compressed text is about half of it.
            for low, high in tokens.slices(batch.column(1), PIECE // 2):
                piece = batch.slice(low, high - low)
                here = [(i, unpack(x).decode()) for i, x in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)]
                if last is None:
                    yield with_end([], "first", here[0])
                else:
                    here.insert(0, last)
                last = here[-1]
                yield with_end(_compared(here, known.value), "", None)
        if last is not None:
            yield with_end([], "last", last)

    walked = stored(
        dealt.mapInArrow(walk, f"{_RESULT}, part int, kind string, end_id bigint, end_text string"), "walked", compression="zstd"
    )
    inner = walked.where("kind IS NULL").select(*_COLUMNS)
    ends = walked.where("kind IS NOT NULL").select("part", "kind", "end_id", "end_text")
    # As many numbers as there are ranges.
    parts = sorted(r["part"] for r in ends.where("kind = 'last'").select("part").collect())
    if not parts:
        return inner
    follows = docs.sparkSession.createDataFrame(
        list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, following int"
    )
    first = ends.where("kind = 'first'").select(F.col("part").alias("following"), F.col("end_id").alias("next_id"), F.col("end_text").alias("next_text"))
    pairs = ends.where("kind = 'last'").join(F.broadcast(follows), "part").join(first, "following").select("end_id", "end_text", "next_id", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for a, text, b, following in zip(*columns, strict=True):
                yield _batch(_compared([(a, text), (b, following)], known.value))

    return inner.unionByName(pairs.mapInArrow(close, _RESULT))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document, its edited text and the next document's."""
    return compared_with_next(table(spark, folder, "documents").select("doc_id", "text"))
