"""Collocations by marginalising the counts of longest windows.

Each word leads one window: itself and the two words after it, padded where its piece ends. Only these
windows are counted. The windows that begin with a phrase are exactly the phrase's occurrences, so the
counts of all shorter phrases are sums of windows by their first words, which Spark's ROLLUP takes.

Tasks cut texts with array operations and count the windows of a chunk. What they send is dealt out by the leading
word, so that a task sees all windows of a word and passes on, before the ROLLUP, only phrases that
are frequent enough; the rest of a phrase's windows count with the phrase they begin with. A leading word (or pair)
that heads too many windows for one task is dealt out by its second (or third) word instead,
and the ROLLUP sums up its parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Words of the longest phrases.
LONGEST = 3
#: Occurrences that make a phrase a candidate.
LEAST = 10
#: A candidate goes if a longer one that holds it has so many hundredths of its occurrences.
COVERED = 50
#: Phrases reported per language.
REPORTED = 2000
#: Bytes of text whose windows are counted together before they are sent.
CHUNK = 1 << 23
#: A word is heavy if it leads more windows than a shuffle partition's fair share divided by this.
SPREAD = 8
#: Groups that the windows of a heavy word are dealt to.
SPLIT = 4096
#: A chunk reports words and pairs that lead more than this share of its windows, or a smaller one.
HEAVY = 1e-4
#: Bytes of windows that a task sums up together.
HELD = 1 << 24
#: Parts in which a language's candidates are ranked before the last ranking.
PARTS = 64

_WORD, _GAP, _BREAK = 0, 1, 2
_SPACE, _LINE = 0x20, 0x0A
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _GAP
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)
_FACTORS = tokens.seeds(4, salt=13)


class Chunk:
    """The distinct windows of some text: words as numbers into ``words`` (0: none), and their counts."""

    def __init__(self, raw: np.ndarray, edges: np.ndarray, langs: np.ndarray) -> None:
        """``edges``: where in ``raw`` texts begin; ``langs``: the number of each text's language."""
        kind = _CLASS[raw]
        inside = kind == _WORD
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[edges] = inside[edges]
        at = np.flatnonzero(begins)
        broken = kind == _BREAK
        broken[edges] = True
        piece = np.cumsum(broken, dtype=np.int32)[at]
        index = np.flatnonzero(inside)
        offsets = np.append(np.searchsorted(index, at), len(index)).astype(np.int64)
        letters = _LOWER[raw[index]]
        spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        del kind, inside, begins, broken, index
        coded = spelled.dictionary_encode()
        self.words = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary])
        self.total = len(at)
        first = coded.indices.to_numpy().astype(np.int64) + 1
        # The lead windows: the words one and two places on, within the piece.
        second, third = np.zeros_like(first), np.zeros_like(first)
        near = piece[1:] == piece[:-1]
        second[:-1][near] = first[1:][near]
        third[:-1] = np.where(near, second[1:], 0)
        size = len(self.words)
        lang = langs[np.searchsorted(edges, at, "right") - 1].astype(np.int64)
        pairs, pair = np.unique((lang * size + first) * size + second, return_inverse=True)
        windows, self.counts = np.unique(pair.astype(np.int64) * size + third, return_counts=True)
        lead = pairs[windows // size]
        self.third = windows % size
        self.second = lead % size
        self.first = lead // size % size
        self.lang = lead // size // size

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of language and word, of these and the second word, and of all, for each window."""
        hashes = tokens.mix(np.array([crc32(w) for w in self.words.to_pylist()], np.uint64))
        word = tokens.mix(hashes[self.first] * _FACTORS[0] + self.lang_hashes[self.lang])
        pair = tokens.mix(word + hashes[self.second] * _FACTORS[1])
        return word, pair, tokens.mix(pair + hashes[self.third] * _FACTORS[2])


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Chunk, list[str]]]:
    """Chunks of (lang, text) batches, and the names of the languages their numbers stand for."""
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        names = coded.dictionary.to_pylist()
        hashes = tokens.mix(np.array([crc32(x.encode()) for x in names], np.uint64) + np.uint64(1))
        langs = coded.indices.to_numpy()
        raw, starts = tokens.text_bytes(batch.column(1))
        low = 0
        while low < len(raw):
            high = min(low + size, len(raw))
            while high < len(raw) and _CLASS[raw[high - 1]] != _BREAK:
                # On to the end of the piece or of the text.
                ends = np.flatnonzero(_CLASS[raw[high : high + 65536]] == _BREAK)
                piece = high + int(ends[0]) + 1 if len(ends) else min(high + 65536, len(raw))
                text = int(starts[np.searchsorted(starts, high)])
                high = min(piece, text)
                if high == text:
                    break
            texts = np.flatnonzero((starts[1:] > low) & (starts[:-1] < high))
            chunk = Chunk(raw[low:high], np.maximum(starts[:-1][texts] - low, 0), langs[texts])
            chunk.lang_hashes = hashes
            yield chunk, names
            low = high


def _pieces(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def heavy_leads(texts: DataFrame, size: int = CHUNK, share: float = HEAVY) -> tuple[int, DataFrame]:
    """How many windows there are, and what words and pairs lead many: (kind, key, n), kind 1 words, 2 pairs.

    This decides how windows are dealt out and changes no count: one that a chunk doesn't report is
    dealt out as any other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _ in _chunks(batches, size):
            kinds, keys, counts = [0], [0], [chunk.total]
            least = max(chunk.total * share, 16)
            for kind, key in enumerate(chunk.keys()[:2], 1):
                found, where = np.unique(key, return_inverse=True)
                n = np.bincount(where, chunk.counts, len(found))
                for i in np.flatnonzero(n > least):
                    kinds.append(kind)
                    keys.append(int(found[i].view(np.int64)))
                    counts.append(int(n[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["kind", "key", "n"]
            )

    seen = stored(texts.mapInArrow(run, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n")), "leads")
    total = seen.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return total, seen.where("kind > 0")


def longest_windows(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, chunk: int = CHUNK, groups: int | None = None) -> DataFrame:
    """(lang, w1, w2, w3, n): counts of longest windows; windows of phrases under ``least`` stand with a shorter prefix.

    An empty word means: no such word, or one of no importance. Sums over a prefix are exact for every
    phrase of ``least`` occurrences, and so is the sum of a language. A word, or pair, is heavy if it leads more
    than one window in ``groups``.
    """
    texts = _pieces(docs, lang, text)
    groups = groups or SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, heavy = heavy_leads(texts, chunk, min(HEAVY, 0.5 / groups))
    # Fewer words than ``groups``, and fewer pairs.
    chosen = heavy.where(F.col("n") * groups > total).collect()
    leads = [np.array(sorted(r["key"] for r in chosen if r["kind"] == k), np.int64).view(np.uint64) for k in (1, 2)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, names in _chunks(batches, chunk):
            if found.total:
                yield _by_lead(found, names, leads)

    sent = texts.mapInArrow(send, "lang string, w1 binary, whole int, part bigint, windows binary, counts binary")
    group = ["lang", "w1", "whole", "part"]
    dealt = sent.repartition(*group).sortWithinPartitions(*group)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            yield _summed(rows, least)

    found = dealt.mapInArrow(receive, "lang string, w1 binary, w2 binary, w3 binary, n bigint")
    return found.select("lang", *[F.col(w).cast("string").alias(w) for w in ("w1", "w2", "w3")], "n")


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before; the first row counts."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _packed(letters: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters)])


def _by_lead(found: Chunk, names: list[str], leads: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each leading word of a chunk: its windows' other words, line by line, and their counts.

    ``whole``: how many words of a window it takes for all windows that begin with them to be dealt to
    one group: 1, for heavy words 2, for heavy pairs 3. ``part`` tells the groups of a heavy word apart.
    """
    word, pair, window = found.keys()
    whole = np.where(np.isin(word, leads[0]), np.where(np.isin(pair, leads[1]), 3, 2), 1)
    part = (np.choose(whole - 1, [np.zeros_like(word), pair, window]) % np.uint64(SPLIT)).astype(np.int64)
    order = np.arange(len(whole)) if (whole == 1).all() else np.lexsort((part, whole, found.first, found.lang))
    lang, first, whole, part = (x[order] for x in (found.lang, found.first, whole, part))
    others = [found.words.take(pa.array(x[order])) for x in (found.second, found.third)]
    lines = pc.binary_join_element_wise(*others, pa.scalar(b"\n", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
    letters, starts = tokens.text_bytes(lines)
    rows = _changes(lang, first, whole, part)
    ends = np.append(rows, len(order))
    counts = found.counts[order].astype(np.int32)
    columns = [
        pa.array(names, pa.string()).take(pa.array(lang[rows])),
        found.words.take(pa.array(first[rows])).cast(pa.binary()),
        pa.array(whole[rows], pa.int32()),
        pa.array(part[rows]),
        _packed(letters, starts[ends]),
        _packed(counts.view(np.uint8), 4 * ends),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "w1", "whole", "part", "windows", "counts"])


def _group_starts(rows: pa.Table) -> np.ndarray:
    codes = [rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "w1")]
    return _changes(*codes, rows.column("whole").to_numpy(), rows.column("part").to_numpy())


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.Table]:
    """Sorted rows in tables of about ``most`` bytes that end where a group ends."""
    held, size, limit = [], 0, most
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < limit:
            continue
        rows = pa.Table.from_batches(held)
        last = int(_group_starts(rows)[-1])
        if last:
            yield rows.slice(0, last)
            held = rows.slice(last).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
        # A group that fills the table goes on until it is whole.
        limit = max(most, 2 * size)
    if held:
        yield pa.Table.from_batches(held)


def _prefixes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The texts from ``starts`` to ``ends``, as numbers and a dictionary."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters[index])])
    return cut.dictionary_encode()


def _totals(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of ``n`` for each, and where each row's key stands among them."""
    found, where = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, n)
    return found, total, where


def _summed(rows: pa.Table, least: int) -> pa.RecordBatch:
    """The windows of whole groups, summed up; rare ones stand with their pair, rare pairs with their word.

    Phrases of fewer words than a group's ``whole`` may go on in other groups and are passed on,
    however rare they seem here.
    """
    rows = rows.combine_chunks()
    starts = _group_starts(rows)
    group_of_row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
    counts, at = tokens.text_bytes(rows.column("counts").combine_chunks())
    n = np.ascontiguousarray(counts).view(np.int32).astype(np.int64)
    group = np.repeat(group_of_row, np.diff(at) // 4)
    letters, _ = tokens.text_bytes(rows.column("windows").combine_chunks())
    # Each line is two words, each with a blank behind it, and its end.
    offsets = np.concatenate([[0], np.flatnonzero(letters == _LINE) + 1]).astype(np.int64)
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    size = len(lines.dictionary)
    windows, n, _ = _totals(group * size + lines.indices.to_numpy(), n)
    group, line = windows // size, windows % size
    letters, offsets = tokens.text_bytes(lines.dictionary)
    gaps = np.flatnonzero(letters == _SPACE).reshape(-1, 2)
    second = _prefixes(letters, offsets[:-1], gaps[:, 0])
    size = len(second.dictionary)
    pairs, pair_n, pair = _totals(group * size + second.indices.to_numpy()[line], n)
    pair_group, pair_second = pairs // size, pairs % size
    group_n = np.zeros(len(starts), np.int64)
    np.add.at(group_n, group, n)

    whole = rows.column("whole").to_numpy()[starts]
    has_third = (gaps[:, 1] > gaps[:, 0] + 1)[line]
    has_second = (pc.binary_length(second.dictionary).to_numpy() > 0)[pair_second]
    full = has_third & (n >= least)
    pair_kept = has_second & ((pair_n >= least) | (whole[pair_group] > 2))
    group_kept = (group_n >= least) | (whole > 1)
    # What isn't named by itself counts with its prefix.
    pair_rest = np.zeros(len(pairs), np.int64)
    np.add.at(pair_rest, pair[~full], n[~full])
    group_rest = np.zeros(len(starts), np.int64)
    np.add.at(group_rest, pair_group[~pair_kept], pair_rest[~pair_kept])
    langs = rows.column("lang").combine_chunks().take(pa.array(starts))
    words = rows.column("w1").combine_chunks().take(pa.array(starts))
    blank = np.array([b""], object)

    def named(where: np.ndarray, seconds, thirds, sums: np.ndarray) -> list:
        return [langs.take(pa.array(where)), words.take(pa.array(where)), seconds, thirds, pa.array(sums)]

    texts = [x.split(b" ") for x in lines.dictionary.take(pa.array(line[full])).to_pylist()]
    kept = pair_kept & (pair_rest > 0)
    left = group_kept & (group_rest > 0)
    lost = ~group_kept
    parts = [
        named(group[full], pa.array([x[0] for x in texts], pa.binary()), pa.array([x[1] for x in texts], pa.binary()), n[full]),
        named(pair_group[kept], second.dictionary.take(pa.array(pair_second[kept])).cast(pa.binary()), pa.array(np.repeat(blank, kept.sum()), pa.binary()), pair_rest[kept]),
        named(np.flatnonzero(left), *[pa.array(np.repeat(blank, left.sum()), pa.binary())] * 2, group_rest[left]),
    ]
    # Rare words count for their language only.
    of_lang = langs.dictionary_encode()
    sums = np.zeros(len(of_lang.dictionary), np.int64)
    np.add.at(sums, of_lang.indices.to_numpy()[lost], group_rest[lost])
    none = pa.array(np.repeat(blank, len(sums)), pa.binary())
    parts.append([of_lang.dictionary, none, none, none, pa.array(sums)])
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*parts, strict=True)], names=["lang", "w1", "w2", "w3", "n"])


def phrase_counts(windows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, size, f): phrases of at least ``least`` occurrences, and all words of a language (size 0)."""
    rolled = windows.rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    size = F.when(F.col("rolled") == 0, 3).when(F.col("rolled") == 1, 2).when(F.col("rolled") == 3, 1).when(F.col("rolled") == 7, 0)
    last = F.when(F.col("rolled") == 0, F.col("w3")).when(F.col("rolled") == 1, F.col("w2")).otherwise(F.col("w1"))
    sized = rolled.withColumn("size", size).where("size IS NOT NULL")
    return sized.where((F.col("size") == 0) | ((last != "") & (F.col("f") >= least))).select("lang", "w1", "w2", "w3", "size", "f")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly, in 38 digits."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    product = left * right
    # 10^6 a^2 < 10^38 for every a up to 10^15; the quotient is 10^6 at most.
    scaled = F.lit(1_000_000).cast("decimal(7,0)") * (a * a)
    return F.call_function("div", scaled, product).cast("bigint")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, covered: int = COVERED, reported: int = REPORTED, chunk: int = CHUNK, groups: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``reported`` best phrases of two and three words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at blanks and
    tabs. A phrase of ``a`` >= ``least`` occurrences scores floor(10^6 a^2 / (l r)) at its worst cut, the first of equal
    ones; phrases that a longer candidate covers to ``covered`` hundredths are left out. Ties go to the more
    frequent phrase, then to the one first by bytes. Null languages count as ``und``; null,
    empty and wordless texts have no phrases; repeated rows count each time; very long texts are counted whole,
    chunk by chunk; other columns don't matter. An empty table gives an empty result.
    """
    counts = stored(phrase_counts(longest_windows(docs, lang, text, least, chunk, groups), least), "phrases")

    def sized(size: int, names: list[str], f: str) -> DataFrame:
        return counts.where(F.col("size") == size).select("lang", *[F.col(f"w{i}").alias(x) for i, x in enumerate(names, 1)], F.col("f").alias(f))

    two = sized(2, ["w1", "w2"], "a")
    two = two.join(sized(1, ["w1"], "l"), ["lang", "w1"])
    two = two.join(sized(1, ["w2"], "r"), ["lang", "w2"])
    three = sized(3, ["w1", "w2", "w3"], "a")
    three = three.join(sized(2, ["w1", "w2"], "l2"), ["lang", "w1", "w2"])
    three = three.join(sized(2, ["w2", "w3"], "r1"), ["lang", "w2", "w3"])
    three = three.join(sized(1, ["w1"], "l1"), ["lang", "w1"])
    three = stored(three.join(sized(1, ["w3"], "r2"), ["lang", "w3"]), "threes")

    covers = F.lit(100) * F.col("a") >= F.lit(covered) * F.col("of")
    inner = three.select("lang", "w1", "w2", "a", F.col("l2").alias("of")).unionByName(
        three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a", F.col("r1").alias("of"))
    )
    two = two.join(inner.where(covers).select("lang", "w1", "w2").distinct(), ["lang", "w1", "w2"], "left_anti")
    early, late = _score(F.col("a"), F.col("l1"), F.col("r1")), _score(F.col("a"), F.col("l2"), F.col("r2"))
    cut = F.when(late < early, F.struct(F.col("l2").alias("l"), F.col("r2").alias("r"), late.alias("score"))).otherwise(
        F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"), early.alias("score"))
    )
    scored = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    scored = scored.unionByName(three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut.alias("_cut")).select("lang", "phrase", "a", "_cut.*"))

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Each part of a language gives its best, so that the last ranking sees a bounded number of rows.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    parted = scored.select("*", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*best)))
    ranked = parted.where(F.col("rank") <= reported).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)))
    sums = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return (
        ranked.where(F.col("rank") <= reported)
        .join(sums, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
cut AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM pieces),
windows AS (SELECT lang, unnest(list_zip(words, words[2:], words[3:])) AS w FROM cut),
one AS (SELECT lang, w[1] AS w1, count(*) AS f FROM windows GROUP BY ALL),
two AS (SELECT lang, w[1] AS w1, w[2] AS w2, count(*) AS f FROM windows WHERE w[2] IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w[1] AS w1, w[2] AS w2, w[3] AS w3, count(*) AS f FROM windows WHERE w[3] IS NOT NULL GROUP BY ALL),
cuts AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
    WHERE t.f >= {LEAST} AND NOT EXISTS (
        SELECT 1 FROM three c WHERE c.lang = t.lang AND c.f >= {LEAST} AND 100 * c.f >= {COVERED} * t.f
        AND ((c.w1 = t.w1 AND c.w2 = t.w2) OR (c.w2 = t.w1 AND c.w3 = t.w2)))
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
    FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3 WHERE t.f >= {LEAST}
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
    FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3 WHERE t.f >= {LEAST}
),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst),
sums AS (SELECT lang, count(*) AS n FROM windows GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sums USING (lang) WHERE rank <= {REPORTED}
"""


@query("op13_collocations", sql=_SQL)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best two- and three-word phrases of each language."""
    return collocations(table(spark, folder, "documents"))
