"""Benchmark decontamination with a stored positional inverted index.

The training texts are cut into segments of about ``SEGMENT`` bytes. Each segment is one row of the
index and holds, per distinct term, the sorted positions at which it stands in the segment's texts.
A segment is written by the task that read its texts, so building the index shuffles nothing, a
lost executor costs its segments only, and a common term is spread over all segments. Positions
run through a segment; a text owns a range of them, so offset-adjusted lists of different texts
never meet.

A search first sums the frequency of the test terms over all segments. Each test window then
starts from its rarest term in every segment: a segment without that term is done, in the others
the lists of the next rarer terms, moved by their offsets, are intersected one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm import tokens
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Words in a row that make a window.
WINDOW = 10
#: Bytes of text in a segment of the index.
SEGMENT = 1 << 20
#: Test words that one search carries to every task; more are searched in blocks of items.
BLOCK_WORDS = 2_000_000
#: A proximity match has all words of a window within so many words of its rarest.
NEAR = 15

_INDEX = "segment string, doc_ids array<bigint>, ends array<int>, terms array<bigint>, starts array<int>, positions array<int>"
_MATCH = "segment string, row int, doc_id bigint, item_id string, kind string, hits array<int>"


def build_index(docs: DataFrame) -> DataFrame:
    """One row per segment, of (doc_id, text).

    Row i of a segment owns the positions from ``ends[i - 1]`` to ``ends[i]``; the k-th term stands
    at ``positions[starts[k]:starts[k + 1]]``. Null texts have no positions. Repeated rows and
    ids stay apart, as do rows without an id; other columns are not read.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        count = 0
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for low, high in tokens.slices(text, SEGMENT, SEGMENT):
                found = tokens.words(text.slice(low, high - low), tokens.ALNUM)
                order = np.argsort(found.hashes, kind="stable")
                terms, starts = np.unique(found.hashes[order], return_index=True)
                yield pa.record_batch(
                    [
                        pa.array([f"{part}-{count}"]),
                        pa.array([ids.slice(low, high - low)], pa.list_(pa.int64())),
                        _one(found.bounds[1:], pa.int32()),
                        _one(terms.view(np.int64), pa.int64()),
                        _one(np.append(starts, len(order)), pa.int32()),
                        _one(order, pa.int32()),
                    ],
                    names=["segment", "doc_ids", "ends", "terms", "starts", "positions"],
                )
                count += 1

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        segments, _INDEX
    )


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return tokens.nested(values, np.array([0, len(values)]), kind)


@dataclass
class Windows:
    """Test windows: window i is of item ``items[i]`` and has the words ``words[first[i]:first[i] + size[i]]``.

    ``ranks``: the place of each word in the alphabetic order of the words, for ties.
    """

    words: np.ndarray
    ranks: np.ndarray
    first: np.ndarray
    size: np.ndarray
    items: list[str]

    def terms(self) -> np.ndarray:
        return np.unique(self.words)


def item_blocks(benchmark: DataFrame, window: int, most: int = BLOCK_WORDS) -> Iterator[Windows]:
    """The windows of all items in blocks of at most about ``most`` words each.

    Items without an id or without words have no window; texts that share an id are one item.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // (2 * most)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.toPandas()
        found = tokens.words(pa.array(rows["text"], pa.string()), tokens.ALNUM)
        first, length, owner = [], [], []
        for i, item in enumerate(rows["item_id"]):
            low, high = found.bounds[i], found.bounds[i + 1]
            if high > low:
                begins = range(low, max(low, high - window) + 1)
                first += begins
                length += [min(window, high - low)] * len(begins)
                owner += [item] * len(begins)
        spelled = [w for text in rows["text"] for w in tokens.spelled(text, tokens.ALNUM)]
        _, ranks = np.unique(np.array(spelled, dtype=object), return_inverse=True)
        yield Windows(found.hashes, ranks, np.array(first, np.int64), np.array(length, np.int64), owner)


def term_counts(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """Occurrences of each given term in the whole index; read from term and start columns only.

    The answer has a row per given term at most.
    """
    wanted = np.sort(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                have = batch.column(0)[k].values.to_numpy().view(np.uint64)
                starts = batch.column(1)[k].values.to_numpy()
                at = _find(have, wanted)
                ok = at >= 0
                sums[ok] += starts[at[ok] + 1] - starts[at[ok]]
        seen = np.flatnonzero(sums)
        yield pa.record_batch(
            [pa.array(wanted[seen].view(np.int64)), pa.array(sums[seen])], names=["term", "n"]
        )

    sums = index.select("terms", "starts").mapInArrow(count, "term bigint, n bigint")
    rows = sums.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    keys = rows["term"].to_numpy(np.int64).view(np.uint64)
    return dict(zip(keys.tolist(), rows["n"].tolist(), strict=True))


def _find(have: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted term among the sorted ones, -1 where it is missing."""
    if not len(have):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
    return np.where(have[at] == wanted, at, -1)


def _near(lists: list[np.ndarray], span: int) -> np.ndarray:
    """Positions of the first list that have a member of every other list within ``span``."""
    kept = lists[0]
    for other in lists[1:]:
        if not len(kept):
            break
        kept = kept[np.searchsorted(other, kept + span, "right") > np.searchsorted(other, kept - span)]
    return kept


def search(index: DataFrame, tests: Windows, near: int | None = NEAR) -> DataFrame:
    """Matches of the windows, one row per indexed text, item and kind.

    ``phrase``: ``hits`` are all words of the text (counted from 0) inside an occurrence of a window
    of the item. ``near``: ``hits`` are the places of a window's rarest word (ties: the first in the alphabet)
    that have every other word of the window within ``near`` words; phrases count here as well.
    """
    counts = term_counts(index, tests.terms())
    frequency = np.array([counts.get(int(w), 0) for w in tests.words], np.int64)
    orders = [
        f + np.lexsort((tests.ranks[f : f + n], frequency[f : f + n]))
        for f, n in zip(tests.first, tests.size, strict=True)
    ]
    anchors = tests.words[[o[0] for o in orders]] if orders else np.zeros(0, np.uint64)
    # Windows whose rarest term no text has can't match.
    alive = [i for i, o in enumerate(orders) if frequency[o[0]] > 0]
    plan = tests.words, tests.first, tests.size, tests.items
    by_anchor: dict[int, list[int]] = {}
    for i in alive:
        by_anchor.setdefault(int(anchors[i]), []).append(i)
    starting = np.array(sorted(by_anchor), np.uint64)
    sent = index.sparkSession.sparkContext.broadcast((plan, orders, by_anchor, starting))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, first, size, items), orders, by_anchor, starting = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                segment = batch.column(0)[k].as_py()
                ids = batch.column(1)[k].values
                ends = batch.column(2)[k].values.to_numpy().astype(np.int64)
                terms = batch.column(3)[k].values.to_numpy().view(np.uint64)
                starts = batch.column(4)[k].values.to_numpy()
                places = batch.column(5)[k].values.to_numpy()
                begins = np.concatenate([[0], ends[:-1]])

                def positions(term: np.uint64) -> np.ndarray:
                    at = int(_find(terms, np.array([term], np.uint64))[0])  # noqa: B023
                    return places[starts[at] : starts[at + 1]].astype(np.int64) if at >= 0 else places[:0].astype(np.int64)  # noqa: B023

                hits: dict[tuple[int, str, str], list[np.ndarray]] = {}
                here = starting[_find(terms, starting) >= 0]
                cache: dict[int, np.ndarray] = {}
                for anchor in here:
                    for i in by_anchor[int(anchor)]:
                        lists = []
                        for o in orders[i]:
                            key = int(words[o])
                            if key not in cache:
                                cache[key] = positions(words[o])
                            lists.append(cache[key])
                            if not len(lists[-1]):
                                break
                        if not len(lists[-1]):
                            continue
                        at = lists[0] - (orders[i][0] - first[i])
                        for o, other in zip(orders[i][1:], lists[1:], strict=True):
                            if not len(at):
                                break
                            want = at + (o - first[i])
                            slot = np.minimum(np.searchsorted(other, want), len(other) - 1)
                            at = at[other[slot] == want]
                        row = np.searchsorted(ends, at, "right")
                        inside = (row < len(ends)) & (at >= 0)
                        at, row = at[inside], row[inside]
                        whole = at + size[i] <= ends[row]
                        for a, r in zip(at[whole], row[whole], strict=True):
                            span = np.arange(a, a + size[i]) - begins[r]
                            hits.setdefault((int(r), items[i], "phrase"), []).append(span)
                        if near is not None:
                            _nearby(hits, lists, ends, begins, items[i], near)
                if hits:
                    keys = list(hits)
                    yield pa.record_batch(
                        [
                            pa.array([segment] * len(keys)),
                            pa.array([r for r, _, _ in keys], pa.int32()),
                            ids.take(pa.array([r for r, _, _ in keys])),
                            pa.array([item for _, item, _ in keys], pa.string()),
                            pa.array([kind for _, _, kind in keys], pa.string()),
                            pa.array([np.unique(np.concatenate(hits[x])) for x in keys], pa.list_(pa.int32())),
                        ],
                        names=["segment", "row", "doc_id", "item_id", "kind", "hits"],
                    )

    return index.mapInArrow(match, _MATCH)


def _nearby(hits, lists, ends, begins, item, near) -> None:
    # Texts lie next to each other, so each one's positions are compared on their own.
    row = np.searchsorted(ends, lists[0], "right")
    close = _near(lists, near)
    if not len(close):
        return
    for r in np.unique(row[np.isin(lists[0], close)]):
        own = [x[np.searchsorted(x, begins[r]) : np.searchsorted(x, ends[r])] for x in lists]
        if all(len(x) for x in own) and len(kept := _near(own, near)):
            hits.setdefault((int(r), item, "near"), []).append(kept - begins[r])


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int | None = NEAR
) -> tuple[DataFrame, DataFrame]:
    """The stored index of ``docs`` and all matches with the items of ``benchmark``.

    An empty benchmark gives no matches, empty documents an empty index.
    """
    index = stored(build_index(docs), "postings")
    found = None
    for tests in item_blocks(benchmark, window):
        part = search(index, tests, near)
        found = part if found is None else found.unionByName(part)
    return index, found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int | None = NEAR) -> DataFrame:
    """One row per row of ``docs``: words, words hit, and which items have windows in it.

    ``n_near_items`` counts the items with a proximity match. Null and empty texts have no words and
    are clean; rows with equal ids stay apart.
    """
    index, found = find_matches(docs, benchmark, window, near)
    phrase = F.col("kind") == "phrase"
    per_doc = found.groupBy("segment", "row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(phrase, F.col("hits")))))).alias("n_hit"),
        F.array_sort(F.collect_set(F.when(phrase, F.col("item_id")))).alias("items"),
        F.size(F.collect_set(F.when(F.col("kind") == "near", F.col("item_id")))).alias("n_near"),
    )
    rows = index.select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", F.col("ends").alias("end"))).alias("row", "doc"), "ends"
    ).select(
        "segment",
        "row",
        F.col("doc.doc_ids").alias("doc_id"),
        (
            F.col("doc.end") - F.when(F.col("row") == 0, 0).otherwise(F.element_at("ends", F.greatest("row", F.lit(1))))
        ).alias("n_words"),
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.join(per_doc, ["segment", "row"], "left").select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near_items"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of the benchmark.

    Rows are told apart by a 64-bit hash of their text, so a clean text stays though its id is that of
    a contaminated one, and rows without an id are judged like all others. Null and empty texts
    and texts without words stay; very long ones are searched whole. With an empty benchmark all rows stay.
    """
    own = F.xxhash64(F.col("text").cast("string"))
    _, found = find_matches(docs.select(own.alias("doc_id"), "text"), benchmark, window, near=None)
    gone = found.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.xxhash64(docs["text"].cast("string")) == gone["_gone"], "left_anti")


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, i, i + least(len(w), {WINDOW}) - 1), ' ') AS p
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, n FROM grams JOIN windows USING (n, p)),
hits AS (SELECT doc_id, count(DISTINCT h) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS h FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d),
terms AS (
  SELECT DISTINCT item_id, start, unnest(list_slice(w, start, start + {WINDOW} - 1)) AS word
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS start FROM b WHERE len(w) > 0)),
counted AS (SELECT word, count(*) AS n FROM places WHERE word IN (SELECT word FROM terms) GROUP BY word),
ranked AS (
  SELECT item_id, start, word, count(*) OVER (PARTITION BY item_id, start) AS size,
    row_number() OVER (PARTITION BY item_id, start ORDER BY coalesce(n, 0), encode(word)) AS place
  FROM terms LEFT JOIN counted USING (word)),
rarest AS (SELECT item_id, start, size, doc_id, spot FROM ranked JOIN places USING (word) WHERE place = 1),
near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM (
    SELECT doc_id, item_id
    FROM rarest JOIN ranked USING (item_id, start) JOIN places USING (doc_id, word)
    WHERE places.spot BETWEEN rarest.spot - {NEAR} AND rarest.spot + {NEAR}
    GROUP BY doc_id, item_id, start, rarest.spot HAVING count(DISTINCT word) = any_value(rarest.size))
  GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_near_items, 0)::BIGINT AS n_near_items, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""


@query("op2_positional_index", SQL)
def op2_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every benchmark item, by ten-word windows."""
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
