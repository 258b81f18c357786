"""Near-equal lines across documents, by a join of deletion neighbourhoods.

A line is a sequence of words and the edit bound is one word put in, left out or exchanged. Two
lines within it share a variant: the same words remain when the differing word is taken out. Every
distinct line emits its variants as hashed keys, equal keys meet in a grouped minimum, and what a key
proposes is verified on the words themselves. No pair of lines is formed but (line, earliest of a key).

All expressions are built-in ones. Three things keep the number of keys near the number of words
that can matter: equal lines are one line first; a line only emits variants when another one has the
same first or second half, since one edit leaves one half whole; and a key costs constant work,
because the hash of a sequence is the exclusive or of hashes of (word, place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm.bounds import light, small
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Lines of fewer words stay as they are.
MIN_WORDS = 3
#: Lines of fewer words are compared exactly only: one word of them is too much of them.
NEAR_WORDS = 8
#: What tells lines apart and orders them: document, hash of its text, number of the line.
PLACE = ("doc_id", "text_hash", "line_no")
_ID = ["doc_id", "text_hash"]


def _identified(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


#: Fixed value: the white space within a line.
_BLANKS = r"[ \t\x0B\f\r]+"


def _words(line: Column) -> Column:
    """Lower-case words between white space."""
    return F.array_remove(F.split(F.lower(line), _BLANKS), "")


def _line_hashes(words: Column, n: Column, near: int) -> list[Column]:
    """Two hashes that make out a line, and keys of the halves by which its neighbours are met.

    A line of n words has keys for neighbours of n or n + 1 words and, as the longer one, for those of
    n - 1. One edit leaves the first half of the shorter one's length whole, or all the rest.
    """
    half, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    first = F.xxhash64(F.slice(words, F.lit(1), half))
    second = F.xxhash64(F.slice(words, half + 1, n - half))
    # Of an odd number of words the first half stays the same without one word, of an even one the second.
    other = F.xxhash64(F.when(n % 2 == 0, F.slice(words, F.lit(1), less)).otherwise(F.slice(words, n - less + 1, less)))
    less_first = F.when(n % 2 == 0, other).otherwise(first)
    less_second = F.when(n % 2 == 0, second).otherwise(other)
    keys = [
        F.xxhash64(size, F.lit(which), value)
        for size, which, value in ((n, 1, first), (n, 2, second), (n - 1, 1, less_first), (n - 1, 2, less_second))
    ]
    return [
        F.xxhash64(n, first).alias("line_a"),
        F.xxhash64(n, second).alias("line_b"),
        *[F.when(n >= near, key).alias(f"key_{i}") for i, key in enumerate(keys)],
    ]


def distinct_lines(docs: DataFrame, least: int, near: int) -> tuple[DataFrame, DataFrame]:
    """All lines of ``least`` words or more (place, line_a, line_b), and one row per distinct line.

    A distinct line has its earliest place ``at``, its number of occurrences and, from ``near``
    words on, the keys of its halves.
    """
    lines = _identified(docs).select(*_ID, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # A generator of one row keeps the test of the size from cutting the line a second time.
    words = lines.select(*PLACE, F.explode(F.array(_words(F.col("line")))).alias("words"))
    words = words.where(F.size("words") >= least)
    rows = stored(words.select(*PLACE, *_line_hashes(F.col("words"), F.size("words"), near)), "lines")
    classes = rows.groupBy("line_a", "line_b").agg(
        F.min(F.struct(*PLACE)).alias("at"),
        F.count(F.lit(1)).alias("times"),
        # All lines of a class have the same keys.
        *[F.max(f"key_{i}").alias(f"key_{i}") for i in range(4)],
    )
    return rows.select(*PLACE, "line_a", "line_b"), stored(classes, "classes")


def _words_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(at, words) of the lines at given places; other documents and lines are not cut into words."""
    wanted = stored(places.groupBy(*_ID).agg(F.collect_set("line_no").alias("wanted")), "wanted")
    texts = _identified(docs).alias("t").join(light(wanted).alias("w"), _same("t", "w"))
    lines = texts.select("t.doc_id", "t.text_hash", "w.wanted", F.posexplode(F.split("t.text", "\n")).alias("line_no", "line"))
    return (
        lines.where(F.array_contains("wanted", F.col("line_no")))
        .select(F.struct(*PLACE).alias("at"), _words(F.col("line")).alias("words"))
        # Equal rows have equal places and one line is enough.
        .dropDuplicates(["at"])
    )


def _same(left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in _ID]


def _neighbourly(classes: DataFrame) -> DataFrame:
    """Places of the distinct lines that share a half with another one."""
    keys = classes.where(F.col("key_0").isNotNull()).select(
        "at", F.explode(F.array_distinct(F.array(*[f"key_{i}" for i in range(4)]))).alias("key")
    )
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "halves")
    return keys.join(small(shared), "key").select("at").distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """Keys of each line (at, words): one word exchanged, one left out, and the whole line.

    ``gone`` is the place of the word taken out, -1 for none.
    """
    n = F.size("words")
    word = (
        lines.select("at", n.alias("n"), F.posexplode("words").alias("i", "word"))
        .withColumn("here", F.xxhash64("word", "i"))
        # The same word one place further to the front, as after a removal before it.
        .withColumn("moved", F.xxhash64("word", F.col("i") - 1))
    )
    up_to = "(PARTITION BY at ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = "(PARTITION BY at ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    sums = word.select(
        "at",
        "n",
        "i",
        "here",
        F.expr(f"bit_xor(here) OVER {up_to}").alias("here_to"),
        F.expr(f"bit_xor(moved) OVER {up_to}").alias("moved_to"),
        F.expr(f"bit_xor(here) OVER {after}").alias("here_all"),
        F.expr(f"bit_xor(moved) OVER {after}").alias("moved_all"),
    )
    others = F.col("here_all").bitwiseXOR(F.col("here"))
    without = (
        F.col("here_to").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("moved_all")).bitwiseXOR(F.col("moved_to"))
    )

    def row(kind: str, gone: Column, *parts: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), gone.alias("gone"), F.xxhash64(*parts).alias("key"))

    exchanged = row("exchanged", F.col("i"), F.lit("exchanged"), F.col("n"), F.col("i"), others)
    left_out = row("left_out", F.col("i"), F.lit("length"), F.col("n") - 1, without)
    whole = row("whole", F.lit(-1), F.lit("length"), F.col("n"), F.col("here_all"))
    made = F.when(F.col("i") == 0, F.array(exchanged, left_out, whole)).otherwise(F.array(exchanged, left_out))
    return sums.select("at", F.explode(made).alias("v")).select("at", "v.kind", "v.gone", "v.key")


def _proposals(variants: DataFrame) -> DataFrame:
    """(at, gone, first, first_gone): for each key the earliest other line that could be within one edit.

    A line that lost a word meets whole lines, a whole line those that lost a word; two lines that
    lost different words are two edits apart.
    """
    order = F.struct("at", F.col("gone"))
    out = F.col("kind") == "left_out"
    met = stored(
        variants.groupBy("key")
        .agg(
            F.min(F.when(~out, order)).alias("whole"),
            F.min(F.when(out, order)).alias("less"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1"),
        "keys",
    )
    first = F.when(F.col("kind") == "whole", F.col("less")).otherwise(F.col("whole"))
    return (
        variants.join(met, "key")
        .select("at", "gone", first.alias("first"))
        .select("at", "gone", F.col("first.at").alias("first"), F.col("first.gone").alias("first_gone"))
        .where("first < at")
        .distinct()
    )


def _less(words: str, gone: str) -> Column:
    """The words without the one at ``gone``; all of them for -1."""
    at = F.col(gone)
    rest = F.concat(F.slice(words, F.lit(1), at), F.slice(words, at + 2, F.size(words)))
    return F.when(at < 0, F.col(words)).otherwise(rest)


def near_repeats(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Places ``at`` of the distinct lines that are one edit away from an earlier line."""
    lines = stored(_words_at(docs, _neighbourly(classes).select("at.*")), "neighbours")
    variants = stored(_variants(lines), "variants")
    proposals = stored(_proposals(variants), "proposals")
    early = lines.select(F.col("at").alias("first"), F.col("words").alias("first_words"))
    return (
        proposals.join(lines, "at")
        .join(early, "first")
        .where(_less("words", "gone") == _less("first_words", "first_gone"))
        .select("at")
        .distinct()
    )


def repeated_lines(docs: DataFrame, least: int = MIN_WORDS, near: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, text_hash, lines): the numbers of each document's lines that go.

    A line goes if an equal line, or from ``near`` words on one within an edit of one word, stands
    earlier: in a document with a smaller id, or higher in the same one. Case and the width
    of white space don't count.
    """
    rows, classes = distinct_lines(docs, least, near)
    close = stored(near_repeats(docs, classes).withColumn("close", F.lit(True)), "close")
    again = stored(
        classes.select("line_a", "line_b", "at", "times")
        .join(close, "at", "left")
        .where("times > 1 OR close")
        .select("line_a", "line_b", "at", F.coalesce("close", F.lit(False)).alias("close")),
        "again",
    )
    gone = rows.join(again, ["line_a", "line_b"]).where(F.col("close") | (F.struct(*PLACE) != F.col("at")))
    return gone.groupBy(*_ID).agg(F.collect_set("line_no").alias("gone"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, near: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with the text that remains, ``n_lines``, ``n_dropped`` and ``emptied``.

    ``emptied``: some lines went and none of ``least`` words is left. The columns of ``docs`` stay, but for
    earlier ones of those names. Null texts stay null and have no lines; blank and short lines
    stay. Rows without an id count as the earliest; rows that share id and text are one
    document and all keep the same lines.
    """
    docs = docs.drop("n_lines", "n_dropped", "emptied")
    gone = stored(repeated_lines(docs, least, near), "gone")
    text = F.col("d.text").cast("string")
    same = F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(text) == F.col("g.text_hash"))
    lines, some = F.split(text, "\n"), F.col("g.gone").isNotNull()
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col("g.gone"), i))
    rest = F.when(some, F.array_join(kept, "\n")).otherwise(F.col("d.text"))
    # Only texts that lost lines are looked at again.
    left = F.exists(kept, lambda line: F.size(_words(line)) >= least)
    return docs.alias("d").join(light(gone).alias("g"), same, "left").select(
        *[rest.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.when(some, F.size("g.gone")).otherwise(0).cast("bigint").alias("n_dropped"),
        F.when(some, ~left).otherwise(F.lit(False)).alias("emptied"),
    )


def without_repeated_lines(docs: DataFrame, least: int = MIN_WORDS, near: int = NEAR_WORDS) -> DataFrame:
    """``docs`` without repeated lines; a document whose lines of ``least`` words all went goes too."""
    return dedup_lines(docs, least, near).where("NOT emptied").select(*[f"`{c}`" for c in docs.columns])


_NORM = r"trim(regexp_replace(lower(line), '[\s]+', ' ', 'g'))"
SQL = rf"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, line_no, {_NORM} AS line FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM raw)),
long_lines AS (SELECT *, string_split(line, ' ') AS w FROM l WHERE len(string_split(line, ' ')) >= {MIN_WORDS}),
classes AS (SELECT line, any_value(w) AS w, min((doc_id, line_no)) AS spot FROM long_lines GROUP BY line),
big AS (SELECT spot, w, len(w) AS n FROM classes WHERE len(w) >= {NEAR_WORDS}),
v AS (
  SELECT spot, n, i, list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, n)) AS rest
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM big)),
close AS (
  SELECT DISTINCT spot FROM (
    SELECT b.spot FROM v AS b JOIN v AS a ON a.n = b.n AND a.i = b.i AND a.rest = b.rest WHERE a.spot < b.spot
    UNION ALL
    SELECT b.spot FROM v AS b JOIN big AS a ON a.n = b.n - 1 AND a.w = b.rest WHERE a.spot < b.spot
    UNION ALL
    SELECT b.spot FROM big AS b JOIN v AS a ON a.n = b.n + 1 AND a.rest = b.w WHERE a.spot < b.spot)),
gone AS (
  SELECT doc_id, line_no FROM long_lines JOIN classes USING (line)
  WHERE classes.spot <> (doc_id, line_no) OR classes.spot IN (SELECT spot FROM close)),
dropped AS (SELECT doc_id, list(line_no) AS g FROM gone GROUP BY doc_id),
longs AS (SELECT doc_id, count(*) AS n FROM long_lines GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN g IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda x, i: NOT list_contains(g, i - 1)), chr(10)) END AS text,
  coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_dropped, (g IS NOT NULL AND longs.n = len(g)) AS emptied
FROM raw LEFT JOIN dropped USING (doc_id) LEFT JOIN longs USING (doc_id)
"""


@query("op6_line_dedup", SQL)
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without lines that stand earlier, all but one word."""
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
