"""Mixing sources to target weights by iterative proportional fitting.

The corpus is reduced to cells of equal source, language and topic with their token counts. Raking
scales the cells' masses to the targets of one dimension after another, until no share of any value moves
any more; a cell never gets more than ``1 / budget`` of its own tokens, so that the final mass times the
budget, over the tokens, is a probability. Documents are then kept by a uniform number made from their id.
Where that limit keeps targets out of reach, :func:`deviations` says which, and by how much.
All expressions are built-in ones.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm.bounds import small
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

DIMENSIONS = ("source", "lang", "topic")
#: Kinds of topics that :func:`topic` tells apart.
TOPICS = 6
#: Words of fewer letters say nothing about the topic.
TOPIC_WORD = 6
#: Targets are the shares of tokens to this power: 1 keeps the mix, 0 makes all equal.
TEMPERATURE = 0.5
#: The share of all tokens that the sample holds on average.
BUDGET = 0.5
#: Raking has settled when no marginal share moved by more than this part of all tokens in a sweep.
TOLERANCE = 1e-4
#: Sweeps after which raking that hasn't settled warns and ends.
MOST_SWEEPS = 100


_BLANKS = r"[ \t\n\x0B\f\r]+"


def _words(text: str) -> Column:
    """Lower-case words between white space; an empty one may stand at either end."""
    return F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), _BLANKS)


def n_tokens(words: Column) -> Column:
    """The number of words; none for null and blank texts."""
    return F.size(F.array_remove(words, "")).cast("bigint")


def first_letters(words: Column) -> Column:
    """What long words begin with, as one text."""
    long = F.filter(words, lambda w: F.length(w) >= TOPIC_WORD)
    return F.array_join(F.transform(long, lambda w: F.substring(w, 1, 1)), "")


def topic(first: Column) -> Column:
    """A topic for corpora without one: the commonest class of the first letters of long words.

    Stands in for the label of a topic model, which the operator takes as a column like
    any other. Ties go to the smallest class; texts without long words that begin with
    a letter have topic ``none``.
    """
    letters = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(ord("ß"), ord("ÿ") + 1))]

    def count(k: int) -> Column:
        own = "".join(c for c in letters if ord(c) % TOPICS == k)
        return F.length(first) - F.length(F.translate(first, own, ""))

    best = F.array_max(F.array(*[F.struct(count(k).alias("n"), F.lit(-k).alias("k")) for k in range(TOPICS)]))
    return F.when(best["n"] == 0, F.lit("none")).otherwise(F.concat(F.lit("topic"), (-best["k"]).cast("string")))


def _cell(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def targets(cells: DataFrame, dimension: str, temperature: float) -> DataFrame:
    """(dimension, target): tempered shares of the tokens, as parts of 1."""
    own = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("root"))
    total = own.agg(F.sum("root")).first()[0]
    return own.select(dimension, (F.col("root") / F.lit(total or 1.0)).alias("target"))


def _moved(now: DataFrame, dimensions: Sequence[str]) -> float:
    """The most that a marginal share differs between the masses ``mass`` and ``before``."""
    shares = now.groupingSets([[d] for d in dimensions], *dimensions).agg(
        (F.sum("mass") - F.sum("before")).alias("by")
    )
    return shares.agg(F.max(F.abs("by"))).first()[0]


def rake(
    cells: DataFrame,
    goals: dict[str, DataFrame],
    budget: float = BUDGET,
    tolerance: float = TOLERANCE,
    most: int = MOST_SWEEPS,
) -> DataFrame:
    """``cells`` with ``probability``, from their ``tokens`` and the target shares of each dimension.

    ``goals``: for each dimension a table (dimension, target); values without a target get
    nothing. A cell's mass is a part of 1 and at most ``1 / budget`` of its share of the tokens.
    Sweeps go on until no marginal share moves by more than ``tolerance``; if that takes more
    than ``most`` a warning says so. Cells without tokens have probability 1.
    """
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("probability", F.lit(1.0))
    share = F.col("tokens") / F.lit(float(total))
    now = cells.withColumn("mass", share)
    for dimension, goal in goals.items():
        now = now.join(goal.withColumnRenamed("target", f"target_{dimension}"), dimension, "left")
    now = stored(now.fillna(0.0, [f"target_{d}" for d in goals]), "cells")
    moved, sweeps = float("inf"), 0
    while moved > tolerance and sweeps < most:
        now = now.withColumn("before", F.col("mass"))
        for dimension in goals:
            sums = now.groupBy(dimension).agg(F.sum("mass").alias("sum"))
            scaled = F.col("mass") * F.col(f"target_{dimension}") / F.col("sum")
            now = now.join(sums, dimension).withColumn(
                "mass", F.least(F.when(F.col("sum") > 0, scaled).otherwise(0.0), share / F.lit(budget))
            ).drop("sum")
        # Each sweep is written, so plans stay short and a lost executor costs one sweep.
        now = stored(now, "cells")
        moved, sweeps = _moved(now, list(goals)), sweeps + 1
        now = now.drop("before")
    if moved > tolerance:
        warnings.warn(f"after {sweeps} sweeps a share still moved by {moved:.2g}", stacklevel=2)
    probability = F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.lit(budget) * F.col("mass") / share))
    return now.withColumn("probability", probability).drop("mass", *[f"target_{d}" for d in goals])


def deviations(raked: DataFrame, goals: dict[str, DataFrame], budget: float = BUDGET) -> DataFrame:
    """(dimension, value, target, reached) for every target: its share, and the expected one of the sample.

    Both are parts of ``budget`` times all tokens of ``raked``, cells with ``tokens`` and ``probability``.
    Values that no cell has reach 0, and so does everything where there are no tokens.
    """
    total = float(raked.agg(F.sum("tokens")).first()[0] or 0)
    found = None
    for dimension, goal in goals.items():
        kept = raked.groupBy(dimension).agg(F.sum(F.col("tokens") * F.col("probability")).alias("kept"))
        part = goal.join(kept, dimension, "left").select(
            F.lit(dimension).alias("dimension"),
            F.col(dimension).alias("value"),
            "target",
            (F.coalesce("kept", F.lit(0.0)) / F.lit(total * budget or 1.0)).alias("reached"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def uniform(column: str) -> Column:
    """A number in [0, 1) made from an id; the same for equal ids."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def probabilities(
    rows: DataFrame, dimensions: Sequence[str] = DIMENSIONS, budget: float = BUDGET, temperature: float = TEMPERATURE
) -> DataFrame:
    """One row per cell of ``rows`` (dimensions and ``n_tokens``) with its probability."""
    cells = stored(
        rows.groupBy(*[_cell(d).alias(d) for d in dimensions]).agg(F.sum("n_tokens").alias("tokens")), "cells"
    )
    goals = {d: targets(cells, d, temperature) for d in dimensions}
    return stored(rake(cells, goals, budget), "probabilities")


def annotated(docs: DataFrame) -> DataFrame:
    """``docs`` with ``topic`` and ``n_tokens``, in place of columns so named."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("topic", "n_tokens")]
    # Step by step, so that nothing is computed twice.
    words = docs.select(F.struct(*kept).alias("doc"), _words("text").alias("words"))
    first = words.select("doc", first_letters(F.col("words")).alias("first"), n_tokens(F.col("words")).alias("n_tokens"))
    return first.select("doc.*", topic(F.col("first")).alias("topic"), "n_tokens")


def sampled(rows: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE) -> DataFrame:
    """The sampled rows of annotated documents with ``probability``, in place of a column so named.

    Nulls in source or language are one value with the empty text. Rows with equal ids, and
    all rows without one, stay or go together; documents without tokens follow their cell.
    """
    rows = rows.drop("probability")
    cells = probabilities(rows.select(*DIMENSIONS, "n_tokens"), DIMENSIONS, budget, temperature)
    same = [_cell(f"d.{d}") == F.col(f"c.{d}") for d in DIMENSIONS]
    joined = rows.alias("d").join(small(cells).alias("c"), same)
    return joined.where(uniform("d.doc_id") < F.col("c.probability")).select("d.*", "c.probability")


def mixed(docs: DataFrame, budget: float = BUDGET, temperature: float = TEMPERATURE) -> DataFrame:
    """The sampled rows of ``docs`` with ``topic``, ``n_tokens`` and ``probability``; see :func:`sampled`."""
    return sampled(annotated(docs), budget, temperature)


def _sql_sweep(masses: str) -> str:
    """``masses`` after one sweep, with ``before``, in SQL."""
    scaled = f"(SELECT *, mass AS before FROM {masses})"
    for d in DIMENSIONS:
        own = f"sum(mass) OVER (PARTITION BY {d})"
        scaled = (
            f"(SELECT * EXCLUDE (mass), least(CASE WHEN {own} > 0 THEN mass * t_{d} / {own} ELSE 0.0 END, share / {BUDGET}) AS mass FROM {scaled})"
        )
    return scaled


#: How far a cell's marginal shares moved in a sweep.
_SQL_MOVED = "greatest(" + ", ".join(f"abs(sum(mass - before) OVER (PARTITION BY {d}))" for d in DIMENSIONS) + ")"
_SPLIT = rf"regexp_split_to_array(lower(coalesce(text, '')), '{_BLANKS}')"
_CLASS = (
    f"list_transform(list_filter(w, lambda x: len(x) >= {TOPIC_WORD} AND regexp_matches(x, '^[a-zß-ÿ]')), lambda x: unicode(x) % {TOPICS})"
)
_COUNTS = ", ".join(f"len(list_filter(classes, lambda c: c = {k}))" for k in range(TOPICS))
_TARGETS = ", ".join(
    f"t{d} AS (SELECT {d}, r / sum(r) OVER () AS t_{d} FROM (SELECT {d}, sqrt(sum(tokens)) AS r FROM cells GROUP BY {d}))" for d in DIMENSIONS
)
SQL = f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {_CLASS} AS classes,
    len(list_filter(w, lambda x: x <> ''))::BIGINT AS n_tokens FROM (SELECT *, {_SPLIT} AS w FROM documents)),
rows_ AS (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN len(classes) = 0 THEN 'none' ELSE 'topic' || (list_position(c, list_max(c)) - 1) END AS topic
  FROM (SELECT *, [{_COUNTS}] AS c FROM counted)),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
{_TARGETS},
m0 AS MATERIALIZED (
  SELECT *, tokens / total AS share, tokens / total AS mass
  FROM (SELECT *, sum(tokens) OVER () AS total FROM cells) JOIN tsource USING (source) JOIN tlang USING (lang) JOIN ttopic USING (topic)),
swept(sweep, moved, source, lang, topic, tokens, share, tsource, tlang, ttopic, mass) AS (
  SELECT 0, 1e300::DOUBLE, source, lang, topic, tokens, share::DOUBLE, t_source, t_lang, t_topic, mass::DOUBLE FROM m0
  UNION ALL
  SELECT sweep + 1, max(moved) OVER (), source, lang, topic, tokens, share, t_source, t_lang, t_topic, mass
  FROM (SELECT * EXCLUDE (moved), {_SQL_MOVED} AS moved FROM {_sql_sweep(
      "(SELECT sweep, moved, source, lang, topic, tokens, share, tsource AS t_source, tlang AS t_lang, ttopic AS t_topic, mass FROM swept)"
  )}
    WHERE sweep < {MOST_SWEEPS} AND moved > {TOLERANCE})),
p AS (
  SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1.0 ELSE least(1.0, {BUDGET} * mass / share) END AS probability
  FROM swept WHERE sweep = (SELECT max(sweep) FROM swept))
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability
FROM rows_ JOIN p USING (source, lang, topic)
WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < probability
"""


@query("op9_mixing", SQL)
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A sample of all documents, raked to tempered shares of sources, languages and topics."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    # Texts are read once; the sample itself needs none.
    rows = stored(annotated(docs).drop("text"), "annotated")
    return sampled(rows).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability")
    )
