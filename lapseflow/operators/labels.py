"""Dictionary membership, brandability, sibling TLDs and label uniqueness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapseflow.functions import names, scoring
from lapseflow.operators.joins import HOT_ROWS, lookup_join, spread_join

# The TLDs looked up beside a domain's own.
SIBLING_TLDS = ("site", "net", "org", "com", "gov", "io", "edu", "biz")
# The TLDs that make a label not unique.
COMMON_TLDS = ("org", "net", "com")


def lookup_words(df: DataFrame, words: DataFrame, label: str = "name") -> DataFrame:
    """Add ``is_word``: whether the label is in the dictionary."""
    entries = words.select(F.col("word").alias(label)).where(F.col(label).isNotNull()).distinct()
    flagged = lookup_join(df, entries.withColumn("_word", F.lit(True)), label)
    return flagged.withColumn("is_word", F.coalesce("_word", F.lit(False))).drop("_word")


def brandable(df: DataFrame, words: DataFrame, label: str = "name") -> DataFrame:
    flagged = lookup_words(df, words, label)
    return flagged.withColumn("brandable", scoring.brandable(F.col(label), F.col("is_word")))


def sibling_candidates(domains: DataFrame) -> DataFrame:
    """Each domain with every sibling TLD and its own, each once."""
    fixed = F.array(*[F.lit(t) for t in SIBLING_TLDS])
    candidates = F.array_union(fixed, F.array(F.lower("tld")))
    return domains.select("name", "tld", F.explode(candidates).alias("candidate_tld"))


def sibling_availability(
    domains: DataFrame, registry: DataFrame, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Per domain a 0/1 column for each sibling TLD, and its own registration date.

    The registry is reduced to one row of flags per label first, so nothing is
    multiplied by the number of siblings. A label may be shared by any number
    of domains (think of ``www``), hence the spread join.
    """
    flags = [
        F.max((F.col("tld") == t).cast("int")).alias(t) for t in SIBLING_TLDS
    ]
    by_label = registry.where(F.col("tld").isin(*SIBLING_TLDS)).groupBy("name").agg(*flags)
    own = registry.groupBy("name", "tld").agg(F.min("created").alias("creation_date"))
    flagged = spread_join(domains, by_label, ["name"], "left", ["tld"], min_rows)
    return flagged.join(own, ["name", "tld"], "left").withColumns(
        {t: F.coalesce(t, F.lit(0)) for t in SIBLING_TLDS}
    )


def label_uniqueness(domains: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``others`` (the label's other .org/.net/.com domains) and ``unique`` yes/no."""
    common = F.col("tld").isin(*COMMON_TLDS)
    taken = domains.where(common).groupBy("name").agg(F.count("tld").alias("_taken"))
    joined = spread_join(domains, taken, ["name"], "left", ["tld"], min_rows)
    others = F.coalesce("_taken", F.lit(0)) - common.cast("int")
    return (
        joined.withColumn("others", others.cast("bigint"))
        .withColumn("unique", F.when(F.col("others") > 0, "no").otherwise("yes"))
        .drop("_taken")
    )


def search_visibility(domains: DataFrame, results: DataFrame, within: int = 100) -> DataFrame:
    """Add ``search``: good when a domain shows up in the top results for its own name."""
    own: Column = F.col("host") == names.qualified(F.col("name"), F.col("tld"))
    seen = results.where((F.col("rank") <= within) & own).select("name", "tld").distinct()
    joined = domains.join(seen.withColumn("_seen", F.lit(True)), ["name", "tld"], "left")
    return joined.withColumn("search", F.when(F.col("_seen"), "good").otherwise("neutral")).drop(
        "_seen"
    )
