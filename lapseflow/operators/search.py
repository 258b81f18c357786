"""Term search and result pages."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow.functions.text import trigrams
from lapseflow.session import stored

SIMILAR = 0.3
PAGE_LIMIT = (1, 499)
# Rows a page may skip by sorting them; beyond, they are counted, with the same result.
SHALLOW = 50_000


def _grams_of(term: str) -> list[str]:
    padded = f"  {term.lower()} "
    return sorted({padded[i : i + 3] for i in range(len(padded) - 2)})


def term_search(
    names: DataFrame, terms: Sequence[str], top: int = 10, threshold: float = SIMILAR, label: str = "name"
) -> DataFrame:
    """Labels that look like each search term, best first.

    A term's triples that occur in the padded label are exactly those the two
    share, so plain text tests inside the label's own row count them. A label
    sharing less than ``threshold`` of the term's triples cannot reach it, and
    only the others get their own triples computed: names are read once and
    nothing but near matches is paired with a term or leaves its row.
    Ties in similarity go to the smaller edit distance, then to the label.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and be 1 at most")
    padded = F.concat(F.lit("  "), F.lower("name"), F.lit(" "))
    near = []
    for term in terms:
        grams = _grams_of(term)
        shared = reduce(add, (padded.contains(g).cast("int") for g in grams))
        hit = F.struct(
            F.lit(term.lower()).alias("term"),
            shared.alias("shared"),
            F.lit(len(grams)).alias("size"),
        )
        near.append(F.when(shared >= math.ceil(threshold * len(grams) - 1e-9), hit))
    labels = names.select(F.col(label).alias("name"))
    # Only near matches are gathered to drop repeated ones.
    pairs = labels.select("name", F.inline(F.array_compact(F.array(*near)))).distinct()
    union = F.size(trigrams(F.col("name"))) + F.col("size") - F.col("shared")
    hits = (
        pairs.select("name", "term", (F.col("shared") / union).alias("similarity"))
        .where(F.col("similarity") >= threshold)
        .withColumn("distance", F.levenshtein("term", F.lower("name")))
    )
    best = W.partitionBy("term").orderBy(F.desc("similarity"), "distance", "name")
    return hits.withColumn("position", F.row_number().over(best)).where(F.col("position") <= top)


def checked(limit: int, page: int = 1) -> None:
    low, high = PAGE_LIMIT
    if not low <= limit <= high or page < 1:
        raise ValueError(f"limit must be {low}-{high} and page at least 1")


def page(df: DataFrame, limit: int, number: int = 1, key: str = "domain_name") -> DataFrame:
    """The n-th page in key order; empty past the end. Rows without a key are on no page.

    Following pages one by one is cheaper with :func:`page_after`.
    """
    checked(limit, number)
    rows, skip = df.where(F.col(key).isNotNull()), (number - 1) * limit
    if skip <= SHALLOW:
        return rows.orderBy(key).offset(skip).limit(limit)
    rows = stored(rows, "page")
    start = _near_start(rows, skip, key)
    if start is None:
        return rows.limit(0)
    first, skip, equal = start
    if not equal:
        return rows.where(F.col(key) >= first).orderBy(key).offset(skip).limit(limit)
    # So many rows bear one key that the page starts among them: which of them is the same.
    head = rows.where(F.col(key) == first).limit(min(limit, equal - skip))
    return head.unionByName(rows.where(F.col(key) > first).orderBy(key).limit(limit)).orderBy(key).limit(limit)


def _near_start(df: DataFrame, skip: int, key: str) -> tuple[str, int, int] | None:
    """A text near the ``skip``-th key, the rows left to skip from there, and the rows of just that key if it's hot.

    A top-k keeps all skipped rows, so a deep page is approached by counting
    instead: one more character of the key per pass, until few rows are left.
    A pass returns one count per next character; None means past the last key.
    """
    prefix = start = ""
    while skip > SHALLOW:
        below = df.where(F.col(key).startswith(prefix))
        head = F.substring(key, 1, len(prefix) + 1).alias("head")
        counts = below.groupBy(head).count().orderBy("head").collect()
        passed = 0
        for row in counts:
            if passed + row["count"] > skip:
                break
            passed += row["count"]
        else:
            return None
        skip -= passed
        start = row["head"]
        if start == prefix:
            # The key itself, which has no further character.
            return start, skip, row["count"]
        prefix = start
    return start, skip, 0


def page_after(df: DataFrame, limit: int, last: str, key: str = "domain_name") -> DataFrame:
    """The page that follows the row ``last``: no rows are sorted only to be skipped."""
    checked(limit)
    return df.where(F.col(key) > last).orderBy(key).limit(limit)


def page_numbers(df: DataFrame, limit: int, number: int = 1) -> DataFrame:
    """One row: offset of this page, page count, next and previous page (NULL at the ends)."""
    checked(limit, number)
    pages = F.ceil(F.count(F.lit(1)) / limit)
    return df.agg(
        F.lit((number - 1) * limit).cast("bigint").alias("current_offset"),
        pages.alias("pages"),
    ).select(
        "*",
        F.when(F.col("pages") > number, F.lit(number + 1)).alias("next_page"),
        F.lit(number - 1 if number > 1 else None).cast("int").alias("prev_page"),
    )


def api_result(df: DataFrame, limit: int, number: int = 1, key: str = "domain_name") -> DataFrame:
    """One page as the response document: at most ``limit`` names are gathered."""
    names = page(df, limit, number, key).select(F.struct(F.col(key).alias("domain_name")).alias("row"))
    results = names.select(F.array_sort(F.collect_list("row"))).scalar()
    return page_numbers(df, limit, number).select(
        F.to_json(
            F.struct(results.alias("results"), "current_offset", "pages", "next_page", "prev_page")
        ).alias("body")
    )


def first_rows(df: DataFrame, size: int | None, order: str = "seq") -> DataFrame:
    """The first rows of a feed for a trial run or an export; all of them by default."""
    return df if size is None else df.orderBy(order).limit(size)
