"""Column expressions for fuzzy search and report links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(text: Column) -> Column:
    """Distinct letter triples of the text padded by two blanks before, one after."""
    padded = F.concat(F.lit("  "), F.lower(text), F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(padded) - 2)
    return F.array_distinct(F.transform(starts, lambda at: F.substr(padded, at, F.lit(3))))


def overlap(left: Column, right: Column) -> Column:
    """Shared share of two distinct-element arrays (Jaccard)."""
    shared = F.size(F.array_intersect(left, right))
    return shared / (F.size(left) + F.size(right) - shared)


def html_link(target: Column, base_url: str) -> Column:
    return F.format_string('<a href="%s%s">%s</a>', F.lit(base_url), target, target)
