"""The flat feed, lifecycle splits and report pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapseflow.functions import names, scoring
from lapseflow.operators.joins import HOT_ROWS
from lapseflow.operators.labels import label_uniqueness, search_visibility

FRESH_DAYS = 90


def with_sale_stage(domains: DataFrame, as_of: Column) -> DataFrame:
    stage = scoring.sale_stage(F.col("expired"), F.col("registrar"), as_of)
    return domains.withColumn("sale_stage", stage)


def front_end_feed(
    domains: DataFrame, results: DataFrame, as_of: Column, min_rows: int = HOT_ROWS
) -> DataFrame:
    """One flat row per domain. ``category`` has no rule to compute it and stays NULL."""
    rows = search_visibility(label_uniqueness(domains, min_rows), results)
    return rows.select(
        names.qualified(F.col("name"), F.col("tld")).alias("domain"),
        scoring.availability_text(F.col("expired"), F.col("registrar")).alias("available"),
        "unique",
        scoring.accredited(F.col("has_wiki"), F.col("alexa_score")).alias("ace"),
        scoring.age_years(F.col("registered"), as_of).alias("age"),
        "search",
        "expired",
        "registered",
        F.lit(None).cast("string").alias("category"),
    )


def is_fresh(listed_at: Column, as_of: Column, days: int = FRESH_DAYS) -> Column:
    return listed_at >= as_of - F.make_dt_interval(days=F.lit(days))


def retention(
    listings: DataFrame, listed_at: str, as_of: Column, days: int = FRESH_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Fresh listings to keep, and older ones with the month their archive is filed under.

    Every row is on one side: a listing without a time stays, since its age isn't known.
    """
    fresh = F.coalesce(is_fresh(F.col(listed_at), as_of, days), F.lit(True))
    old = listings.where(~fresh).withColumn("month", month_of(F.col(listed_at)))
    return listings.where(fresh), old


def month_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def stored_retention(
    live: DataFrame, archive: DataFrame, listed_at: str, as_of: Column, days: int = FRESH_DAYS
) -> tuple[DataFrame, DataFrame]:
    """The same from listings stored by ``month``, of which whole months may have moved to an archive.

    Months before the border day's are old as a whole and later ones fresh as a whole, by their
    partition alone; only in the border month rows are looked at. Either side reads its own months.
    """
    border = month_of(as_of - F.make_dt_interval(days=F.lit(days)))
    month = F.col("month")
    fresh = is_fresh(F.col(listed_at), as_of, days)
    both = live.unionByName(archive)
    # First by partition alone, then the rows of the border month.
    keep = both.where(month.isNull() | (month >= border)).where(month.isNull() | (month > border) | fresh)
    return keep, both.where(month <= border).where((month < border) | ~fresh)
