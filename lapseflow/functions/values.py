"""Column expressions that turn feed text into typed values; bad text gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAGED_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def money(text: Column) -> Column:
    return F.regexp_replace(text, "[$,]", "").try_cast("decimal(19,2)")


def true_flag(text: Column) -> Column:
    """Only the word ``True`` counts; anything else, NULL included, is false."""
    return F.coalesce(text == "True", F.lit(False))


def nullable_int(text: Column) -> Column:
    return text.try_cast("int")


def zulu_time(text: Column) -> Column:
    return F.replace(text, F.lit("Z"), F.lit("")).try_cast("timestamp_ntz")


def known_date(text: Column) -> Column:
    """Staged date text; the epoch is the feeds' placeholder for "not known"."""
    parsed = F.try_to_timestamp(text, F.lit(STAGED_TIME_FORMAT)).cast("timestamp_ntz")
    return F.nullif(parsed, _epoch())


def known_epoch(seconds: Column) -> Column:
    """Epoch seconds, where 0 means "not known"."""
    moment = _epoch() + F.make_dt_interval(secs=seconds)
    return F.when(seconds != 0, moment)


def staged_date_text(moment: Column) -> Column:
    """The inverse of :func:`known_date`: NULL becomes the epoch placeholder."""
    return F.date_format(F.coalesce(moment, _epoch()), STAGED_TIME_FORMAT)
