"""Column expressions that read one landed lookup response.

NULL means "no usable answer": the domain then keeps its old values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the popularity service writes a rank.
RANK_PATTERN = r'RANK="(\d+)"'


def rank(body: Column) -> Column:
    """First rank in the body, 0 when it holds none; NULL without a body or with a rank beyond INT."""
    found = F.regexp_extract(body, RANK_PATTERN, 1)
    return F.when(found == "", F.lit(0)).otherwise(found.try_cast("int"))


def title_count(body: Column) -> Column:
    """Number of titles in the second element of an encyclopedia answer."""
    return F.json_array_length(F.get_json_object(body, "$[1]"))


def has_titles(body: Column) -> Column:
    return title_count(body) > 0


def capture_count(body: Column) -> Column:
    """Commas between the one-field rows; the header row cancels the fencepost."""
    return F.length(body) - F.length(F.replace(body, F.lit(","), F.lit("")))


# How a time ends that names its offset from UTC.
OFFSET_PATTERN = r"(?:[Zz]|[+-]\d\d(?::?\d\d)?)$"


def utc_time(text: Column) -> Column:
    """UTC wall clock of a time as text; one without an offset is UTC already."""
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    named = text.rlike(r"\d\d:\d\d.*" + OFFSET_PATTERN)
    return F.when(named, instant).otherwise(text.try_cast("timestamp_ntz"))


def _date(body: Column, key: str) -> Column:
    """A registry date is one text or a list of texts (then the first counts)."""
    first = F.get_json_object(body, f"$.{key}[0]")
    return utc_time(F.coalesce(first, F.get_json_object(body, f"$.{key}")))


def _is_empty_list(body: Column, key: str) -> Column:
    return F.coalesce(F.get_json_object(body, f"$.{key}") == "[]", F.lit(False))


def registry_dates(body: Column) -> Column:
    """``struct(registered, expired)``, or NULL when the record is not usable.

    No record, an empty record, malformed text and an empty date list give no
    update; a record whose dates are null does update, to NULL.
    """
    has_record = F.coalesce(F.size(F.json_object_keys(body)) > 0, F.lit(False))
    empty_list = _is_empty_list(body, "creation_date") | _is_empty_list(body, "expiration_date")
    return F.when(
        has_record & ~empty_list,
        F.struct(
            _date(body, "creation_date").alias("registered"),
            _date(body, "expiration_date").alias("expired"),
        ),
    )
