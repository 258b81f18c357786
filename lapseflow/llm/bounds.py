"""Broadcasts behind a count of rows or bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A written table of at most so many rows, each of a few numbers or short texts, may be broadcast.
BROADCAST_ROWS = 1_000_000
#: A written table of rows of any width may be broadcast up to so many bytes.
BROADCAST_BYTES = 48 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if it is within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def n_bytes(df: DataFrame) -> int:
    """The bytes of all values: eight for a number or an element of an array, a text's own."""
    total = F.lit(0).cast("bigint")
    for c in df.schema.fields:
        own = F.col(f"`{c.name}`")
        if isinstance(c.dataType, T.ArrayType):
            width = 8 + 8 * F.size(own)
        else:
            width = F.octet_length(own) if isinstance(c.dataType, T.StringType | T.BinaryType) else F.lit(8)
        total = total + F.coalesce(width, F.lit(8))
    return df.agg(F.sum(total)).first()[0] or 0


def light(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, a written table, marked for broadcast if its bytes are within the bound."""
    return F.broadcast(df) if n_bytes(df) <= (BROADCAST_BYTES if most is None else most) else df
