"""Joins to a table with one row per key, safe against hot keys on the fact side.

A lookup whose measured size is small is broadcast, so the facts never move.
Beyond that size both sides are shuffled, and the keys that hold far more than
a partition's fair share of the facts are spread over several sub-keys first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapseflow.session import stored

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 48 * 1024 * 1024

# Frequent-item sketch: entries kept, keys reported, groups the tasks are merged in.
SKETCH_ENTRIES = 4096
HOT_KEYS = 512
SKETCH_GROUPS = 256
# A key below this many rows is never worth splitting.
HOT_ROWS = 1_000_000
MAX_PARTS = 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against both bounds: each task sums up its own rows, and only sums move."""
    width = reduce(
        lambda total, name: total + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(8)),
        df.columns,
        F.lit(0),
    )
    seen = df.select(width.cast("long").alias("width"))
    rows, size = seen.agg(F.count("width"), F.coalesce(F.sum("width"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, on: Sequence[str], min_rows: int = HOT_ROWS) -> list[tuple[int, int]]:
    """``(key hash, parts)`` of the keys above a partition's fair share.

    One pass over the key columns: a frequent-item sketch per group of tasks,
    whose few top keys are then added up; at most HOT_KEYS pairs come back. It
    only decides how rows are laid out: a key it misses or adds changes no result.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.select(
        F.xxhash64(*on).alias("key"),
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part"),
    )
    sketched = hashed.groupBy("part").agg(
        F.expr(f"approx_top_k(key, {HOT_KEYS}, {SKETCH_ENTRIES})").alias("top"),
        F.count("key").alias("n"),
    )
    # The entry without a key carries the row count of its group.
    entries = sketched.selectExpr(
        "inline(concat(top, array(named_struct('item', CAST(NULL AS BIGINT), 'count', n))))"
    )
    counts = entries.groupBy("item").agg(F.sum("count").alias("n"))
    top = {r["item"]: r["n"] for r in counts.orderBy(F.desc("n")).limit(HOT_KEYS + 1).collect()}
    fair = max(top.pop(None, 0) / partitions, 1.0)
    return [
        (key, min(MAX_PARTS, int(count / fair) + 1))
        for key, count in top.items()
        if count >= min_rows and count > fair
    ]


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    spread_on: Sequence[str],
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join in which each hot key is split into sub-keys.

    ``lookup`` holds at most one row per key. ``spread_on`` names fact columns
    that tell the rows of one key apart. The sub-key is a hash of them and of the
    row's partition, so equal rows are spread as well, and a task that runs again
    puts every row in the same place: for that the facts are written first. Without a
    hot key nothing is written; what finding out reads is the key columns.
    """
    hot = hot_keys(facts, on, min_rows)
    if not hot:
        return facts.join(lookup, list(on), how)
    facts = stored(facts, "facts")
    spark = facts.sparkSession
    parts = F.broadcast(spark.createDataFrame(hot, "_key BIGINT, _parts INT"))

    def with_parts(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("_key", F.xxhash64(*on)).join(parts, "_key", "left")
        return keyed.withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop("_key")

    salted = with_parts(facts).withColumn(
        "_part", F.pmod(F.xxhash64(F.spark_partition_id(), *spread_on), F.col("_parts").cast("long"))
    )
    copies = with_parts(lookup).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts").cast("long") - 1))
    )
    joined = salted.drop("_parts").join(copies.drop("_parts"), [*on, "_part"], how)
    return joined.drop("_part")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    spread_on: Sequence[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join facts to a one-row-per-key lookup, broadcasting it only when measured small."""
    keys = [on] if isinstance(on, str) else list(on)
    if is_small(lookup, max_rows):
        return facts.join(F.broadcast(lookup), keys, how)
    return spread_join(facts, lookup, keys, how, spread_on or facts.columns, min_rows)
