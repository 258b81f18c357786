"""Bounded samples of labelled documents, and the hold-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapseflow.session import stored


def remainder(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for null."""
    return F.crc32(F.col(column).cast("string")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, kept: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents, written once.

    ``kept`` picks the rows that may be learnt from, by ``doc_id``. The labels with the smallest
    hashes of ids are taken, so that the choice has nothing to do with the rows' order. Several
    labels of an id count as their largest; labels that are neither 0 nor 1 and ids without a
    document don't count; of rows that share an id the one with the smallest hash of its text is taken.
    """
    ids = (
        labels.where(F.col(label).isin(0, 1) & kept)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    order = F.xxhash64("doc_id")
    chosen = stored(ids.orderBy(order, "doc_id").limit(most), "labels")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")
    # Numbers given while writing stay as they are, so that equal rows can be told apart.
    rows = stored(found.withColumns({"place": F.xxhash64("text"), "row": F.monotonically_increasing_id()}), "sample")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("place", "row")).alias("least")).select(F.col("least.row").alias("row"))
    return rows.join(F.broadcast(stored(one, "rows")), "row", "left_semi").select("doc_id", "text", "label")
