"""The registrar and top-level-domain dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow import schemas
from lapseflow.operators.joins import lookup_join

# Hex digits of the name's digest that pick its numbering bucket (16^3 buckets).
BUCKET_DIGITS = 3


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.lower(column).alias("name")).where("name IS NOT NULL").distinct()


def new_members(staged: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """Distinct folded names that the dimension lacks. Reduced before the anti-join."""
    return distinct_keys(staged, column).join(dim.select("name"), "name", "left_anti")


def number_members(members: DataFrame) -> DataFrame:
    """Add ``position`` 1..n to distinct names, in order of their digest.

    A tail can be any text, so the members may be many: each digest bucket is
    numbered on its own and shifted by the size of the buckets before it. The
    only single-task step runs over the 4,096 bucket sizes at most.
    """
    digest = F.md5(F.encode("name", "UTF-8"))
    keyed = members.select("name", digest.alias("_digest")).withColumn(
        "_bucket", F.substring("_digest", 1, BUCKET_DIGITS)
    )
    sizes = keyed.groupBy("_bucket").agg(F.count("name").alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy("_digest", "name"))
    return keyed.join(F.broadcast(starts), "_bucket").select(
        "name", (F.col("_start") + rank).cast("int").alias("position")
    )


def empty_dimension(spark: SparkSession) -> DataFrame:
    # The limit lets the optimizer know there are no rows and drop joins with them.
    return spark.createDataFrame([], schemas.DIMENSION).limit(0)


def added_members(dim: DataFrame, staged: DataFrame, column: str, as_of: Column) -> DataFrame:
    """The members that the dimension lacks, numbered on from the highest id in use."""
    highest = dim.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return number_members(new_members(staged, column, dim)).select(
        (highest + F.col("position")).cast("int").alias("id"),
        "name",
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )


def grow_dimension(dim: DataFrame, staged: DataFrame, column: str, as_of: Column) -> DataFrame:
    """The dimension with its new members."""
    known = dim.select("id", "name", "created_at", "updated_at")
    return known.unionByName(added_members(dim, staged, column, as_of))


def resolve_ids(facts: DataFrame, dim: DataFrame, column: str, id_column: str) -> DataFrame:
    """Look up the id of ``column``'s name; NULL when the dimension lacks it."""
    lookup = dim.select(F.col("name").alias(column), F.col("id").alias(id_column))
    return lookup_join(facts, lookup, column)


def with_member_name(facts: DataFrame, dim: DataFrame, id_column: str, column: str) -> DataFrame:
    """Inner join from a fact's dimension id to the member's name."""
    lookup = dim.select(F.col("id").alias(id_column), F.col("name").alias(column))
    return lookup_join(facts, lookup, id_column, "inner")


def orphans(facts: DataFrame, dim: DataFrame, id_column: str) -> DataFrame:
    """Facts that point at no member of the dimension."""
    return lookup_join(facts, dim.select(F.col("id").alias(id_column)), id_column, "left_anti")
