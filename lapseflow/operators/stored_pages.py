"""Pages over a stored order: a sorted copy cut into ranges, with a count of rows for each.

A page reads the one or two ranges that it lies in, however deep it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow.operators.search import checked

# Ranges of a small table; a large one takes as many as give some 100,000 rows each.
RANGES = 64
_COUNTS = "range INT, before BIGINT, n BIGINT"


def store_order(df: DataFrame, path: str, key: str = "domain_name", ranges: int = RANGES) -> None:
    """Write the rows that have a key in its order. Rows of one key keep one order among them.

    They are told apart by a number, so that a key that many rows bear fills several ranges.
    """
    spark = df.sparkSession
    numbered = df.where(F.col(key).isNotNull()).withColumn("tie", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(ranges, key, "tie").sortWithinPartitions(key, "tie")
    dealt.withColumn("range", F.spark_partition_id()).write.partitionBy("range").parquet(f"{path}/rows")
    counts = spark.read.parquet(f"{path}/rows").groupBy(F.col("range").cast("int").alias("range")).agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are ranges.
    before = F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    counts.select("range", F.coalesce(before, F.lit(0)).alias("before"), "n").coalesce(1).write.parquet(f"{path}/counts")


def stored_page(spark: SparkSession, path: str, limit: int, number: int = 1, key: str = "domain_name") -> DataFrame:
    """The n-th page in key order; empty past the end."""
    checked(limit, number)
    skip = (number - 1) * limit
    counts = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    # At most as many ranges as a page has rows.
    hit = counts.where((F.col("before") < skip + limit) & (F.col("before") + F.col("n") > skip)).orderBy("range").collect()
    rows = spark.read.parquet(f"{path}/rows")
    own = rows.where(F.col("range").isin([r.range for r in hit])).orderBy(key, "tie")
    first = hit[0].before if hit else 0
    return own.offset(skip - first if hit else 0).limit(limit).drop("tie", "range")


def stored_page_numbers(spark: SparkSession, path: str, limit: int, number: int = 1) -> DataFrame:
    """One row: offset of this page, page count, next and previous page, from the counts alone."""
    checked(limit, number)
    total = F.coalesce(F.sum("n"), F.lit(0))
    pages = spark.read.schema(_COUNTS).parquet(f"{path}/counts").agg(F.ceil(total / limit).alias("pages"))
    return pages.select(
        F.lit((number - 1) * limit).cast("bigint").alias("current_offset"),
        "pages",
        F.when(F.col("pages") > number, F.lit(number + 1)).alias("next_page"),
        F.lit(number - 1 if number > 1 else None).cast("int").alias("prev_page"),
    )
