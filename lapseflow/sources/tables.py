"""Readers of staged batches, record sets, word lists, landed responses and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow import schemas


def staged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Staged five-column batch files, quoted as :func:`lapseflow.sinks.files.write_batches` quotes them."""
    return spark.read.schema(schemas.STAGED).csv(path, **schemas.STAGED_QUOTING)


def json_recordset(df: DataFrame, column: str, layout: str = schemas.RECORDSET) -> DataFrame:
    """Typed rows of a JSON array text: missing keys become NULL, unknown ones are ignored."""
    return df.select(F.inline(F.from_json(column, f"ARRAY<STRUCT<{layout}>>")))


def words(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary with one word per line."""
    return distinct_words(spark.read.text(path).select(F.trim("value").alias("word")))


def words_json(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary in one JSON array."""
    text = spark.read.text(path, wholetext=True)
    return distinct_words(text.select(F.explode(F.from_json("value", "ARRAY<STRING>")).alias("word")))


def distinct_words(df: DataFrame) -> DataFrame:
    return df.select("word").where("word <> ''").distinct()


def landed_responses(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Landed lookup responses; the source test reaches the Parquet scan."""
    rows = spark.read.schema(f"{schemas.RESPONSE}, seq BIGINT").parquet(path)
    return rows if source is None else rows.where(F.col("source") == source)


def database_table(spark: SparkSession, **options: str) -> DataFrame:
    """A table over JDBC; connection, table and partitioning come as options."""
    return spark.read.format("jdbc").options(**options).load()
