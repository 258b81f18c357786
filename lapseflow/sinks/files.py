"""File sinks: CSV exports, their manifest and staged batches."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow import schemas
from lapseflow.functions.text import html_link
from lapseflow.functions.values import staged_date_text

BATCH_ROWS = 100_000
_MONTH = re.compile(r"month=\d{4,}-\d\d")


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and real quoting, one file per task."""
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def export_manifest(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """Folder, link, modification date and size of every exported ``.csv`` below ``path``.

    Only file metadata is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.element_at(F.split("path", "/"), -2).alias("folder"),
        html_link(name, base_url).alias("file_name"),
        F.to_date("modificationTime").alias("date"),
        F.col("length").alias("size"),
    )


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Add a run's lines to the kept manifest; its readers see one header."""
    export_csv(manifest.drop("folder"), path, mode="append")


def write_batches(contract: DataFrame, path: str, rows: int = BATCH_ROWS) -> None:
    """Pending rows as staged batch files of at most ``rows`` rows."""
    contract.select(
        "name",
        "tld",
        "registrar",
        staged_date_text(F.col("expired")).alias("expired"),
        staged_date_text(F.col("registered")).alias("registered"),
    ).write.options(maxRecordsPerFile=rows, **schemas.STAGED_QUOTING).csv(path)


def write_archive(old: DataFrame, path: str) -> None:
    """Purged listings by month, gathered first so that a month gets few files.

    A rebalance, not a plain repartition: a month that holds most rows is split.
    """
    old.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(path)


def write_listings(rows: DataFrame, path: str, listed_at: str) -> None:
    """Append listings by the month of their time; those without one lie in a partition of their own."""
    write_archive(rows.withColumn("month", F.date_format(listed_at, "yyyy-MM")), path)


def read_listings(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Listings or archives by month; none if nothing was stored yet."""
    layout = f"{layout}, month STRING"
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def archive_months(spark: SparkSession, path: str, archive: str, before: str) -> int:
    """Move the files of all months before ``before`` (yyyy-MM) to the archive; how many files moved.

    No row is read or written, and listings without a time stay. Both folders lie in one store. A move that breaks off
    leaves every file in one of the two places, and the next one goes on.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(archive)
    files = source.getFileSystem(conf)
    moved = 0
    for folder in files.listStatus(source):
        name = folder.getPath().getName()
        if not _MONTH.fullmatch(name) or name >= f"month={before}":
            continue
        place = jvm.org.apache.hadoop.fs.Path(target, name)
        files.mkdirs(place)
        for file in files.listStatus(folder.getPath()):
            # Spark's file names are unique over all writes.
            if not files.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(place, file.getPath().getName())):
                raise OSError(f"can't move {file.getPath()} to {place}")
            moved += 1
        files.delete(folder.getPath(), False)
    return moved


def append_database(df: DataFrame, **options: str) -> None:
    """Append a feed to a table over JDBC; connection and batch size come as options."""
    df.write.format("jdbc").options(**options).mode("append").save()
