"""Readers of the auction feeds. An archive takes one task, a long document or marketplace file several."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow import schemas
from lapseflow.functions.names import is_listing_file
from lapseflow.sources import csv_ranges, json_ranges, json_stream
from lapseflow.sources.files import listed, opened

# Listings that an archive's reader hands on at once.
BATCH = 5_000
# The archives among the files that ``is_listing_file`` names.
LISTING_ARCHIVES = "{all_listings.zip,all_listings[^_]*.zip}"


def auction_json(spark: SparkSession, path: str | list[str], size: int = json_ranges.RANGE) -> DataFrame:
    """One row per listing of the JSON envelopes ``{meta, data[]}`` below ``path``.

    Envelopes of over ``size`` bytes are read by a task for each such range, or longer ones where that would be very
    many (``files.range_size``); the others by one task each.
    A broken or cut-off one fails the read.
    """
    files = listed(spark, path)
    # As many names as there are ranges at most.
    long = [(r.path, r.length) for r in files.where(F.col("length") > size).orderBy("path").collect()]
    if not long:
        return envelopes(spark, path).select(F.inline("data"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                with opened(name) as file:
                    yield from _entries(file)

    short = files.where(F.col("length") <= size).select("path").mapInPandas(read, "entry STRING")
    return _parsed(json_ranges.long_documents(spark, long, size=size).unionByName(short))


def _entries(file: BinaryIO) -> Iterator[pd.DataFrame]:
    """The listings of one document, some at a time."""
    entries = json_stream.listings(io.TextIOWrapper(file, encoding="utf-8"))
    while part := list(itertools.islice(entries, BATCH)):
        yield pd.DataFrame({"entry": part})


def _parsed(entries: DataFrame) -> DataFrame:
    entry = F.from_json("entry", schemas.AUCTION_ENTRY, {"mode": "FAILFAST"})
    return entries.select(entry.alias("entry")).select("entry.*")


def envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per envelope. A broken or cut-off file fails the read instead of losing its listings."""
    return spark.read.schema(schemas.AUCTION_ENVELOPE).json(path, multiLine=True, mode="FAILFAST")


def envelope_meta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The ``meta`` part of each envelope, as text."""
    return envelopes(spark, path).select("meta")


def entries_of(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per listing of envelope documents held as text; a broken document fails the read."""
    parsed = F.from_json(column, schemas.AUCTION_ENVELOPE, {"mode": "FAILFAST"})
    return documents.select(F.inline(parsed["data"]))


def select_listing_files(files: DataFrame, file_name: str = "file_name") -> DataFrame:
    return files.where(is_listing_file(F.col(file_name)))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, length) of the listing archives below ``path``.

    The names are tested while the files are listed, so no other file is read.
    """
    return listed(spark, path, LISTING_ARCHIVES)


def unzipped_listings(files: DataFrame) -> DataFrame:
    """One row per listing of the one member of each archive, which bears its name less the last suffix.

    Archive and member are read as streams: a task holds the archive's list of members and BATCH listings,
    however long the archive is and the text that it unpacks to. An archive without that member, a broken one or a
    broken document fails the read.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name in zip(batch["path"], batch["file_name"], strict=True):
                with opened(path) as file, zipfile.ZipFile(file) as archive, archive.open(name.rsplit(".", 1)[0]) as member:
                    yield from _entries(member)

    return _parsed(files.select("path", "file_name").mapInPandas(members, "entry STRING"))


def zipped_auction_json(spark: SparkSession, path: str) -> DataFrame:
    return unzipped_listings(archives(spark, path))


def market_csv(spark: SparkSession, path: str | list[str], size: int = csv_ranges.RANGE) -> DataFrame:
    """The marketplace file: UTF-16, ``;`` between fields, a ``sep=;`` line, a header line.

    Quotes within quotes are doubled. A file of over ``size`` bytes is read by a task for each such range, or longer
    ones where that would be very many (``files.range_size``), unless it has quotes within plain fields; a shorter one or one with such quotes is read whole by one task.
    The two leading lines are dropped by content; rows without a name stay, for the rejects.
    """
    titles = [*schemas.MARKET_COLUMNS, *schemas.MARKET_EXTRA]
    layout = ", ".join(f"`{t}` STRING" for t in titles)
    files = listed(spark, path).where(~F.col("file_name").rlike("^[._]")).orderBy("path")
    # As many names as there are ranges at most.
    long = [(r.path, r.length) for r in files.where(F.col("length") > size).collect()]

    def whole(paths: str | list[str]) -> DataFrame:
        return spark.read.schema(layout).csv(paths, sep=";", encoding="UTF-16", multiLine=True, enforceSchema=True, escape='"')

    if not long:
        rows = whole(path)
    else:
        records, odd = csv_ranges.long_files(spark, long, size=size)
        rest = [*odd, *[r.path for r in files.where(F.col("length") <= size).select("path").collect()]]
        rows = csv_ranges.parsed(records, layout)
        rows = rows.unionByName(whole(rest)) if rest else rows
    first = F.col("`Domain Name`")
    return rows.where(~F.coalesce(first.isin("sep=", "Domain Name"), F.lit(False)))
