"""Stored dimensions whose members are numbered safely by any number of writers.

A version adds members. A writer numbers on from the versions it has read, writes its members to a folder
of their own, and then claims the next version: a small file that names the folder is moved to the
version's number, which fails if another writer was there first. Whoever comes second reads the new version and
numbers again, so no id is given twice and no member is added twice. Now and then a version holds all
members, so that a reader opens a bounded number of folders.

The move is one step on file systems that rename a file only where none is, as HDFS does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

from lapseflow import schemas
from lapseflow.operators import dims
from lapseflow.session import delete_older, file_system

# After so many versions one holds all members.
WHOLE = 32
_WHOLE, _ADDED = "whole", "added"


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, kind, folder) of the versions that make up the dimension now, newest first."""
    files, root = file_system(spark, f"{path}-versions")
    if not files.exists(root):
        return []
    named = [status.getPath() for status in files.listStatus(root) if status.getPath().getName().isdigit()]
    found = []
    for place in sorted(named, key=lambda p: int(p.getName()), reverse=True):
        with_text = files.open(place)
        kind, folder = with_text.readLine().split()
        with_text.close()
        found.append((int(place.getName()), kind, folder))
        if kind == _WHOLE:
            break
    return found


def _claim(spark: SparkSession, path: str, number: int, kind: str, folder: str) -> bool:
    """Make a folder the version ``number``; False if another writer has that number."""
    files, draft = file_system(spark, f"{path}-versions/draft-{folder}")
    out = files.create(draft, False)
    out.writeBytes(f"{kind} {folder}\n")
    out.close()
    _, target = file_system(spark, f"{path}-versions/{number}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Py4JJavaError as error:
        if not files.exists(target):
            raise
        files.delete(draft, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _members(spark: SparkSession, path: str, now: list[tuple[int, str, str]]) -> DataFrame:
    if not now:
        return dims.empty_dimension(spark)
    return spark.read.schema(schemas.DIMENSION).parquet(*[f"{path}/{folder}" for _, _, folder in now])


def read(spark: SparkSession, path: str) -> DataFrame:
    """All members: id, name, created_at, updated_at."""
    return _members(spark, path, versions(spark, path))


def grow(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    column: str,
    as_of: Column,
    whole: int = WHOLE,
    before_claim: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Add the members that the dimension lacks, and read it back; a load without new ones makes no version.

    ``before_claim`` is called when members are written but not yet claimed, for tests of what happens then.
    """
    while True:
        now = versions(spark, path)
        known = _members(spark, path, now)
        added = dims.added_members(known, staged, column, as_of)
        folder, written = uuid.uuid4().hex, f"{path}/"
        added.write.parquet(written + folder)
        fresh = spark.read.schema(schemas.DIMENSION).parquet(written + folder)
        if fresh.isEmpty():
            return known
        kind = _WHOLE if len(now) >= whole else _ADDED
        if kind == _WHOLE:
            merged = uuid.uuid4().hex
            known.unionByName(fresh).hint("rebalance").write.parquet(written + merged)
            folder = merged
        before_claim()
        if _claim(spark, path, now[0][0] + 1 if now else 1, kind, folder):
            return read(spark, path)


def drop_unread(spark: SparkSession, path: str, before: datetime) -> int:
    """Delete what the dimension's newest versions don't need and nobody has written to since ``before``; how many went.

    These are members that a version with all of them repeats, members whose writer lost its version to another
    and numbered again, and the entries of versions that no reader opens. Choose ``before`` so that no read
    or load that began earlier is still running: a late load could claim a number that was freed.
    """
    now = versions(spark, path)
    if not now:
        return 0
    read_now, oldest = {folder for _, _, folder in now}, now[-1][0]

    def unread(entry: str) -> bool:
        return int(entry) < oldest if entry.isdigit() else entry.startswith("draft-")

    return delete_older(spark, path, before, lambda name: name not in read_now) + delete_older(
        spark, f"{path}-versions", before, unread
    )
