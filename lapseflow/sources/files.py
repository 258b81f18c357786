"""Files that Spark lists, opened by path inside a task."""

from __future__ import annotations

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges that long files are cut into at most, as long as none gets longer than its reader bears.
RANGES = 1 << 8


def listed(spark: SparkSession, path: str | list[str], names: str | None = None) -> DataFrame:
    """(path, file_name, length) of the files below ``path``; nothing of their content is read.

    ``names`` is a glob that is tested while the files are listed.
    """
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", names) if names else reader).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def opened(path: str) -> pa.NativeFile:
    """The file for reading at any place, from the local disk or a store that Arrow knows (HDFS, S3, GCS)."""
    if path.startswith("file:") or "://" not in path:
        return LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, place = FileSystem.from_uri(path)
    return store.open_input_file(place)


def range_size(lengths: list[int], size: int, most: int) -> int:
    """Bytes of a range of files of these lengths: ``size``, but up to ``most`` where that would make over RANGES ranges.

    So their number, and with it what planning and starting their tasks takes, doesn't grow with the input before
    ranges are ``most`` bytes long.
    """
    return max(size, min(most, -(-sum(lengths) // RANGES)))
