"""The queries of this subpackage and, where SQL can state them, their counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (session, folder of tables) under ``key``."""

    def add(run: Query) -> Query:
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return add


#: Rows of whole texts that a Python worker is handed at once at most.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; from here on the session hands Python workers bounded batches."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")
