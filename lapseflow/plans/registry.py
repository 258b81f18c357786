"""The named queries and, where SQL can state them, their independent counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapseflow.plans.inputs import Inputs
from lapseflow.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable:
    """Register a function from :class:`Inputs` to a DataFrame under ``key``."""

    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(spark, folder))

        run.__name__ = key
        run.__doc__ = build.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return build

    return add
