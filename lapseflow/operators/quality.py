"""Checks of the stored tables' constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapseflow import schemas


def constraint_report(domains: DataFrame, registrar_dim: DataFrame) -> DataFrame:
    """Rows breaking each rule of the domain table.

    One pass counts the column rules per registrar; the foreign key is then
    checked on those few sums instead of on the rows.
    """

    def too_long(column: str, limit: int):
        return F.count_if(F.length(column) > limit)

    rules = {
        "name_null": F.count_if(F.col("name").isNull()),
        "tld_null": F.count_if(F.col("tld").isNull()),
        "registrar_null": F.count_if(F.col("registrar_id").isNull()),
        "name_too_long": too_long("name", schemas.NAME_LIMIT),
        "tld_too_long": too_long("tld", schemas.TLD_LIMIT),
    }
    sums = domains.groupBy("registrar_id").agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in rules.items()]
    )
    known = registrar_dim.select(F.col("id").alias("registrar_id"), F.lit(True).alias("_known"))
    orphan = F.col("_known").isNull() & F.col("registrar_id").isNotNull()
    totals = sums.join(known, "registrar_id", "left").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rules],
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("registrar_orphan"),
    )
    return totals.unpivot([], [*rules, "registrar_orphan"], "rule", "violations")


def long_names(dim: DataFrame, limit: int = schemas.REGISTRAR_LIMIT) -> DataFrame:
    """Dimension members whose name does not fit its column."""
    return dim.where(F.length("name") > limit)
