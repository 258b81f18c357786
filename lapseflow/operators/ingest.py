"""Insert-or-ignore of listing rows into the domain table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapseflow import schemas
from lapseflow.functions import names
from lapseflow.operators import dims
from lapseflow.operators.joins import is_small
from lapseflow.session import stored


# What a domain's id is computed from: joining on it equals joining on the id.
DOMAIN_KEY = ("name", "tld")


def first_wins(contract: DataFrame) -> DataFrame:
    """One row per name and tld: the one with the lowest ``seq``.

    A minimum over whole rows, so each map task already sends one row per
    domain it saw, however often that domain is listed.
    """
    payload = [c for c in contract.columns if c not in (*DOMAIN_KEY, "seq")]
    first = F.min(F.struct("seq", *payload)).alias("_first")
    return contract.groupBy(*DOMAIN_KEY).agg(first).select(*DOMAIN_KEY, "_first.*")


def with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", names.domain_uuid(F.col("name"), F.col("tld")))


def empty_domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.DOMAIN).limit(0)


def stamp_created(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns({"created_at": as_of, "updated_at": as_of})


def insert_new_domains(
    contract: DataFrame,
    target: DataFrame | Callable[[DataFrame], DataFrame],
    tld_dim: DataFrame,
    registrar_dim: DataFrame,
    as_of: Column,
) -> DataFrame:
    """The rows to append to ``target``: first of each new domain, in table layout.

    Duplicates go first, so the anti-join and both lookups see each domain once.
    Name and tld stand for the id they determine: the rows are partitioned by
    them already, and only rows that stay get an id computed. ``target`` may be a function from the first
    rows to the part of the table that can hold them, so that the rest isn't read.
    """
    firsts = stored(first_wins(contract), "firsts")
    fresh = not_stored(firsts, target if isinstance(target, DataFrame) else target(firsts))
    resolved = dims.resolve_ids(
        dims.resolve_ids(fresh, tld_dim, "tld", "tld_id"),
        registrar_dim,
        "registrar",
        "registrar_id",
    )
    return to_domain_layout(stamp_created(with_id(resolved), as_of))


def not_stored(firsts: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct domains that the target lacks.

    For a batch measured as small the target isn't moved: its key columns are
    scanned for the batch's keys, and the few hits leave the batch.
    """
    keys = list(DOMAIN_KEY)
    known = target.select(*keys)
    if not is_small(firsts.select(*keys)):
        return firsts.join(known, keys, "left_anti")
    hits = known.join(F.broadcast(firsts.select(*keys)), keys, "left_semi")
    return firsts.join(F.broadcast(hits), keys, "left_anti")


def to_domain_layout(df: DataFrame) -> DataFrame:
    """Domain-table columns in order and type; the ones ``df`` lacks become NULL."""
    known = df if "attempts" in df.columns else df.withColumn("attempts", F.lit(0))
    return in_layout(known, schemas.DOMAIN)


def ingest_delta(before: DataFrame, inserted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: table size before and after a load, rows added, rows still pending."""
    sides = [
        df.select(F.lit(side).alias("side")) for side, df in
        (("before", before), ("added", inserted), ("pending", rejected))
    ]
    both = sides[0].unionAll(sides[1]).unionAll(sides[2])

    def size(side: str) -> Column:
        return F.count_if(F.col("side") == side)

    return both.agg(
        size("before").alias("rows_before"),
        (size("before") + size("added")).alias("rows_after"),
        size("added").alias("rows_added"),
        size("pending").alias("rows_pending"),
    )


def added_count(df: DataFrame, on: str, name: str = "domain_name", day: str = "date_added") -> DataFrame:
    """Non-null names added on one day."""
    return added_on(df, on, day).agg(F.count(name).alias("added"))


def added_on(df: DataFrame, on: str, day: str = "date_added") -> DataFrame:
    """Rows added on one day, as a range over the stored time so the scan can skip."""
    start = F.lit(on).cast("timestamp_ntz")
    return df.where((F.col(day) >= start) & (F.col(day) < start + F.make_dt_interval(days=F.lit(1))))


def latest_by_domain(attributes: DataFrame) -> DataFrame:
    """One attribute row per name and tld: the one with the highest ``seq``."""
    payload = [c for c in attributes.columns if c not in (*DOMAIN_KEY, "seq")]
    latest = F.max(F.struct("seq", *payload)).alias("_latest")
    return attributes.groupBy(*DOMAIN_KEY).agg(latest).select(*DOMAIN_KEY, "_latest.*")


def upsert_meta(attributes: DataFrame, layout: str, existing: DataFrame | None = None) -> DataFrame:
    """A feed's attribute table: the highest ``seq`` of a domain wins over older rows, stored ones included.

    ``attributes`` bear name and tld. They are reduced by these, and ids are computed for
    the rows that stay. ``layout`` names the table's columns; ones that the feed lacks are NULL.
    """
    # Ids know no case.
    folded = attributes.drop("domain_id").withColumns({c: F.lower(c) for c in DOMAIN_KEY})
    latest = latest_by_domain(folded)
    keyed = latest.withColumn("domain_id", names.domain_uuid(F.col("name"), F.col("tld")))
    rows = in_layout(keyed, layout)
    if existing is None:
        return rows
    both = rows.unionByName(in_layout(existing, layout))
    payload = [c for c in both.columns if c not in ("domain_id", "seq")]
    newest = F.max(F.struct("seq", *payload)).alias("_latest")
    return both.groupBy("domain_id").agg(newest).select("domain_id", "_latest.*")


def in_layout(df: DataFrame, layout: str) -> DataFrame:
    """The columns of a layout in order and type; the ones ``df`` lacks become NULL."""
    fields = T.StructType.fromDDL(layout).fields
    return df.select(
        [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
