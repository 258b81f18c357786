"""The polling loops as incremental jobs."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lapseflow import schemas
from lapseflow.operators import ingest, normalise
from lapseflow.operators.enrich import Enricher, latest_answers
from lapseflow.session import shared_folder, stored
from lapseflow.sinks import dim_table
from lapseflow.sinks import domain_table as table

FILES_PER_PASS = 5
_REPORT = "rows_read BIGINT, rows_rejected BIGINT, rows_inserted BIGINT"


def file_stream(
    spark: SparkSession,
    path: str,
    layout: str | StructType,
    kind: str = "parquet",
    files_per_pass: int = FILES_PER_PASS,
    **options: str,
) -> DataFrame:
    """New files below ``path``, a bounded number of them per pass."""
    reader = spark.readStream.schema(layout).format(kind).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_pass).load(path)


def _run_available(stream: DataFrame, name: str, step) -> StreamingQuery:
    folder = f"{shared_folder(stream.sparkSession)}/lapseflow/streams/{name}"
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )


def _seen(of: Observation) -> int:
    """The rows that were counted while they were written."""
    try:
        return int(of.get["n"])
    except Py4JJavaError:
        # Spark leaves the counting out of a plan that turns out to be empty.
        return 0


def create_tables(spark: SparkSession, root: str, buckets: int = table.BUCKETS) -> None:
    """An empty domain table below ``root``; its dimensions begin with their first members."""
    table.append_domains(ingest.empty_domains(spark), f"{root}/domain", buckets)


def stream_listing_ingest(
    listings: DataFrame, root: str, as_of: Column, name: str, domain: str = "domain_name", buckets: int = table.BUCKETS
) -> StreamingQuery:
    """Load every pending listing (``seq``, ``registrar`` and ``domain``) into the tables below ``root``.

    A batch is read once, reduced to a row per domain and stored. Listings that can't be split go
    to ``root``/rejects with a reason, and what the batch brought to ``root``/report; both are counted
    while they are written. A batch that runs again adds nothing: domains already stored are skipped,
    and its rejects and its report are replaced. Several streams may share the dimensions of a ``root``; one at a
    time may write its domains.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = f"run={name}-{number}"
        counts = [Observation() for _ in range(3)]

        def counted(df: DataFrame, of: Observation) -> DataFrame:
            return df.observe(of, F.count(F.lit(1)).alias("n"))

        listed = stored(counted(batch.select("seq", "registrar", domain), counts[0]), "listed")
        rejects = counted(normalise.reject_rows(listed, domain), counts[1])
        rejects.write.mode("overwrite").parquet(f"{root}/rejects/{run}")
        rows = stored(ingest.first_wins(normalise.to_contract(listed, domain)), "firsts")
        # A registrar may appear with losing listings only; these count as well.
        tlds = dim_table.grow(spark, f"{root}/tld", rows, "tld", as_of)
        registrars = dim_table.grow(spark, f"{root}/registrar", normalise.accepted(listed, domain), "registrar", as_of)
        path = f"{root}/domain"
        fresh = ingest.insert_new_domains(rows, lambda firsts: table.candidates(spark, path, firsts), tlds, registrars, as_of)
        table.append_domains(counted(fresh, counts[2]), path, buckets)
        line = spark.createDataFrame([tuple(_seen(c) for c in counts)], _REPORT)
        line.coalesce(1).write.mode("overwrite").parquet(f"{root}/report/{run}")

    return _run_available(listings, name, step)


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows read, rejected and inserted by each batch of the listing streams below ``root``."""
    return spark.read.schema(f"{_REPORT}, run STRING").parquet(f"{root}/report")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """What the listing streams below ``root`` couldn't load."""
    return spark.read.schema("seq BIGINT, registrar STRING, domain STRING, reason STRING, run STRING").parquet(f"{root}/rejects")


def stream_enrichment_apply(
    landed: DataFrame, enrichers: Sequence[Enricher], path: str, as_of: Column, name: str
) -> StreamingQuery:
    """Log landed responses of any kinds for the stored domain table as they arrive.

    One pass parses a batch for all kinds. The table itself is neither read nor written; a
    batch that runs again replaces its own part of the log.
    """

    def step(batch: DataFrame, number: int) -> None:
        table.append_changes(latest_answers(batch, enrichers), path, f"{name}-{number}", as_of)

    return _run_available(landed, name, step)
