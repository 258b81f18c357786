"""The incremental jobs run to the end over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapseflow.operators import ingest
from lapseflow.operators.enrich import ENRICHERS
from lapseflow.plans.ingest import KNOWN
from lapseflow.plans.inputs import ENRICHED, KNOWN_BEFORE, LOADED, Inputs, moment
from lapseflow.plans.registry import query
from lapseflow.plans.views import uuid_sql
from lapseflow.session import scratch_path
from lapseflow.sinks import dim_table, domain_table
from lapseflow.streaming import loops


def table_stream(x: Inputs, name: str) -> DataFrame:
    """One of the given tables as a file stream."""
    layout = x.table(name).schema
    return loops.file_stream(x.spark, x.folder, layout, pathGlobFilter=f"{name}.parquet")


def loaded_root(x: Inputs, rounds: int) -> str:
    """Load the listing stream ``rounds`` times over into fresh tables."""
    root = scratch_path(x.spark, "tables")
    loops.create_tables(x.spark, root)
    run = root.rsplit("/", 1)[-1]
    for number in range(rounds):
        listings = x.listings_of(table_stream(x, "orders"))
        loops.stream_listing_ingest(
            listings, root, moment(LOADED), f"{run}-{number}"
        ).awaitTermination()
    return root


_LOADED = f"""
    SELECT {uuid_sql("d.name || '.' || d.tld")} AS id, d.name, d.tld, t.id AS tld_id, r.id AS registrar_id,
           TIMESTAMP '{LOADED}' AS created_at
    FROM fx_domain d JOIN fx_tld t ON t.name = d.tld JOIN fx_registrar r ON r.name = d.registrar"""
_COLUMNS = ("id", "name", "tld", "tld_id", "registrar_id", "created_at")


@query("stream_listing_ingest", _LOADED)
def stream_listing_ingest(x: Inputs) -> DataFrame:
    root = loaded_root(x, rounds=1)
    return domain_table.read_domains(x.spark, f"{root}/domain").select(*_COLUMNS)


@query("insert_into_buckets", f"""
    SELECT {uuid_sql("d.name || '.' || d.tld")} AS id, d.name, d.tld, t.id AS tld_id,
           CASE WHEN (d.name, d.tld) IN (SELECT (name, tld) FROM ({KNOWN}) k) THEN TIMESTAMP '{KNOWN_BEFORE}'
                ELSE TIMESTAMP '{LOADED}' END AS created_at
    FROM fx_domain d JOIN fx_tld t ON t.name = d.tld""")
def insert_into_buckets(x: Inputs) -> DataFrame:
    """A load on top of a stored table, of which only the buckets that the load falls in are read."""
    path = scratch_path(x.spark, "domain")
    rows = x.staged().drop("price")
    known = rows.where(F.col("auction_end") < moment(KNOWN_BEFORE))
    for batch, at in ((known, KNOWN_BEFORE), (rows, LOADED)):
        fresh = ingest.insert_new_domains(
            batch.drop("auction_end"),
            lambda firsts: domain_table.candidates(x.spark, path, firsts),
            x.tld_dim(),
            x.registrar_dim(),
            moment(at),
        )
        domain_table.append_domains(fresh, path, buckets=32)
    return domain_table.read_domains(x.spark, path).select("id", "name", "tld", "tld_id", "created_at")


@query("stream_rejects", "SELECT seq, lower(registrar) AS registrar, domain_name AS domain, 'no_dot' AS reason FROM fx_listing WHERE domain_name NOT LIKE '%.%'")
def stream_rejects(x: Inputs) -> DataFrame:
    """The listings that a stream could not load."""
    return loops.read_rejects(x.spark, loaded_root(x, rounds=1)).drop("run")


@query("stream_report", f"""
    SELECT l.n AS rows_read, r.n AS rows_rejected, d.n AS rows_inserted
    FROM (SELECT count(*) AS n FROM fx_listing) l, (SELECT count(*) AS n FROM fx_listing WHERE domain_name NOT LIKE '%.%') r,
         (SELECT count(*) AS n FROM fx_domain) d
    UNION ALL
    SELECT l.n, r.n, CAST(0 AS BIGINT)
    FROM (SELECT count(*) AS n FROM fx_listing) l, (SELECT count(*) AS n FROM fx_listing WHERE domain_name NOT LIKE '%.%') r""")
def stream_report(x: Inputs) -> DataFrame:
    """What each of two loads of the same listings read, rejected and inserted."""
    return loops.read_report(x.spark, loaded_root(x, rounds=2)).drop("run")


@query("grow_dimension_versions", "SELECT name FROM (SELECT DISTINCT tld AS name FROM fx_norm) t")
def grow_dimension_versions(x: Inputs) -> DataFrame:
    """A dimension grown by loads that take turns while another one is under way; ids are 1 to n, each once."""
    path = scratch_path(x.spark, "dim")
    rows = x.staged().select("seq", "tld")
    thirds = [rows.where(F.col("seq") % 3 == k) for k in range(3)]
    between = iter([lambda: dim_table.grow(x.spark, path, thirds[1], "tld", moment(LOADED))])
    dim_table.grow(x.spark, path, thirds[0], "tld", moment(LOADED), before_claim=lambda: next(between, lambda: None)())
    grown = dim_table.grow(x.spark, path, thirds[2], "tld", moment(LOADED))
    ids = grown.agg(F.count("id").alias("n"), F.count_distinct("id").alias("ids"), F.max("id").alias("last"))
    sound = ids.where("n = ids AND n = last").select(F.lit(True).alias("sound"))
    return grown.join(F.broadcast(sound)).select("name")


@query("dedup_repeat_listing", _LOADED)
def dedup_repeat_listing(x: Inputs) -> DataFrame:
    """The same listings delivered again on a second day add nothing."""
    root = loaded_root(x, rounds=2)
    return domain_table.read_domains(x.spark, f"{root}/domain").select(*_COLUMNS)


@query("stream_enrichment_apply", f"""
    SELECT t.id, d.registered, d.expired,
           CASE WHEN d.id IS NULL THEN t.updated_at ELSE TIMESTAMP '{ENRICHED}' END AS updated_at,
           CAST(coalesce(f.n, 0) AS INTEGER) AS attempts
    FROM fx_table t LEFT JOIN fx_new_dates d ON d.id = t.id
    LEFT JOIN (SELECT id, count(*) AS n FROM fx_parsed WHERE NOT usable GROUP BY id) f ON f.id = t.id""")
def stream_enrichment_apply(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "domain")
    domain_table.append_domains(x.domain_table(), path)
    landed = x.responses_of(x.bodies_of(table_stream(x, "events"))).where(F.col("source") == "whois")
    loops.stream_enrichment_apply(
        landed, [ENRICHERS["whois"]], path, moment(ENRICHED), path.rsplit("/", 1)[-1]
    ).awaitTermination()
    return domain_table.read_current(x.spark, path).select(
        "id", "registered", "expired", "updated_at", "attempts"
    )
