"""Queries that land files of each supported format and read them back."""

from __future__ import annotations

import itertools
import zipfile
from collections.abc import Iterator
from operator import itemgetter

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lapseflow.functions import names
from lapseflow.operators import feed, ingest, normalise
from lapseflow.plans.ingest import market_rows
from lapseflow.plans.inputs import AS_OF, Inputs, moment
from lapseflow.plans.registry import query
from lapseflow.plans.views import uuid_sql
from lapseflow.session import scratch_path
from lapseflow.sinks import files
from lapseflow.sources import auctions, feeds, tables

# Listings per landed envelope: bounds what one document, hence one task, holds.
ENVELOPE_ROWS = 20_000
# Bytes of a document that its archive's writer gets at once.
PIECE = 1 << 16
# Bytes of a range in the query of one long document, short enough that the smallest input has several.
LONG = 1 << 16

_AUCTION = """
    SELECT l.seq, l.domain_name, a.price, a.is_adult, a.domain_age, a.auction_end_time
    FROM fx_listing l JOIN fx_attr a ON a.seq = l.seq"""


def envelope_documents(x: Inputs, of: Column | None = None) -> DataFrame:
    """Listings as JSON envelopes, one document per run of ENVELOPE_ROWS keys."""
    listings = x.listing() if of is None else x.listing().where(of)
    rows = listings.drop("price").join(x.attributes(), "seq")
    entry = F.struct(
        F.col("domain_name").alias("domainName"),
        F.col("seq").cast("string").alias("link"),
        "auctionEndTime",
        "price",
        "domainAge",
        "isAdult",
    )
    grouped = rows.groupBy(F.floor(F.col("seq") / ENVELOPE_ROWS).alias("chunk")).agg(
        F.collect_list(entry).alias("data"), F.count("seq").alias("records")
    )
    document = F.to_json(F.struct(F.struct("records").alias("meta"), "data"))
    return grouped.select(
        "chunk",
        F.concat(F.lit("all_listings"), F.col("chunk"), F.lit(".json.zip")).alias("file_name"),
        document.alias("document"),
    )


def auction_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("link").cast("bigint").alias("seq"),
        F.col("domainName").alias("domain_name"),
        "price",
        F.col("isAdult").alias("is_adult"),
        F.col("domainAge").alias("domain_age"),
        F.col("auctionEndTime").alias("auction_end_time"),
    )


@query("scan_auction_json", _AUCTION)
def scan_auction_json(x: Inputs) -> DataFrame:
    documents = envelope_documents(x).select("document")
    path = x.landed("envelopes", documents.write.option("maxRecordsPerFile", 1).text)
    return auction_columns(auctions.auction_json(x.spark, path))


@query("scan_listing_select", """
    SELECT file_name FROM (
        SELECT concat(CASE seq % 3 WHEN 0 THEN 'all_listings' WHEN 1 THEN 'all_listings_' ELSE 'other' END,
                      seq, '.json.zip') AS file_name FROM fx_listing) f
    WHERE starts_with(file_name, 'all_listings') AND NOT starts_with(file_name, 'all_listings_')""")
def scan_listing_select(x: Inputs) -> DataFrame:
    kind = F.col("seq") % 3
    stem = F.when(kind == 0, "all_listings").when(kind == 1, "all_listings_").otherwise("other")
    name = F.concat(stem, F.col("seq"), F.lit(".json.zip"))
    return auctions.select_listing_files(x.listing().select(name.alias("file_name")))


def document_pieces(documents: DataFrame) -> DataFrame:
    """(file_name, piece): the bytes of each document in its order, at most PIECE in a row."""
    # Bytes are cut where they lie; characters would be counted from the document's beginning for each piece.
    raw = documents.select("file_name", F.col("document").cast("binary").alias("raw"))
    last = F.floor((F.octet_length("raw") - 1) / PIECE).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("raw", i * PIECE + 1, F.lit(PIECE)))
    return raw.select("file_name", F.explode(pieces).alias("piece"))


def land_archives(documents: DataFrame, path: str) -> None:
    """Each document as an archive with one member, a file below ``path``; a task's Python holds some pieces of one."""

    def archives(rows: Iterator[Row]) -> None:
        store, root = FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path.removeprefix("file:"))
        store.create_dir(root)
        # The pieces of a document follow each other.
        for name, group in itertools.groupby(rows, key=itemgetter("file_name")):
            # A task that runs again writes the same file.
            with (
                store.open_output_stream(f"{root}/{name}") as file,
                zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive,
                archive.open(name.rsplit(".", 1)[0], "w") as member,
            ):
                for row in group:
                    member.write(row["piece"])

    document_pieces(documents).foreachPartition(archives)


@query("load_feeds", "SELECT name, tld, registrar FROM fx_norm")
def load_feeds(x: Inputs) -> DataFrame:
    """Each registrar's listings landed in its own format, loaded through its feed."""
    json, market = scratch_path(x.spark, "envelopes"), scratch_path(x.spark, "market")
    auction = envelope_documents(x, F.col("registrar") == "GoDaddy").select("document")
    auction.write.option("maxRecordsPerFile", 1).text(json)
    market_rows(x, F.col("registrar") == "sedo").write.csv(
        market, sep=";", encoding="UTF-16", header=True
    )
    loaded = normalise.union_feeds(
        feeds.AUCTION_JSON.load(x.spark, json, 0), feeds.MARKET_CSV.load(x.spark, market, 1)
    )
    return loaded.select("name", "tld", "registrar")


@query("scan_zip_json", _AUCTION)
def scan_zip_json(x: Inputs) -> DataFrame:
    path = x.landed("archives", lambda to: land_archives(envelope_documents(x), to))
    return auction_columns(auctions.zipped_auction_json(x.spark, path))


@query("scan_long_json", _AUCTION)
def scan_long_json(x: Inputs) -> DataFrame:
    """All listings as one document, which no task reads alone."""

    def land(to: str) -> None:
        # Long lines of the one document; the array goes on from line to line.
        lines = envelope_documents(x).select("chunk", F.substring_index(F.substring_index("document", '"data":[', -1), "]}", 1).alias("line"))
        last = lines.agg(F.max("chunk")).scalar()
        end = F.when(F.col("chunk") == last, "]}").otherwise(",")
        start = F.when(F.col("chunk") == lines.agg(F.min("chunk")).scalar(), '{"meta":{"records":"[{"},"data":[').otherwise("")
        lines.orderBy("chunk").coalesce(1).select(F.concat(start, "line", end)).write.text(to)

    path = x.landed("long", land)
    return auction_columns(auctions.auction_json(x.spark, path, size=LONG))


_MARKET = """
    SELECT split_part(domain_name, '.', 1) AS name, strftime(auction_end, '%Y-%m-%d') AS start_time,
           strftime(auction_end + INTERVAL 7 DAY, '%Y-%m-%d') AS end_time, a.price AS reserve_price,
           CAST(l.seq AS INTEGER) AS traffic
    FROM fx_listing l JOIN fx_attr a ON a.seq = l.seq"""


@query("scan_auction_csv", _MARKET)
def scan_auction_csv(x: Inputs) -> DataFrame:
    path = x.landed("market", lambda to: market_rows(x).write.csv(to, sep=";", encoding="UTF-16", header=True))
    return market_columns(auctions.market_csv(x.spark, path))


@query("scan_long_csv", _MARKET)
def scan_long_csv(x: Inputs) -> DataFrame:
    """All listings as one marketplace file, which no task reads alone."""
    # One task writes the file; the rows come from many (coalesce would have it join them alone).
    path = x.landed("long-market", lambda to: market_rows(x).repartition(1).write.csv(to, sep=";", encoding="UTF-16", header=True))
    return market_columns(auctions.market_csv(x.spark, path, size=LONG))


def market_columns(listings: DataFrame) -> DataFrame:
    rows = normalise.rename_market_columns(listings)
    return rows.select(
        names.first_label(F.col("name")).alias("name"),
        "start_time",
        "end_time",
        "reserve_price",
        F.col("traffic").try_cast("int").alias("traffic"),
    )


def _staged(x: Inputs) -> DataFrame:
    rows = normalise.to_contract(
        x.listing(),
        "domain_name",
        registered=F.when(F.col("seq") % 3 > 0, F.col("auction_end")),
    )
    return tables.staged_csv(x.spark, x.landed("batches", lambda to: files.write_batches(rows, to)))


@query("write_batches", """
    SELECT name, tld, registrar, '01/01/1970 00:00:00' AS expired,
           CASE WHEN seq % 3 > 0 THEN strftime(auction_end, '%m/%d/%Y %H:%M:%S')
                ELSE '01/01/1970 00:00:00' END AS registered FROM fx_norm""")
def write_batches(x: Inputs) -> DataFrame:
    return _staged(x)


@query("scan_staged_csv", "SELECT name, tld, registrar, CAST(NULL AS TIMESTAMP) AS expired, CASE WHEN seq % 3 > 0 THEN auction_end END AS registered FROM fx_norm")
def scan_staged_csv(x: Inputs) -> DataFrame:
    return normalise.from_staged(_staged(x)).drop("seq")


@query("insert_staged_batches", f"""
    SELECT {uuid_sql("d.name || '.' || d.tld")} AS id, d.name, d.tld, t.id AS tld_id, r.id AS registrar_id
    FROM (SELECT name, tld, min(registrar) AS registrar FROM fx_norm GROUP BY name, tld) d
    JOIN fx_tld t ON t.name = d.tld JOIN fx_registrar r ON r.name = d.registrar""")
def insert_staged_batches(x: Inputs) -> DataFrame:
    """Staged batch files read back and inserted; within one batch the first registrar in the alphabet wins."""
    rows = normalise.from_staged(_staged(x), seq=1)
    none = ingest.empty_domains(x.spark)
    fresh = ingest.insert_new_domains(rows, none, x.tld_dim(), x.registrar_dim(), moment(AS_OF))
    return fresh.select("id", "name", "tld", "tld_id", "registrar_id")


def _exported(x: Inputs) -> str:
    path = scratch_path(x.spark, "export")
    rows = feed.with_sale_stage(x.dated(), moment(AS_OF))
    quoted = F.concat(F.lit('a "quoted", note; '), F.col("sale_stage"))
    files.export_csv(rows.select("name", "tld", quoted.alias("note"), "expired"), path)
    return path


@query("export_csv", f"""
    SELECT name, tld, concat('a "quoted", note; ',
               CASE WHEN expired + to_days(CASE registrar WHEN 'godaddy' THEN 90 ELSE 70 END) <= TIMESTAMP '{AS_OF}' THEN 'sellable'
                    WHEN expired <= TIMESTAMP '{AS_OF}' AND registrar = 'godaddy' THEN 'grace'
                    WHEN expired <= TIMESTAMP '{AS_OF}' THEN 'waiting' ELSE 'listed' END) AS note,
           expired FROM fx_dated""")
def export_csv(x: Inputs) -> DataFrame:
    layout = "name STRING, tld STRING, note STRING, expired TIMESTAMP_NTZ"
    return x.spark.read.schema(layout).csv(_exported(x), header=True, quote='"', escape='"')


@query("export_manifest", """
    SELECT registrar, true AS linked, true AS filled, true AS dated, count(*) AS n_rows
    FROM fx_dated GROUP BY registrar""")
def export_manifest(x: Inputs) -> DataFrame:
    """An export folder per registrar: what its manifest says, next to the rows that its files hold."""
    root = scratch_path(x.spark, "exports")
    x.dated().select("registrar", "name", "tld", "expired").write.partitionBy("registrar").csv(
        root, header=True, quote='"', escape='"'
    )
    base = "https://files.example.org/"
    lines = files.export_manifest(x.spark, root, base)
    said = lines.groupBy("folder").agg(
        F.every(F.col("file_name").rlike(f'^<a href="{base}[^"]+[.]csv">[^<]+[.]csv</a>$')).alias("linked"),
        F.every(F.col("size") > 0).alias("filled"),
        F.every(F.col("date").isNotNull()).alias("dated"),
    )
    layout = "name STRING, tld STRING, expired TIMESTAMP_NTZ, registrar STRING"
    held = x.spark.read.schema(layout).csv(root, header=True, quote='"', escape='"')
    counted = held.groupBy("registrar").agg(F.count(F.lit(1)).alias("n_rows"))
    return said.withColumn("registrar", F.split_part("folder", F.lit("="), F.lit(2))).join(counted, "registrar").select(
        "registrar", "linked", "filled", "dated", "n_rows"
    )
