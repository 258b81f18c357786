"""Queries over listings: cleaning, contract, dimensions, inserts and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapseflow.functions import names, values
from lapseflow.operators import dims, ingest, normalise, quality
from lapseflow.operators.enrich import ENRICHERS, unenriched
from lapseflow.plans.inputs import KNOWN_BEFORE, LOADED, Inputs, moment
from lapseflow.plans.registry import query
from lapseflow.plans.views import uuid_sql
from lapseflow.schemas import AUCTION_META, MARKET_COLUMNS, MARKET_EXTRA, MARKET_META
from lapseflow.session import stored
from lapseflow.sources import tables

# Splitting, rejecting, folding


@query("split_domain", "SELECT seq, split_part(domain_name, '.', 1) AS name, CASE WHEN domain_name LIKE '%.%' THEN substr(domain_name, strpos(domain_name, '.') + 1) ELSE '' END AS tld FROM fx_listing")
def split_domain(x: Inputs) -> DataFrame:
    return normalise.split_domain(x.listing()).select("seq", "name", "tld")


@query("split_domain_second", "SELECT seq, split_part(domain_name, '.', 1) AS name, split_part(domain_name, '.', 2) AS tld FROM fx_listing")
def split_domain_second(x: Inputs) -> DataFrame:
    return normalise.split_domain(x.listing(), mode="second").select("seq", "name", "tld")


@query("split_page_host", "SELECT page_id, split_part(host, '.', 1) AS name, substr(host, strpos(host, '.') + 1) AS tld FROM fx_page_host WHERE host LIKE '%.%'")
def split_page_host(x: Inputs) -> DataFrame:
    hosts = normalise.accepted(x.page_hosts(), "host")
    return normalise.split_domain(hosts, "host").select("page_id", "name", "tld")


@query("reject_undotted", "SELECT seq, domain_name, CASE WHEN domain_name IS NULL OR domain_name = '' THEN 'empty' ELSE 'no_dot' END AS reason FROM fx_listing WHERE domain_name IS NULL OR strpos(domain_name, '.') = 0")
def reject_undotted(x: Inputs) -> DataFrame:
    return normalise.rejects(x.listing()).select("seq", "domain_name", "reason")


@query("tag_registrar", "SELECT seq, domain_name, CASE registrar WHEN 'GoDaddy' THEN 'godaddy' ELSE 'sedo' END AS registrar FROM fx_listing")
def tag_registrar(x: Inputs) -> DataFrame:
    rows = x.listing()
    feeds = {"GoDaddy": "godaddy", "sedo": "sedo"}
    tagged = [
        normalise.tag_registrar(rows.where(F.col("registrar") == raw), name)
        for raw, name in feeds.items()
    ]
    return normalise.union_feeds(*tagged).select("seq", "domain_name", "registrar")


@query("lower_keys", "SELECT seq, name, tld, registrar FROM fx_norm")
def lower_keys(x: Inputs) -> DataFrame:
    rows = normalise.split_domain(normalise.accepted(x.listing()))
    return normalise.lower_keys(rows).select("seq", "name", "tld", "registrar")


# Typing feed text


@query("null_placeholder_dates", "SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderdate END AS expired, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS registered FROM orders")
def null_placeholder_dates(x: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "P", "01/01/1970 00:00:00").otherwise(
        F.date_format(day, values.STAGED_TIME_FORMAT)
    )
    seconds = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(
        F.unix_timestamp(day.cast("timestamp"))
    )
    return x.table("orders").select(
        F.col("o_orderkey").alias("seq"),
        values.known_date(text).alias("expired"),
        values.known_epoch(seconds).alias("registered"),
    )


@query("rename_market_columns", """
    SELECT domain_name AS name, strftime(auction_end, '%Y-%m-%d') AS start_time,
           strftime(auction_end + INTERVAL 7 DAY, '%Y-%m-%d') AS end_time, a.price AS reserve_price,
           'false' AS domain_is_idn, a.is_adult AS domain_has_hyphen, a.domain_age AS domain_has_numbers,
           CAST(length(domain_name) AS VARCHAR) AS domain_length, registrar AS tld,
           CAST(l.seq AS VARCHAR) AS traffic
    FROM fx_listing l JOIN fx_attr a ON a.seq = l.seq""")
def rename_market_columns(x: Inputs) -> DataFrame:
    return normalise.rename_market_columns(market_rows(x))


def market_rows(x: Inputs, of: Column | None = None) -> DataFrame:
    """Listings under the marketplace file's column titles."""
    listings = x.listing() if of is None else x.listing().where(of)
    start = F.col("auction_end")
    week = F.make_dt_interval(days=F.lit(7))
    parts = [
        F.col("domain_name"),
        F.date_format(start, "yyyy-MM-dd"),
        F.date_format(start + week, "yyyy-MM-dd"),
        F.col("a.price"),
        F.lit("false"),
        F.col("isAdult"),
        F.col("domainAge"),
        F.length("domain_name").cast("string"),
        F.col("registrar"),
        F.col("seq").cast("string"),
        F.concat(F.lit("https://"), F.col("domain_name")),
    ]
    rows = listings.join(x.attributes().alias("a"), "seq")
    return rows.select([c.alias(t) for c, t in zip(parts, [*MARKET_COLUMNS, *MARKET_EXTRA])])


@query("lower_headers", "SELECT seq, price, is_adult AS isadult, domain_age AS domainage, auction_end_time AS auctionendtime FROM fx_attr")
def lower_headers(x: Inputs) -> DataFrame:
    return normalise.lower_headers(x.attributes())


@query("cast_flags", "SELECT seq, coalesce(is_adult = 'True', false) AS is_adult FROM fx_attr")
def cast_flags(x: Inputs) -> DataFrame:
    return x.attributes().select("seq", values.true_flag(F.col("isAdult")).alias("is_adult"))


@query("cast_nullable_int", "SELECT seq, TRY_CAST(domain_age AS INTEGER) AS domain_age FROM fx_attr")
def cast_nullable_int(x: Inputs) -> DataFrame:
    return x.attributes().select("seq", values.nullable_int(F.col("domainAge")).alias("domain_age"))


@query("cast_money", "SELECT seq, CAST(TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DECIMAL(19,2)) AS DOUBLE) AS price FROM fx_attr")
def cast_money(x: Inputs) -> DataFrame:
    return x.attributes().select("seq", values.money(F.col("price")).cast("double").alias("price"))


@query("strip_zulu", "SELECT seq, TRY_CAST(replace(auction_end_time, 'Z', '') AS TIMESTAMP) AS auction_end_time FROM fx_attr")
def strip_zulu(x: Inputs) -> DataFrame:
    ends = values.zulu_time(F.col("auctionEndTime"))
    return x.attributes().select("seq", ends.alias("auction_end_time"))


@query("project_needed_keys", "SELECT l.domain_name AS domainName, a.auction_end_time AS auctionEndTime FROM fx_listing l JOIN fx_attr a ON a.seq = l.seq")
def project_needed_keys(x: Inputs) -> DataFrame:
    rows = x.listing().join(x.attributes().drop("price"), "seq")
    return normalise.keep_auction_keys(rows.withColumnRenamed("domain_name", "domainName"))


@query("scan_json_recordset", """
    SELECT CAST(p_partkey AS INTEGER) AS p_id, split_part(p_name, ' ', 1) AS first_name,
           split_part(p_name, ' ', 2) AS last_name, concat('{"size":', p_size, '}') AS p_attribute,
           CAST(NULL AS VARCHAR) AS quote_content FROM part
    UNION ALL
    SELECT CAST(p_partkey AS INTEGER), NULL, NULL, NULL, p_brand FROM part""")
def scan_json_recordset(x: Inputs) -> DataFrame:
    word = [F.split_part(F.col("p_name"), F.lit(" "), F.lit(i)) for i in (1, 2)]
    text = F.format_string(
        '[{"p_id":%d,"first_name":"%s","last_name":"%s","p_attribute":{"size":%d},"more":[1]},'
        '{"quote_content":"%s","p_id":%d}]',
        "p_partkey", word[0], word[1], "p_size", "p_brand", "p_partkey",
    )
    return tables.json_recordset(x.table("part").select(text.alias("records")), "records")


@query("scan_wordlist", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def scan_wordlist(x: Inputs) -> DataFrame:
    words = x.table("part").select(F.explode(F.split("p_name", " ")).alias("word"))
    return tables.distinct_words(words)


# Label shape and names


@query("label_length", "SELECT seq, CAST(length(split_part(domain_name, '.', 1)) AS INTEGER) AS domain_length FROM fx_listing")
def label_length(x: Inputs) -> DataFrame:
    size = F.length(names.first_label(F.col("domain_name")))
    return x.listing().select("seq", size.alias("domain_length"))


_IDN = "CASE WHEN seq % 7 = 0 THEN concat('XN--', name) ELSE name END"


@query("label_shape_flags", f"""
    SELECT seq, name, lower(name) LIKE 'xn--%' AS domain_is_idn, name LIKE '%-%' AS domain_has_hyphen,
           regexp_matches(name, '[0-9]') AS domain_has_numbers,
           CAST(length(name) AS INTEGER) AS domain_length
    FROM (SELECT seq, {_IDN} AS name FROM fx_norm) q""")
def label_shape_flags(x: Inputs) -> DataFrame:
    return normalise.label_shape(x.norm().select("seq", F.expr(_IDN).alias("name")))


@query("qualified_name", "SELECT seq, concat(name, '.', tld) AS domain_name FROM fx_norm")
def qualified_name(x: Inputs) -> DataFrame:
    return x.norm().select("seq", names.qualified(F.col("name"), F.col("tld")).alias("domain_name"))


@query("domain_uuid", f"SELECT seq, {uuid_sql('''name || '.' || tld''')} AS id FROM fx_norm")
def domain_uuid(x: Inputs) -> DataFrame:
    raw = normalise.split_domain(normalise.accepted(x.listing()))
    return ingest.with_id(raw).select("seq", "id")


@query("project_internal_schema", "SELECT seq, name, tld, registrar, CAST(NULL AS TIMESTAMP) AS expired, CAST(NULL AS TIMESTAMP) AS registered FROM fx_norm")
def project_internal_schema(x: Inputs) -> DataFrame:
    return normalise.to_contract(x.listing(), "domain_name")


def page_contract(x: Inputs) -> DataFrame:
    hosts = x.page_hosts().withColumnRenamed("page_id", "seq")
    return normalise.to_contract(hosts, "host", registrar=F.lit("sedo"))


@query("union_feeds", """
    SELECT seq, name, tld, registrar FROM fx_norm
    UNION ALL
    SELECT page_id, split_part(host, '.', 1), substr(host, strpos(host, '.') + 1), 'sedo'
    FROM fx_page_host WHERE host LIKE '%.%'""")
def union_feeds(x: Inputs) -> DataFrame:
    feeds = normalise.union_feeds(normalise.to_contract(x.listing(), "domain_name"), page_contract(x))
    return feeds.select("seq", "name", "tld", "registrar")


# Days


@query("filter_added_on", "SELECT seq, domain_name FROM fx_listing WHERE CAST(auction_end AS DATE) = DATE '1997-05-28'")
def filter_added_on(x: Inputs) -> DataFrame:
    return ingest.added_on(x.listing(), "1997-05-28", "auction_end").select("seq", "domain_name")


@query("added_count", "SELECT count(domain_name) AS added FROM fx_listing WHERE CAST(auction_end AS DATE) = DATE '1997-05-28'")
def added_count(x: Inputs) -> DataFrame:
    return ingest.added_count(x.listing(), "1997-05-28", day="auction_end")


# Dimensions

KNOWN = f"SELECT * FROM fx_norm WHERE auction_end < TIMESTAMP '{KNOWN_BEFORE}'"


@query("distinct_keys", "SELECT DISTINCT tld AS name FROM fx_norm")
def distinct_keys(x: Inputs) -> DataFrame:
    rows = normalise.split_domain(normalise.accepted(x.listing()))
    return dims.distinct_keys(rows, "tld")


def nation_registrars(x: Inputs) -> DataFrame:
    """Orders under their customer's nation, which stands for a registrar name."""
    customers = x.table("customer").select("c_custkey", "c_nationkey")
    nations = x.table("nation")
    return (
        x.table("orders")
        .select("o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderkey").alias("seq"), F.col("c_nationkey").alias("registrar_id"), F.col("n_name").alias("registrar"))
    )


def accredited_nations(x: Inputs) -> DataFrame:
    """A registrar dimension that lacks the nations of two regions."""
    return (
        x.table("nation")
        .where(F.col("n_regionkey") >= 2)
        .select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("name"))
    )


@query("new_registrars", """
    SELECT DISTINCT lower(n_name) AS name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE lower(n_name) NOT IN (SELECT lower(n_name) FROM nation WHERE n_regionkey >= 2)""")
def new_registrars(x: Inputs) -> DataFrame:
    return dims.new_members(nation_registrars(x), "registrar", accredited_nations(x))


@query("new_tlds", """
    SELECT DISTINCT substr(host, strpos(host, '.') + 1) AS name FROM fx_page_host WHERE host LIKE '%.%'
    EXCEPT SELECT tld FROM fx_norm""")
def new_tlds(x: Inputs) -> DataFrame:
    return dims.new_members(page_contract(x), "tld", dims.distinct_keys(x.norm(), "tld"))


@query("grow_dimension", """
    SELECT id, name FROM fx_tld
    UNION ALL
    SELECT CAST((SELECT max(id) FROM fx_tld) + row_number() OVER (ORDER BY md5(name), name) AS INTEGER), name
    FROM (SELECT DISTINCT substr(host, strpos(host, '.') + 1) AS name FROM fx_page_host
          WHERE host LIKE '%.%' EXCEPT SELECT name FROM fx_tld) q""")
def grow_dimension(x: Inputs) -> DataFrame:
    first = x.tld_dim()
    return dims.grow_dimension(first, page_contract(x), "tld", moment(LOADED)).select("id", "name")


@query("resolve_dim_ids", f"""
    SELECT n.seq, n.name, t.id AS tld_id, r.id AS registrar_id FROM fx_norm n
    LEFT JOIN (SELECT CAST(row_number() OVER (ORDER BY md5(tld), tld) AS INTEGER) AS id, tld
               FROM (SELECT DISTINCT tld FROM ({KNOWN}) k) d) t ON t.tld = n.tld
    LEFT JOIN fx_registrar r ON r.name = n.registrar""")
def resolve_dim_ids(x: Inputs) -> DataFrame:
    known = x.norm().where(F.col("auction_end") < moment(KNOWN_BEFORE))
    tlds = dims.grow_dimension(dims.empty_dimension(x.spark), known, "tld", moment(LOADED))
    facts = dims.resolve_ids(x.norm(), tlds, "tld", "tld_id")
    return dims.resolve_ids(facts, x.registrar_dim(), "registrar", "registrar_id").select(
        "seq", "name", "tld_id", "registrar_id"
    )


@query("domain_with_tld", "SELECT t.id, t.name, d.name AS tld FROM fx_table t JOIN fx_tld d ON d.id = t.tld_id")
def domain_with_tld(x: Inputs) -> DataFrame:
    facts = x.domain_table().select("id", "name", "tld_id")
    return dims.with_member_name(facts, x.tld_dim(), "tld_id", "tld").select("id", "name", "tld")


# Inserts


@query("insert_new_domains", f"""
    SELECT {uuid_sql("d.name || '.' || d.tld")} AS id, d.name, d.tld, t.id AS tld_id, r.id AS registrar_id,
           TIMESTAMP '{LOADED}' AS created_at, TIMESTAMP '{LOADED}' AS updated_at
    FROM fx_domain d JOIN fx_tld t ON t.name = d.tld JOIN fx_registrar r ON r.name = d.registrar
    WHERE (d.name, d.tld) NOT IN (SELECT (name, tld) FROM ({KNOWN}) k)""")
def insert_new_domains(x: Inputs) -> DataFrame:
    """A whole load on top of the table as it stood before."""
    fresh = ingest.insert_new_domains(
        x.staged().drop("auction_end", "price"),
        known_domains(x),
        x.tld_dim(),
        x.registrar_dim(),
        moment(LOADED),
    )
    return fresh.select("id", "name", "tld", "tld_id", "registrar_id", "created_at", "updated_at")


def known_domains(x: Inputs) -> DataFrame:
    known = x.staged().where(F.col("auction_end") < moment(KNOWN_BEFORE))
    return ingest.first_wins(known).select("name", "tld")


@query("stamp_created", f"SELECT id, TIMESTAMP '{LOADED}' AS created_at, TIMESTAMP '{LOADED}' AS updated_at FROM fx_table")
def stamp_created(x: Inputs) -> DataFrame:
    rows = ingest.with_id(x.domains())
    return ingest.stamp_created(rows, moment(LOADED)).select("id", "created_at", "updated_at")


@query("ingest_delta", f"""
    SELECT b.n AS rows_before, a.n AS rows_after, a.n - b.n AS rows_added, p.n AS rows_pending
    FROM (SELECT count(*) AS n FROM (SELECT DISTINCT name, tld FROM ({KNOWN}) k) q) b,
         (SELECT count(*) AS n FROM fx_domain) a,
         (SELECT count(*) AS n FROM fx_listing WHERE domain_name NOT LIKE '%.%') p""")
def ingest_delta(x: Inputs) -> DataFrame:
    before = known_domains(x)
    batch = ingest.first_wins(x.staged())
    added = ingest.not_stored(batch, before)
    return ingest.ingest_delta(before, added, normalise.rejects(x.listing()))


@query("upsert_auction_meta", f"""
    SELECT domain_id, seq, price, domain_age, is_adult, auction_end_time FROM (
        SELECT {uuid_sql("n.name || '.' || n.tld")} AS domain_id, n.seq,
               CAST(CAST(regexp_replace(a.price, '[$,]', '', 'g') AS DECIMAL(19,2)) AS DOUBLE) AS price,
               TRY_CAST(a.domain_age AS INTEGER) AS domain_age,
               coalesce(a.is_adult = 'True', false) AS is_adult,
               CAST(replace(a.auction_end_time, 'Z', '') AS TIMESTAMP) AS auction_end_time,
               row_number() OVER (PARTITION BY n.name, n.tld ORDER BY n.seq DESC) AS rn
        FROM fx_norm n JOIN fx_attr a ON a.seq = n.seq) q
    WHERE rn = 1""")
def upsert_auction_meta(x: Inputs) -> DataFrame:
    typed = normalise.type_auction_attributes(x.attributes())
    rows = x.norm().select("seq", "name", "tld").join(typed, "seq")
    # A first load of the odd rows, then all rows on top of what it stored.
    old = stored(ingest.upsert_meta(rows.where("seq % 2 = 1"), AUCTION_META), "auction-meta")
    latest = ingest.upsert_meta(rows, AUCTION_META, old)
    return latest.select(
        "domain_id",
        "seq",
        F.col("price").cast("double").alias("price"),
        F.col("domainAge").alias("domain_age"),
        F.col("isAdult").alias("is_adult"),
        F.col("auctionEndTime").alias("auction_end_time"),
    )


@query("upsert_market_meta", f"""
    SELECT domain_id, seq, start_time, end_time, reserve_price, domain_is_idn, domain_has_hyphen, domain_length FROM (
        SELECT {uuid_sql("n.name || '.' || n.tld")} AS domain_id, n.seq,
               CAST(CAST(n.auction_end AS DATE) AS TIMESTAMP) AS start_time,
               CAST(CAST(n.auction_end AS DATE) AS TIMESTAMP) + INTERVAL 7 DAY AS end_time,
               CAST(CAST(regexp_replace(a.price, '[$,]', '', 'g') AS DECIMAL(19,2)) AS DOUBLE) AS reserve_price,
               false AS domain_is_idn, TRY_CAST(a.is_adult AS BOOLEAN) AS domain_has_hyphen,
               CAST(length(n.name) + 1 + length(n.tld) AS INTEGER) AS domain_length,
               row_number() OVER (PARTITION BY n.name, n.tld ORDER BY n.seq DESC) AS rn
        FROM fx_norm n JOIN fx_attr a ON a.seq = n.seq) q
    WHERE rn = 1""")
def upsert_market_meta(x: Inputs) -> DataFrame:
    renamed = normalise.accepted(normalise.rename_market_columns(market_rows(x)), "name")
    typed = normalise.type_market_attributes(renamed)
    domain = F.col("name")
    keyed = typed.withColumns(
        {
            "name": names.first_label(domain),
            "tld": names.tail(domain),
            "seq": F.col("traffic").cast("bigint"),
        }
    )
    return ingest.upsert_meta(keyed, MARKET_META).select(
        "domain_id",
        "seq",
        "start_time",
        "end_time",
        F.col("reserve_price").cast("double").alias("reserve_price"),
        "domain_is_idn",
        "domain_has_hyphen",
        "domain_length",
    )


# Checks


def flawed_domains(x: Inputs) -> DataFrame:
    """Listings under their customer's nation, with some names missing or too long."""
    rows = x.norm().select("seq", "name", "tld").join(nation_registrars(x), "seq")
    bad = F.col("seq") % 11
    return rows.select(
        "seq",
        F.when(bad == 0, F.lit(None)).when(bad == 1, F.repeat("name", F.lit(60))).otherwise(F.col("name")).alias("name"),
        F.when(bad == 2, F.repeat("tld", F.lit(25))).otherwise(F.col("tld")).alias("tld"),
        F.when(bad == 3, F.lit(None)).otherwise(F.col("registrar_id")).alias("registrar_id"),
    )


_FLAWED = """
    (SELECT n.seq, CASE WHEN n.seq % 11 = 0 THEN NULL WHEN n.seq % 11 = 1 THEN repeat(n.name, 60)
                   ELSE n.name END AS name,
            CASE WHEN n.seq % 11 = 2 THEN repeat(n.tld, 25) ELSE n.tld END AS tld,
            CASE WHEN n.seq % 11 = 3 THEN NULL ELSE c_nationkey END AS registrar_id
     FROM fx_norm n JOIN orders ON o_orderkey = n.seq JOIN customer ON c_custkey = o_custkey)"""
_ORPHAN = "registrar_id IS NOT NULL AND registrar_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey >= 2)"


@query("constraint_report", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) AS violations FROM {_FLAWED} f WHERE {test}"
    for rule, test in {
        "name_null": "name IS NULL",
        "tld_null": "tld IS NULL",
        "registrar_null": "registrar_id IS NULL",
        "name_too_long": "length(name) > 256",
        "tld_too_long": "length(tld) > 64",
        "registrar_orphan": _ORPHAN,
    }.items()))
def constraint_report(x: Inputs) -> DataFrame:
    return quality.constraint_report(flawed_domains(x), accredited_nations(x))


@query("orphan_registrar", f"SELECT seq, name, tld, registrar_id FROM {_FLAWED} f WHERE registrar_id IS NULL OR {_ORPHAN}")
def orphan_registrar(x: Inputs) -> DataFrame:
    facts = dims.orphans(flawed_domains(x), accredited_nations(x), "registrar_id")
    return facts.select("seq", "name", "tld", "registrar_id")


def _register_unenriched() -> None:
    tests = {
        "alexa": "alexa_score IS NULL",
        "wiki": "has_wiki IS NULL",
        "whois": "registered IS NULL OR expired IS NULL",
    }
    for source, test in tests.items():
        enricher = ENRICHERS[source]

        def build(x: Inputs, enricher=enricher) -> DataFrame:
            return unenriched(x.enriched(), enricher.missing).select("id", "name", "tld")

        query(f"filter_unenriched_{source}", f"SELECT id, name, tld FROM fx_enriched WHERE {test}")(build)


_register_unenriched()
