"""Queries of the feed, the lifecycle, search and result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapseflow.functions import names, scoring
from lapseflow.functions.text import html_link
from lapseflow.operators import feed, search, search_index, stored_pages
from lapseflow.plans.inputs import AS_OF, Inputs, moment
from lapseflow.plans.registry import query
from lapseflow.session import scratch_path, stored
from lapseflow.sinks import files

_GRACE = "CASE registrar WHEN 'godaddy' THEN 90 WHEN 'sedo' THEN 70 END"
_AVAILABLE = f"strftime(expired + to_days({_GRACE}), '%B/%-d')"
_NOW = f"TIMESTAMP '{AS_OF}'"
_AGE = f"""year({_NOW}) - year(registered) - CASE WHEN month({_NOW}) * 100 + day({_NOW})
         < month(registered) * 100 + day(registered) THEN 1 ELSE 0 END"""


@query("available_date", f"SELECT name, tld, {_AVAILABLE} AS available FROM fx_dated")
def available_date(x: Inputs) -> DataFrame:
    text = scoring.availability_text(F.col("expired"), F.col("registrar"))
    return x.dated().select("name", "tld", text.alias("available"))


@query("ace_flag", "SELECT id, coalesce(has_wiki, false) OR coalesce(alexa_score, 0) > 0 AS ace FROM fx_enriched")
def ace_flag(x: Inputs) -> DataFrame:
    flag = scoring.accredited(F.col("has_wiki"), F.col("alexa_score"))
    return x.enriched().select("id", flag.alias("ace"))


@query("domain_age", f"SELECT name, tld, CAST(date_diff('day', registered, {_NOW}) AS INTEGER) AS age_days, CAST({_AGE} AS INTEGER) AS age_years FROM fx_dated")
def domain_age(x: Inputs) -> DataFrame:
    born, now = F.col("registered"), moment(AS_OF)
    return x.dated().select(
        "name",
        "tld",
        scoring.age_days(born, now).alias("age_days"),
        scoring.age_years(born, now).alias("age_years"),
    )


@query("sale_stage", f"""
    SELECT name, tld, CASE WHEN expired + to_days({_GRACE}) <= {_NOW} THEN 'sellable'
                           WHEN expired <= {_NOW} AND registrar = 'godaddy' THEN 'grace'
                           WHEN expired <= {_NOW} THEN 'waiting' ELSE 'listed' END AS sale_stage
    FROM fx_dated""")
def sale_stage(x: Inputs) -> DataFrame:
    return feed.with_sale_stage(x.dated(), moment(AS_OF)).select("name", "tld", "sale_stage")


@query("retention_keep", f"SELECT seq, domain_name, auction_end FROM fx_listing WHERE auction_end >= {_NOW} - INTERVAL 90 DAY")
def retention_keep(x: Inputs) -> DataFrame:
    keep, _ = feed.retention(x.listing(), "auction_end", moment(AS_OF))
    return keep.select("seq", "domain_name", "auction_end")


@query("retention_archive", f"SELECT seq, domain_name, auction_end, strftime(auction_end, '%Y-%m') AS month FROM fx_listing WHERE auction_end < {_NOW} - INTERVAL 90 DAY")
def retention_archive(x: Inputs) -> DataFrame:
    _, old = feed.retention(x.listing(), "auction_end", moment(AS_OF))
    return old.select("seq", "domain_name", "auction_end", "month")


@query("retention_by_month", f"""
    SELECT seq, domain_name, listed_at, strftime(listed_at, '%Y-%m') AS month, coalesce(listed_at >= {_NOW} - INTERVAL 90 DAY, true) AS kept
    FROM (SELECT seq, domain_name, CASE WHEN seq % 11 > 0 THEN auction_end END AS listed_at FROM fx_listing) l""")
def retention_by_month(x: Inputs) -> DataFrame:
    """Listings stored by month, some undated, after two rounds of moving whole months to the archive."""
    live, archive = scratch_path(x.spark, "listings"), scratch_path(x.spark, "archive")
    dated = F.when(F.col("seq") % 11 > 0, F.col("auction_end")).alias("listed_at")
    files.write_listings(x.listing().select("seq", "domain_name", dated), live, "listed_at")
    for month in ("1994-02", "1998-04"):
        files.archive_months(x.spark, live, archive, month)
    layout = "seq BIGINT, domain_name STRING, listed_at TIMESTAMP_NTZ"
    sides = [files.read_listings(x.spark, path, layout) for path in (live, archive)]
    keep, old = feed.stored_retention(*sides, "listed_at", moment(AS_OF))
    return keep.withColumn("kept", F.lit(True)).unionByName(old.withColumn("kept", F.lit(False)))


def feed_domains(x: Inputs) -> DataFrame:
    """Dated domains with their wiki and rank answers, stored as a domain table would be."""
    looked_up = x.enriched().select("name", "tld", "has_wiki", "alexa_score")
    return stored(x.dated().join(looked_up, ["name", "tld"]), "feed")


@query("front_end_feed", f"""
    SELECT concat(d.name, '.', d.tld) AS domain, {_AVAILABLE} AS available,
           CASE WHEN EXISTS (SELECT 1 FROM fx_domain o WHERE o.name = d.name AND o.tld <> d.tld
                             AND o.tld IN ('org', 'net', 'com')) THEN 'no' ELSE 'yes' END AS "unique",
           (SELECT coalesce(e.has_wiki, false) OR coalesce(e.alexa_score, 0) > 0 FROM fx_enriched e
            WHERE e.name = d.name AND e.tld = d.tld) AS ace,
           CAST({_AGE} AS INTEGER) AS age,
           CASE WHEN d.seq % 150 + 1 <= 100 AND d.seq % 4 = 0 THEN 'good' ELSE 'neutral' END AS search,
           expired, registered, CAST(NULL AS VARCHAR) AS category
    FROM fx_dated d""")
def front_end_feed(x: Inputs) -> DataFrame:
    return feed.front_end_feed(feed_domains(x), x.search_results(), moment(AS_OF))


# Pages and search


def domain_names(x: Inputs) -> DataFrame:
    return x.domains().select(names.qualified(F.col("name"), F.col("tld")).alias("domain_name"))


_NAMES = "SELECT concat(name, '.', tld) AS domain_name FROM fx_domain"


@query("page_domains", f"{_NAMES} ORDER BY domain_name LIMIT 50 OFFSET 100")
def page_domains(x: Inputs) -> DataFrame:
    return search.page(domain_names(x), 50, 3)


@query("page_domains_stored", f"""
    SELECT * FROM (SELECT 1 AS page, domain_name FROM ({_NAMES}) n ORDER BY domain_name LIMIT 7)
    UNION ALL SELECT * FROM (SELECT 50 AS page, domain_name FROM ({_NAMES}) n ORDER BY domain_name LIMIT 7 OFFSET 343)""")
def page_domains_stored(x: Inputs) -> DataFrame:
    """The first page and a deep one from a stored order."""
    path = scratch_path(x.spark, "order")
    stored_pages.store_order(domain_names(x), path, ranges=16)
    pages = [stored_pages.stored_page(x.spark, path, 7, n).select(F.lit(n).alias("page"), "domain_name") for n in (1, 50)]
    return pages[0].unionByName(pages[1])


@query("page_numbers_stored", "SELECT CAST(100 AS BIGINT) AS current_offset, CAST((count(*) + 49) // 50 AS BIGINT) AS pages, CASE WHEN (count(*) + 49) // 50 > 3 THEN 4 END AS next_page, 2 AS prev_page FROM fx_domain")
def page_numbers_stored(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "order")
    stored_pages.store_order(domain_names(x), path)
    return stored_pages.stored_page_numbers(x.spark, path, 50, 3)


@query("page_domains_after", f"SELECT domain_name FROM ({_NAMES}) n WHERE domain_name > 'red' ORDER BY domain_name LIMIT 50")
def page_domains_after(x: Inputs) -> DataFrame:
    return search.page_after(domain_names(x), 50, "red")


@query("page_numbers", "SELECT CAST(100 AS BIGINT) AS current_offset, CAST((count(*) + 49) // 50 AS BIGINT) AS pages, CASE WHEN (count(*) + 49) // 50 > 3 THEN 4 END AS next_page, 2 AS prev_page FROM fx_domain")
def page_numbers(x: Inputs) -> DataFrame:
    return search.page_numbers(domain_names(x), 50, 3)


@query("sample_limit", "SELECT seq, domain_name FROM fx_listing ORDER BY seq LIMIT 100")
def sample_limit(x: Inputs) -> DataFrame:
    return search.first_rows(x.listing().select("seq", "domain_name"), 100)


@query("export_limit", "SELECT id, name, tld FROM fx_table ORDER BY id LIMIT 500")
def export_limit(x: Inputs) -> DataFrame:
    return search.first_rows(x.domain_table().select("id", "name", "tld"), 500, "id")


@query("api_result_shape", f"""
    SELECT concat('{{"results":[', (SELECT string_agg(concat('{{"domain_name":"', domain_name, '"}}'), ',' ORDER BY domain_name)
                                    FROM (SELECT domain_name FROM ({_NAMES}) n ORDER BY domain_name LIMIT 50 OFFSET 100) p),
                  '],"current_offset":100,"pages":', CAST((count(*) + 49) // 50 AS BIGINT),
                  CASE WHEN (count(*) + 49) // 50 > 3 THEN ',"next_page":4' ELSE '' END, ',"prev_page":2}}') AS body
    FROM fx_domain""")
def api_result_shape(x: Inputs) -> DataFrame:
    return search.api_result(domain_names(x), 50, 3)


TERMS = ("bluebolt", "ring", "tacos", "steelgear")

_GRAMS = "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr('  ' || {0} || ' ', CAST(i AS INTEGER), 3)))"


@query("term_search", f"""
    SELECT term, name, similarity, distance, position FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY term ORDER BY similarity DESC, distance, name) AS INTEGER) AS position
        FROM (SELECT term, name, CAST(levenshtein(term, name) AS INTEGER) AS distance,
                     len(list_intersect(g, h)) / (len(g) + len(h) - len(list_intersect(g, h))) AS similarity
              FROM (SELECT name, {_GRAMS.format('name')} AS g FROM (SELECT DISTINCT name FROM fx_domain) n) a,
                   (SELECT term, {_GRAMS.format('term')} AS h FROM (VALUES {', '.join(f"('{t}')" for t in TERMS)}) v(term)) b
             ) s WHERE similarity >= 0.3) r
    WHERE position <= 10""")
def term_search(x: Inputs) -> DataFrame:
    return search.term_search(x.norm(), TERMS).select(
        "term", "name", "similarity", "distance", "position"
    )


@query("term_search_index", f"""
    SELECT term, name, similarity, distance, position FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY term ORDER BY similarity DESC, distance, name) AS INTEGER) AS position
        FROM (SELECT term, name, CAST(levenshtein(term, name) AS INTEGER) AS distance,
                     len(list_intersect(g, h)) / (len(g) + len(h) - len(list_intersect(g, h))) AS similarity
              FROM (SELECT name, {_GRAMS.format('name')} AS g FROM (SELECT DISTINCT name FROM fx_domain) n) a,
                   (SELECT term, {_GRAMS.format('term')} AS h FROM (SELECT DISTINCT lower(split_part(p_name, ' ', 2)) AS term FROM part UNION SELECT DISTINCT lower(replace(n_name, ' ', '')) FROM nation) v) b
             ) s WHERE similarity >= 0.3) r
    WHERE position <= 10""")
def term_search_index(x: Inputs) -> DataFrame:
    """Many terms at once, a table of them, over stored postings."""
    path = scratch_path(x.spark, "index")
    search_index.build_index(x.norm(), path)
    second = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    terms = x.table("part").select(second.alias("term")).unionByName(x.table("nation").select(F.replace("n_name", F.lit(" "), F.lit("")).alias("term")))
    return search_index.search_index(x.spark, path, terms).select("term", "name", "similarity", "distance", "position")


_BASE = "https://files.example.org/"


@query("html_link", f"SELECT concat('<a href=\"{_BASE}', host, '\">', host, '</a>') AS link, page_id FROM fx_page_host")
def link_report(x: Inputs) -> DataFrame:
    return x.page_hosts().select(html_link(F.col("host"), _BASE).alias("link"), "page_id")
