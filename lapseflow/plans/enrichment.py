"""Queries of the enrichment loop and of label scoring."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapseflow.functions import responses
from lapseflow.operators import enrich, labels
from lapseflow.operators.enrich import ENRICHERS
from lapseflow.plans.inputs import ENRICHED, Inputs, moment
from lapseflow.plans.registry import query
from lapseflow.session import scratch_path, stored
from lapseflow.sinks import domain_table
from lapseflow.sources import tables

# Landed responses and how their bodies read


@query("scan_raw_responses", "SELECT domain, 'wiki' AS source, wiki AS body, fetched_at, CAST(NULL AS VARCHAR) AS error, seq FROM fx_parsed")
def scan_raw_responses(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "responses")
    x.responses().write.parquet(path)
    return tables.landed_responses(x.spark, path, "wiki")


@query("parse_rank", "SELECT seq, CASE WHEN alexa IS NULL THEN NULL ELSE coalesce(TRY_CAST(nullif(regexp_extract(alexa, 'RANK=\"(\\d+)\"', 1), '') AS INTEGER), 0) END AS alexa_score FROM fx_bodies")
def parse_rank(x: Inputs) -> DataFrame:
    return x.bodies().select("seq", responses.rank(F.col("alexa")).alias("alexa_score"))


@query("parse_wiki", "SELECT seq, CASE WHEN json_valid(wiki) THEN json_array_length(wiki, '$[1]') > 0 END AS has_wiki, CASE WHEN json_valid(wiki) THEN CAST(json_array_length(wiki, '$[1]') AS INTEGER) END AS titles FROM fx_bodies")
def parse_wiki(x: Inputs) -> DataFrame:
    body = F.col("wiki")
    return x.bodies().select(
        "seq",
        responses.has_titles(body).alias("has_wiki"),
        responses.title_count(body).alias("titles"),
    )


@query("archive_count", "SELECT event_id AS seq, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE user_id % 5 END AS INTEGER) AS archive_count FROM events")
def archive_count(x: Inputs) -> DataFrame:
    return x.bodies().select("seq", responses.capture_count(F.col("archive")).alias("archive_count"))


@query("parse_whois", "SELECT seq, CAST(created_text AS TIMESTAMP) AS registered, CAST(expires_text AS TIMESTAMP) AS expired FROM fx_parsed WHERE usable")
def parse_whois(x: Inputs) -> DataFrame:
    return ENRICHERS["whois"].updates(x.responses()).select("seq", "registered", "expired")


@query("skip_failed", """
    SELECT 'alexa' AS source, count(*) AS responses, count(score) AS answers, count(*) - count(score) AS failures FROM fx_parsed
    UNION ALL SELECT 'wiki', count(*), count(has_wiki), count(*) - count(has_wiki) FROM fx_parsed
    UNION ALL SELECT 'whois', count(*), CAST(sum(CASE WHEN usable THEN 1 ELSE 0 END) AS BIGINT),
                     CAST(sum(CASE WHEN usable THEN 0 ELSE 1 END) AS BIGINT) FROM fx_parsed""")
def skip_failed(x: Inputs) -> DataFrame:
    return enrich.response_counts(x.responses(), list(ENRICHERS.values()))


# Backlogs and updates


def _register_backlogs() -> None:
    tests = {
        "alexa": "alexa_score IS NULL",
        "wiki": "has_wiki IS NULL",
        "whois": "registered IS NULL OR expired IS NULL",
    }
    for source, test in tests.items():
        enricher = ENRICHERS[source]

        def build(x: Inputs, enricher=enricher) -> DataFrame:
            return enricher.backlog(x.enriched())

        query(
            f"backlog_{source}",
            f"SELECT id, name, tld, greatest(updated_at, last_attempt) AS touched_at FROM fx_enriched "
            f"WHERE {test} ORDER BY touched_at NULLS LAST, id LIMIT 500",
        )(build)


_register_backlogs()

_ENRICHED_COLUMNS = ("id", "alexa_score", "has_wiki", "registered", "expired", "updated_at")


@query("apply_enrichment", f"SELECT {', '.join(_ENRICHED_COLUMNS)} FROM fx_enriched")
def apply_enrichment(x: Inputs) -> DataFrame:
    return x.enriched().select(*_ENRICHED_COLUMNS)


@query("touch_updated_at", f"SELECT t.id, CASE WHEN w.id IS NULL THEN t.updated_at ELSE TIMESTAMP '{ENRICHED}' END AS updated_at FROM fx_table t LEFT JOIN fx_new_wiki w ON w.id = t.id")
def touch_updated_at(x: Inputs) -> DataFrame:
    wiki = [ENRICHERS["wiki"]]
    table = enrich.apply_enrichment(x.domain_table(), x.responses(), wiki, moment(ENRICHED))
    return table.select("id", "updated_at")


@query("record_attempts", f"""
    SELECT t.id, CAST(coalesce(f.n, 0) AS INTEGER) AS attempts,
           CASE WHEN f.n IS NULL THEN NULL ELSE TIMESTAMP '{ENRICHED}' END AS last_attempt
    FROM fx_table t LEFT JOIN (SELECT id, count(*) AS n FROM fx_parsed WHERE score IS NULL GROUP BY id) f
    ON f.id = t.id""")
def record_attempts(x: Inputs) -> DataFrame:
    rank = [ENRICHERS["alexa"]]
    table = enrich.apply_enrichment(x.domain_table(), x.responses(), rank, moment(ENRICHED))
    return table.select("id", "attempts", "last_attempt")


@query("update_domains", "SELECT t.id, t.name, t.tld, r.score AS alexa_score FROM fx_table t LEFT JOIN fx_new_rank r ON r.id = t.id")
def update_domains(x: Inputs) -> DataFrame:
    """The stored table with answers from its log, before and after folding it."""
    path = scratch_path(x.spark, "domain")
    domain_table.append_domains(x.domain_table(), path)
    answers = enrich.latest_answers(x.responses(), [ENRICHERS["alexa"]])
    domain_table.append_changes(answers, path, "first", moment(ENRICHED))
    domain_table.fold_changes(x.spark, path)
    return domain_table.read_current(x.spark, path).select("id", "name", "tld", "alexa_score")


@query("update_domains_in_runs", "SELECT t.id, t.name, t.tld, r.score AS alexa_score FROM fx_table t LEFT JOIN fx_new_rank r ON r.id = t.id")
def update_domains_in_runs(x: Inputs) -> DataFrame:
    """The same through several runs, newest first, a repeated one, folds and the deletion of covered runs."""
    path = scratch_path(x.spark, "domain")
    domain_table.append_domains(x.domain_table(), path, buckets=16)
    late = F.col("seq") % 2 == 1
    for run, part in (("b", late), ("a", ~late), ("a", ~late)):
        answers = enrich.latest_answers(x.responses().where(part), [ENRICHERS["alexa"]])
        domain_table.append_changes(answers, path, run, moment(ENRICHED))
        domain_table.fold_changes(x.spark, path)
    domain_table.drop_covered(x.spark, path, datetime.now() + timedelta(days=1))
    return domain_table.read_current(x.spark, path).select("id", "name", "tld", "alexa_score")


@query("coverage_report", """
    SELECT registrar_id, count(*) AS domains, count(*) - count(alexa_score) AS no_rank,
           count(*) - count(has_wiki) AS no_wiki,
           count(*) - count(CASE WHEN registered IS NOT NULL AND expired IS NOT NULL THEN 1 END) AS no_dates
    FROM fx_enriched GROUP BY registrar_id""")
def coverage_report(x: Inputs) -> DataFrame:
    return enrich.coverage_report(x.enriched())


# Labels

# The affixes that the scores know, as patterns for the SQL side.
_PREFIX = "anti|de|dis|em|en|fore|il|im|in|inter|ir|mid|mis|non|over|pre|re|semi|sub|super|trans|un|under"
_SUFFIX = "able|al|ation|ative|ed|en|eous|er|es|est|ful|ial|ible|ic|ing|ion|ious|ition|itive|ity|ive|less|ly|ment|ness|ous|s|tion|y"


@query("lookup_words", "SELECT seq, name, name IN (SELECT word FROM fx_words) AS is_word FROM fx_norm")
def lookup_words(x: Inputs) -> DataFrame:
    return labels.lookup_words(x.norm().select("seq", "name"), x.words())


@query("brandable", f"SELECT name, tld, length(name) <= 6 OR name IN (SELECT word FROM fx_words) OR regexp_matches(name, '^({_PREFIX})') OR regexp_matches(name, '({_SUFFIX})$') AS brandable FROM fx_domain")
def brandable(x: Inputs) -> DataFrame:
    return labels.brandable(x.domains(), x.words()).select("name", "tld", "brandable")


@query("sibling_candidates", """
    SELECT name, tld, c AS candidate_tld FROM fx_domain,
           (VALUES ('site'), ('net'), ('org'), ('com'), ('gov'), ('io'), ('edu'), ('biz')) v(c)
    UNION SELECT name, tld, tld FROM fx_domain""")
def sibling_candidates(x: Inputs) -> DataFrame:
    return labels.sibling_candidates(x.domains())


_FLAGS = ", ".join(
    f"max(CASE WHEN r.tld = '{t}' THEN 1 ELSE 0 END) AS {t}" for t in labels.SIBLING_TLDS
)


@query("sibling_availability", f"""
    SELECT d.name, d.tld, {_FLAGS}, max(CASE WHEN r.tld = d.tld THEN r.created END) AS creation_date
    FROM fx_domain d LEFT JOIN fx_registry r ON r.name = d.name GROUP BY d.name, d.tld""")
def sibling_availability(x: Inputs) -> DataFrame:
    rows = stored(x.domains().select("name", "tld"), "domains")
    return labels.sibling_availability(rows, stored(x.registry(), "registry"))


_UNIQUE = """
    (SELECT d.name, d.tld, count(o.tld) AS others FROM fx_domain d
     LEFT JOIN fx_domain o ON o.name = d.name AND o.tld <> d.tld AND o.tld IN ('org', 'net', 'com')
     GROUP BY d.name, d.tld)"""


@query("label_uniqueness", f"SELECT name, tld, others, CASE WHEN others > 0 THEN 'no' ELSE 'yes' END AS \"unique\" FROM {_UNIQUE} u")
def label_uniqueness(x: Inputs) -> DataFrame:
    return labels.label_uniqueness(stored(x.domains().select("name", "tld"), "domains"))


@query("search_visibility", """
    SELECT d.name, d.tld, CASE WHEN EXISTS (SELECT 1 FROM fx_search s WHERE s.name = d.name AND s.tld = d.tld
           AND s.rank <= 100 AND s.host = concat(d.name, '.', d.tld)) THEN 'good' ELSE 'neutral' END AS search
    FROM fx_domain d""")
def search_visibility(x: Inputs) -> DataFrame:
    rows = x.domains().select("name", "tld")
    return labels.search_visibility(rows, x.search_results())
