"""Filtering URLs by rules and by the reputation of their hosts.

Pages with a known outcome are counted per host, registered domain and public suffix. Each level's
shares of good pages are taken as draws from beta distributions around the posterior mean of
the level above; how strongly they gather around it is estimated from the counts by moments (an empirical-Bayes
beta-binomial model). A host's posterior thus leans on its domain and suffix as far as its own
pages are few. A host is blocked if even the upper bound of its share lies below the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.llm.bounds import small
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Rules (verdict, host, path); a host rule holds for subdomains too, the longest that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Public suffixes of two labels; all others have one.
LONG_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "net.au", "ne.jp", "or.jp", "org.au", "org.uk")
#: A host is blocked when its share of good pages is below this ...
THRESHOLD = 0.5
#: ... even so many standard deviations above the posterior mean.
DEVIATIONS = 1.645
#: Bounds of the correlation between pages of one group that the strength of a prior is made of.
LEAST, MOST = 0.001, 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str = "url") -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; empty without."""
    found = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), _URL, 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), _URL, 2)


def suffix(name: str = "host", long: Sequence[str] = LONG_SUFFIXES) -> Column:
    """The public suffix of a host; empty for an empty host."""
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*long), two).otherwise(F.substring_index(name, ".", -1))


def registered_domain(name: str = "host", end: str = "suffix") -> Column:
    """The suffix and the label before it; the host itself if it has no such label."""
    return F.when(F.instr(F.col(end), ".") > 0, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def matched_rule(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct (verdict, rule) of the longest rule that fits ``host`` and ``path``, else null."""
    found = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(start)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, good): a labelled row speaks for the page of its id, which is good if of quality and not toxic.

    Several labels of an id must all be good; rows without a quality or an id don't count.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    return (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("page_id"))
        .agg(F.min(good.cast("int")).alias("good"))
    )


def _strength(groups: DataFrame) -> float:
    """The prior strength of groups (n, good, mean): pseudo-counts by the moments of their spread.

    With correlation r between pages of a group, the squared deviation of a group's good pages in
    units of its binomial variance is 1 + r * (n - 1) on average.
    """
    spread = F.pow(F.col("good") - F.col("n") * F.col("mean"), 2) / (F.col("n") * F.col("mean") * (1 - F.col("mean")))
    row = groups.where("n > 0").agg(F.sum(spread).alias("s"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    if not row["k"] or row["n"] <= row["k"]:
        return 1 / LEAST - 1
    r = min(MOST, max(LEAST, (row["s"] - row["k"]) / (row["n"] - row["k"])))
    return (1 - r) / r


def reputations(pages: DataFrame, known: DataFrame) -> DataFrame:
    """(host, n, good, mean, bound) for every host of ``pages`` (page_id, host); ``known``: (page_id, good).

    ``mean`` is the posterior mean of the share of good pages, ``bound`` its upper bound. Without any
    known page all hosts have mean 0.5 and a wide bound.
    """
    counted = pages.join(known, "page_id", "left").groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")
    )
    hosts = stored(
        counted.withColumn("suffix", suffix()).withColumn("domain", registered_domain()), "hosts"
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    root = ((total["good"] or 0) + 1) / ((total["n"] or 0) + 2)
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("mean", F.lit(root))
    suffixes = stored(_posterior(stored(suffixes, "suffixes"), "suffix_mean").select("suffix", "suffix_mean"), "suffixes")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = domains.join(suffixes, "suffix").withColumnRenamed("suffix_mean", "mean")
    domains = stored(_posterior(stored(domains, "domains"), "domain_mean").select("domain", "domain_mean"), "domains")
    return _posterior(
        stored(hosts.join(domains, "domain").withColumnRenamed("domain_mean", "mean"), "hosts"), "posterior"
    ).select("host", "n", "good", F.col("posterior").alias("mean"), "bound")


def _posterior(groups: DataFrame, name: str) -> DataFrame:
    """``groups`` with the posterior mean as ``name``, and ``bound``, from the prior mean ``mean``."""
    strength = F.lit(_strength(groups))
    seen = F.col("n") + strength
    mean = (F.col("good") + strength * F.col("mean")) / seen
    return groups.withColumn(name, mean).withColumn(
        "bound", F.least(F.lit(1.0), mean + F.lit(DEVIATIONS) * F.sqrt(mean * (1 - mean) / (seen + 1)))
    )


def judged(pages: DataFrame, known: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, mean, bound) for every row of ``pages`` (page_id, url).

    Null urls and those without ``://`` have an empty host and path, which is a host like any other.
    Rows without an id are judged like all others; other columns are not read. Rules are a
    short list.
    """
    rows = pages.select("page_id", host().alias("host"), path().alias("path"))
    known_hosts = small(stored(reputations(rows.select("page_id", "host"), known), "reputations"))
    return (
        rows.join(known_hosts, "host")
        .withColumn("found", matched_rule(rules))
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.when(F.col("bound") < THRESHOLD, "block").otherwise("allow")).alias("verdict"),
            F.round("mean", 6).alias("mean"),
            F.round("bound", 6).alias("bound"),
        )
    )


def _sql_level(name: str, source: str, keys: str) -> str:
    """The posterior of a level from (keys, n, good, mean) in ``source``."""
    return f"""
{name}_r AS (SELECT CASE WHEN count(*) = 0 OR sum(n) <= count(*) THEN {LEAST} ELSE
  least({MOST}, greatest({LEAST}, (sum((good - n * mean) ** 2 / (n * mean * (1 - mean))) - count(*)) / (sum(n) - count(*)))) END AS r
  FROM {source} WHERE n > 0),
{name} AS (SELECT {keys}, (good + (1 - r) / r * mean) / (n + (1 - r) / r) AS mean, n + (1 - r) / r AS seen FROM {source}, {name}_r)"""


_RULES_SQL = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
)
_TWO = ", ".join(f"'{x}'" for x in LONG_SUFFIXES)
SQL = rf"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
known AS (SELECT doc_id AS page_id, min((quality = 1 AND coalesce(toxic, 0) <> 1)::INT) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good, string_split(host, '.') AS l FROM p LEFT JOIN known USING (page_id) GROUP BY host),
ends AS (SELECT *, array_to_string(l[-2:], '.') AS two, CASE WHEN array_to_string(l[-2:], '.') IN ({_TWO}) THEN 2 ELSE 1 END AS k FROM counted),
hosts AS MATERIALIZED (SELECT host, n, good, array_to_string(l[-k:], '.') AS suffix, array_to_string(l[-(k + 1):], '.') AS domain FROM ends),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT (sum(good) + 1) / (sum(n) + 2) FROM hosts) AS mean FROM hosts GROUP BY suffix),
{_sql_level("s", "s0", "suffix")},
d0 AS (SELECT domain, sum(h.n) AS n, sum(h.good) AS good, any_value(s.mean) AS mean FROM hosts h JOIN s USING (suffix) GROUP BY domain),
{_sql_level("d", "d0", "domain")},
h0 AS (SELECT host, hosts.n, hosts.good, d.mean FROM hosts JOIN d USING (domain)),
{_sql_level("h", "h0", "host")},
bounded AS (SELECT host, mean, least(1.0, mean + {DEVIATIONS} * sqrt(mean * (1 - mean) / (seen + 1))) AS bound FROM h),
ruled AS (SELECT *, CASE {_RULES_SQL} END AS found FROM p JOIN bounded USING (host))
SELECT page_id, host, path, string_split(found, ' ')[2] AS rule,
  coalesce(string_split(found, ' ')[1], CASE WHEN bound < {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
  round(mean, 6) AS mean, round(bound, 6) AS bound
FROM ruled
"""


@query("op4_url_reputation", SQL)
def op4_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url, by the rules and the reputation of its host."""
    return judged(table(spark, folder, "pages").select("page_id", "url"), outcomes(table(spark, folder, "labels")))
