"""Backlogs, parsed lookup responses and their bulk application."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapseflow import schemas
from lapseflow.functions import names, responses
from lapseflow.operators.ingest import DOMAIN_KEY
from lapseflow.operators.joins import is_small
from lapseflow.session import stored

BACKLOG_SIZE = 500


@dataclass(frozen=True)
class Enricher:
    """One kind of lookup, as DataFrame-in, DataFrame-out steps.

    ``missing`` are the columns whose NULL puts a domain on the backlog and
    ``columns`` the ones an answer sets. ``result`` reads a body into the value
    of the column, or a struct when there are several; NULL means not usable.
    """

    source: str
    missing: tuple[str, ...]
    columns: tuple[str, ...]
    result: Callable[[Column], Column]

    def pending(self, domains: DataFrame) -> DataFrame:
        return unenriched(domains, self.missing)

    def backlog(self, domains: DataFrame, size: int = BACKLOG_SIZE) -> DataFrame:
        return backlog(domains, self.missing, size)

    def parse(self, landed: DataFrame) -> DataFrame:
        """This source's responses with their domain's key and parsed ``_result``."""
        own = landed.where(F.col("source") == self.source)
        return own.select(
            *_domain_key(), "fetched_at", "seq", self.answer().alias("_result")
        )

    def value(self, answer: Column, column: str) -> Column:
        return answer if len(self.columns) == 1 else answer[column]

    def answer(self) -> Column:
        """The parsed body of a row of this source, NULL for any other or failed one."""
        mine = (F.col("source") == self.source) & F.col("error").isNull()
        return F.when(mine, self.result(F.col("body")))

    def updates(self, landed: DataFrame) -> DataFrame:
        """The usable answers only: a failed lookup changes nothing."""
        values = [self.value(F.col("_result"), c).alias(c) for c in self.columns]
        usable = self.parse(landed).where("_result IS NOT NULL")
        return usable.select(*DOMAIN_KEY, "fetched_at", "seq", *values)


def _domain_key() -> list[Column]:
    domain = F.lower("domain")
    return [names.first_label(domain).alias("name"), names.tail(domain).alias("tld")]


RANK = Enricher("alexa", ("alexa_score",), ("alexa_score",), responses.rank)
WIKI = Enricher("wiki", ("has_wiki",), ("has_wiki",), responses.has_titles)
REGISTRY = Enricher(
    "whois", ("registered", "expired"), ("registered", "expired"), responses.registry_dates
)
ENRICHERS = {e.source: e for e in (RANK, WIKI, REGISTRY)}


def unenriched(domains: DataFrame, missing: Sequence[str]) -> DataFrame:
    """Domains that lack any of the columns; NULL means "not looked up yet"."""
    return domains.where(" OR ".join(f"{c} IS NULL" for c in missing))


def backlog(domains: DataFrame, missing: Sequence[str], size: int = BACKLOG_SIZE) -> DataFrame:
    """The longest-untouched domains that still need a lookup.

    A failed attempt counts as a touch, so a domain that always fails moves to
    the back instead of blocking the head.
    """
    touched = F.greatest("updated_at", "last_attempt")
    return (
        unenriched(domains, missing)
        .select("id", "name", "tld", touched.alias("touched_at"))
        .orderBy(F.col("touched_at").asc_nulls_last(), "id")
        .limit(size)
    )


def latest_answers(landed: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """One row per domain: each source's latest usable answer with its time, and the failed lookups.

    One pass over the landed responses for all sources. The latest fetch wins,
    then the highest ``seq``; a maximum over structs, so each map task sends
    one row per domain however many responses a domain has. Such rows of several
    batches can be merged in any order (:func:`merge_answers`).
    """
    own = landed.where(F.col("source").isin([e.source for e in enrichers]))
    parsed = own.select(
        *_domain_key(), "fetched_at", "seq", *[e.answer().alias(e.source) for e in enrichers]
    )

    def latest(source: str) -> Column:
        answer = F.struct("fetched_at", "seq", F.col(source).alias("answer"))
        return F.max(F.when(F.col(source).isNotNull(), answer)).alias(source)

    usable = reduce(or_, (F.col(e.source).isNotNull() for e in enrichers))
    return parsed.groupBy(*DOMAIN_KEY).agg(
        *[latest(e.source) for e in enrichers], F.count_if(~usable).cast("int").alias("failed")
    )


def dated_answers(answers: DataFrame, as_of: Column) -> DataFrame:
    """Answers in the layout of the change log, with the time at which they came in."""
    layout = T.StructType.fromDDL(schemas.CHANGE)
    sources = [s for s in ENRICHERS if s in answers.columns]
    answered = reduce(or_, (F.col(s).isNotNull() for s in sources))
    dated = answers.withColumns(
        {"answered_at": F.when(answered, as_of), "failed_at": F.when(F.col("failed") > 0, as_of)}
    )
    return dated.select(
        [(F.col(f.name) if f.name in dated.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout]
    )


def merge_answers(changes: DataFrame) -> DataFrame:
    """Dated answers of any number of runs as one row per domain; the newest fetch of a source wins."""
    latest = [F.max(c).alias(c) for c in (*ENRICHERS, "answered_at", "failed_at")]
    return changes.groupBy(*DOMAIN_KEY).agg(F.sum("failed").cast("int").alias("failed"), *latest)


def apply_answers(domains: DataFrame, merged: DataFrame, measured: bool = True) -> DataFrame:
    """Overwrite the columns of every answered domain, with NULLs too.

    ``merged``: dated answers, one row per domain. Everything else stays as it is.
    An answer touches ``updated_at``; a failed lookup only counts as an attempt.
    Answers ``measured`` as small are broadcast and the table stays where it is; tables bucketed alike
    need no measuring. The key is unique on both sides, so no key can be hot.
    """
    new = {}
    for e in ENRICHERS.values():
        given = F.col(f"_answers.{e.source}")
        for c in e.columns:
            new[c] = F.when(given.isNotNull(), e.value(given["answer"], c)).otherwise(F.col(c))
    new["updated_at"] = F.coalesce("_answers.answered_at", "updated_at")
    new["attempts"] = F.coalesce("attempts", F.lit(0)) + F.coalesce("_answers.failed", F.lit(0))
    new["last_attempt"] = F.coalesce("_answers.failed_at", "last_attempt")
    rest = [c for c in merged.columns if c not in DOMAIN_KEY]
    packed = merged.select(*DOMAIN_KEY, F.struct(*rest).alias("_answers"))
    lookup = F.broadcast(packed) if measured and is_small(packed) else packed
    return domains.join(lookup, list(DOMAIN_KEY), "left").select(
        *[new[c].alias(c) if c in new else F.col(c) for c in domains.columns]
    )


def apply_enrichment(
    domains: DataFrame, landed: DataFrame, enrichers: Sequence[Enricher], as_of: Column
) -> DataFrame:
    """Bring all landed responses of any of the sources into the domain table."""
    answers = dated_answers(latest_answers(landed, enrichers), as_of)
    return apply_answers(domains, stored(answers, "answers"))


def response_counts(landed: DataFrame, enrichers: Sequence[Enricher]) -> DataFrame:
    """Responses, usable answers and failures by source, in one pass over the landed rows."""
    own = landed.where(F.col("source").isin([e.source for e in enrichers]))
    usable = reduce(or_, (e.answer().isNotNull() for e in enrichers))
    return (
        own.select("source", usable.alias("usable"))
        .groupBy("source")
        .agg(
            F.count("source").alias("responses"),
            F.count_if("usable").alias("answers"),
            F.count_if(~F.col("usable")).alias("failures"),
        )
    )


def coverage_report(domains: DataFrame, by: str = "registrar_id") -> DataFrame:
    """How much of the table still lacks each enrichment, by registrar."""
    return domains.groupBy(by).agg(
        F.count("id").alias("domains"),
        F.count_if(F.col("alexa_score").isNull()).alias("no_rank"),
        F.count_if(F.col("has_wiki").isNull()).alias("no_wiki"),
        F.count_if(F.col("registered").isNull() | F.col("expired").isNull()).alias("no_dates"),
    )
