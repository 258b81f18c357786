"""Listing, response and registry inputs derived from the given tables.

The given tables hold no domain listings, so these stand-ins turn orders and
parts into listings, events into lookup responses and pages into hosts. They
are inputs only: what the operators compute from them is checked against SQL
that states the same inputs on its own (``views``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow.operators import dims, ingest, normalise
from lapseflow.operators.enrich import ENRICHERS, apply_enrichment
from lapseflow.session import scratch_path, stored

# Listings that ended before this day make up the table as it stood before the load.
KNOWN_BEFORE = "1996-01-01 00:00:00"
LOADED = "1999-01-01 00:00:00"
ENRICHED = "1999-02-01 00:00:00"
AS_OF = "1998-07-01 00:00:00"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}

    def landed(self, label: str, write: Callable[[str], None]) -> str:
        """The path of files that are written once and then read by any number of queries."""
        if label not in self._paths:
            path = scratch_path(self.spark, label)
            write(path)
            self._paths[label] = path
        return self._paths[label]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # Listings

    def listings_of(self, orders: DataFrame) -> DataFrame:
        """Raw listings: mixed case, two-part tails, undotted names, hyphens, digits, repeats."""
        name, cust, key = F.col("p_name"), F.col("o_custkey"), F.col("o_orderkey")
        label = (
            F.when(cust % 3 == 0, F.replace(name, F.lit(" "), F.lit("-")))
            .when(
                cust % 3 == 1,
                F.concat(F.replace(name, F.lit(" "), F.lit("")), cust.cast("string")),
            )
            .otherwise(F.split_part(name, F.lit(" "), F.lit(1)))
        )
        tails = (".com", ".net", ".org", ".io", ".COM", ".co.uk", "", ".site")
        suffix = F.element_at(F.array(*[F.lit(t) for t in tails]), (key % 8 + 1).cast("int"))
        return orders.join(self.table("part"), F.col("p_partkey") == cust).select(
            key.alias("seq"),
            F.when(key % 2 == 0, "GoDaddy").otherwise("sedo").alias("registrar"),
            F.concat(label, suffix).alias("domain_name"),
            F.col("o_orderdate").alias("auction_end"),
            F.col("o_totalprice").alias("price"),
        )

    def listing(self) -> DataFrame:
        return self.listings_of(self.table("orders"))

    def attributes(self) -> DataFrame:
        """Attribute text of each listing, as the auction feed writes it."""
        orders = self.table("orders")
        key, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")
        dollars = F.concat(
            F.lit("$"),
            F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string"),
            F.lit(","),
            F.lpad((price % 1000).cast("string"), 3, "0"),
        )
        return orders.select(
            key.alias("seq"),
            dollars.alias("price"),
            F.when(key % 3 == 0, "True").when(key % 3 == 1, "False").alias("isAdult"),
            F.when(key % 5 == 0, "n/a")
            .otherwise((F.col("o_custkey") % 30).cast("string"))
            .alias("domainAge"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("auctionEndTime"),
        )

    def norm(self) -> DataFrame:
        rows = normalise.split_domain(normalise.accepted(self.listing()))
        return normalise.lower_keys(rows).drop("domain_name")

    def staged(self) -> DataFrame:
        """All listings in the contract's columns, staged once as a load does it."""
        if "staged" not in self._stored:
            rows = normalise.to_contract(
                self.listing(), "domain_name", keep=("auction_end", "price")
            )
            self._stored["staged"] = stored(rows, "staged")
        return self._stored["staged"]

    def domains(self) -> DataFrame:
        """First listing of each domain: name, tld, seq, registrar."""
        return ingest.first_wins(self.staged().select("seq", "name", "tld", "registrar"))

    def registry(self) -> DataFrame:
        """Which names are registered, and since when."""
        return self.staged().groupBy("name", "tld").agg(F.min("auction_end").alias("created"))

    def dated(self) -> DataFrame:
        """Domains with registration and expiry dates."""
        year = F.make_dt_interval(days=F.lit(365))
        return self.domains().join(
            self.registry().select(
                "name",
                "tld",
                F.col("created").alias("registered"),
                (F.col("created") + year).alias("expired"),
            ),
            ["name", "tld"],
        )

    def search_results(self) -> DataFrame:
        """Where each domain's own name turns up in a search."""
        own = F.concat_ws(".", "name", "tld")
        return self.domains().select(
            "name",
            "tld",
            (F.col("seq") % 150 + 1).cast("int").alias("rank"),
            F.when(F.col("seq") % 4 == 0, own).otherwise("other.example.com").alias("host"),
        )

    # Dimensions and the domain table

    def dim(self, column: str) -> DataFrame:
        """A dimension grown from all listings, stored as one is between loads."""
        if column not in self._stored:
            none = dims.empty_dimension(self.spark)
            grown = dims.grow_dimension(none, self.staged(), column, moment(LOADED))
            self._stored[column] = stored(grown, f"{column}-dim")
        return self._stored[column]

    def tld_dim(self) -> DataFrame:
        return self.dim("tld")

    def registrar_dim(self) -> DataFrame:
        return self.dim("registrar")

    def domain_table(self) -> DataFrame:
        """The domain table right after loading, each row dated by its first listing, landed once."""
        if "domain" not in self._stored:
            rows = ingest.insert_new_domains(
                self.staged().drop("price"),
                ingest.empty_domains(self.spark),
                self.tld_dim(),
                self.registrar_dim(),
                F.col("auction_end"),
            )
            self._stored["domain"] = stored(rows, "domain")
        return self._stored["domain"]

    # Pages

    def page_hosts(self) -> DataFrame:
        host = F.lower(F.regexp_extract("url", "^https?://([^/:?#]+)", 1))
        return self.table("pages").select("page_id", host.alias("host"))

    def words(self) -> DataFrame:
        first = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
        return self.table("part").select(first.alias("word")).distinct()

    # Landed responses

    def bodies(self) -> DataFrame:
        return self.bodies_of(self.table("events"))

    def bodies_of(self, events: DataFrame) -> DataFrame:
        """Each event as the four kinds of response body."""
        kind, user = F.col("event_type"), F.col("user_id")

        def dated(shift: int) -> Column:
            year = F.lpad((user % 20 + shift).cast("string"), 2, "0")
            return F.concat(F.lit("20"), year, F.lit("-03-15 00:00:00"))

        d, x = dated(0), dated(5)
        rank = F.concat(
            F.lit('<REACH RANK="'), user.cast("string"), F.lit('"/><COUNTRY RANK="3"/>')
        )
        listed = F.concat(
            F.lit('{"creation_date":["'), d, F.lit('","1990-01-01 00:00:00"],"expiration_date":["'),
            x, F.lit('"]}'),
        )
        scalar = F.concat(
            F.lit('{"creation_date":"'), d, F.lit('","expiration_date":"'), x, F.lit('"}')
        )
        captures = F.concat(
            F.lit('[["statuscode"]'), F.repeat(F.lit(',["200"]'), (user % 5).cast("int")), F.lit("]")
        )
        return events.select(
            F.col("event_id").alias("seq"),
            F.col("ts").alias("fetched_at"),
            F.when(kind == "view", "<ALEXA/>").when(kind != "error", rank).alias("alexa"),
            F.when(kind == "error", "oops")
            .when(kind == "click", '["q",["a","b"],[],[]]')
            .otherwise('["q",[],[],[]]')
            .alias("wiki"),
            F.when(kind == "error", "[]").otherwise(captures).alias("archive"),
            F.when(kind == "click", listed)
            .when(kind == "view", scalar)
            .when(kind == "signup", '{"creation_date":null,"expiration_date":null}')
            .when(kind != "error", '{"creation_date":[],"expiration_date":[]}')
            .alias("whois"),
        )

    def responses_of(self, bodies: DataFrame) -> DataFrame:
        """Landed responses: every source's answer for the domain listed under ``seq``."""
        sources = F.array(
            *[
                F.struct(F.lit(s).alias("source"), F.col(s).alias("body"))
                for s in ("alexa", "wiki", "whois")
            ]
        )
        answers = bodies.select("seq", "fetched_at", F.inline(sources))
        names = self.staged().select("seq", F.concat_ws(".", "name", "tld").alias("domain"))
        failed = (F.col("source") == "alexa") & F.col("body").isNull()
        return answers.join(names, "seq").select(
            "domain", "source", "body", "fetched_at", F.when(failed, "timeout").alias("error"), "seq"
        )

    def responses(self) -> DataFrame:
        """All responses, landed once."""
        if "responses" not in self._stored:
            self._stored["responses"] = stored(self.responses_of(self.bodies()), "responses")
        return self._stored["responses"]

    def enriched(self) -> DataFrame:
        """The domain table after one round of each lookup."""
        sources = list(ENRICHERS.values())
        return apply_enrichment(
            self.domain_table(), self.responses(), sources, moment(ENRICHED)
        )
