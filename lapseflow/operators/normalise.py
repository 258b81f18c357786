"""From raw listing rows to the contract every feed is loaded through."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow import schemas
from lapseflow.functions import names, values
from lapseflow.session import stored

CONTRACT = ("seq", "name", "tld", "registrar", "expired", "registered")


@dataclass(frozen=True)
class Feed:
    """A listing source: its registrar, how it is read, and where its domain name stands."""

    registrar: str
    read: Callable[..., DataFrame]
    domain: str

    def load(self, spark: SparkSession, path: str, seq: int = 0) -> DataFrame:
        """All rows of the feed in the contract. ``seq`` is the feed's turn in a load.

        Rows of one feed differ in nothing but their domain, so which copy of a
        domain is kept does not matter within a feed.
        """
        rows = self.read(spark, path).withColumn("seq", F.lit(seq).cast("bigint"))
        return to_contract(rows, self.domain, registrar=F.lit(self.registrar))

    def rejects(self, spark: SparkSession, path: str, seq: int = 0) -> DataFrame:
        """The rows that :meth:`load` leaves out, as ``seq``, ``registrar``, ``domain`` and ``reason``."""
        rows = self.read(spark, path).withColumn("seq", F.lit(seq).cast("bigint"))
        return reject_rows(rows, self.domain, F.lit(self.registrar))

    def load_all(self, spark: SparkSession, path: str, rejected: str, seq: int = 0) -> DataFrame:
        """As :meth:`load`, with the rejects written to the table ``rejected``; the files are read once."""
        rows = stored(self.read(spark, path).withColumn("seq", F.lit(seq).cast("bigint")), "feed")
        reject_rows(rows, self.domain, F.lit(self.registrar)).write.mode("append").parquet(rejected)
        return to_contract(rows, self.domain, registrar=F.lit(self.registrar))


def split_domain(df: DataFrame, column: str = "domain_name", mode: str = "tail") -> DataFrame:
    """Add ``name`` (first label) and ``tld`` (the tail, or the second label only)."""
    domain = F.col(column)
    if mode not in ("tail", "second"):
        raise ValueError(f"unknown mode {mode!r}")
    tld = names.tail(domain) if mode == "tail" else names.second_label(domain)
    return df.withColumns({"name": names.first_label(domain), "tld": tld})


def accepted(df: DataFrame, column: str = "domain_name") -> DataFrame:
    """The rows that can be split into a name and a tld; plain text tests that reach the scan."""
    domain = F.col(column)
    return df.where(domain.contains(".") & ~domain.startswith(".") & (names.tail(domain) != ""))


def rejects(df: DataFrame, column: str = "domain_name") -> DataFrame:
    """The rows that cannot be split, each with its reason: all that :func:`accepted` leaves out."""
    reasoned = df.withColumn("reason", names.reject_reason(F.col(column)))
    return reasoned.where("reason IS NOT NULL")


def tag_registrar(df: DataFrame, registrar: str) -> DataFrame:
    return df.withColumn("registrar", F.lit(registrar))


def lower_keys(df: DataFrame, columns: Sequence[str] = ("name", "tld", "registrar")) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in columns})


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_market_columns(df: DataFrame) -> DataFrame:
    """The marketplace file's titles to internal names; its link column goes."""
    return df.withColumnsRenamed(schemas.MARKET_COLUMNS).drop(*schemas.MARKET_EXTRA)


def keep_auction_keys(df: DataFrame) -> DataFrame:
    """The two keys the small detail table needs; the scan reads nothing else."""
    return df.select("domainName", "auctionEndTime")


def type_auction_attributes(df: DataFrame) -> DataFrame:
    """Text attributes of the auction feed as typed columns."""
    typed = {
        "price": values.money(F.col("price")),
        "valuation": values.money(F.col("valuation")),
        "monthlyParkingRevenue": values.money(F.col("monthlyParkingRevenue")),
        "domainAge": values.nullable_int(F.col("domainAge")),
        "isAdult": values.true_flag(F.col("isAdult")),
        "auctionEndTime": values.zulu_time(F.col("auctionEndTime")),
    }
    return df.withColumns({c: e for c, e in typed.items() if c in df.columns})


def type_market_attributes(df: DataFrame) -> DataFrame:
    """Text attributes of the marketplace feed, already renamed, as typed columns."""
    moments = {c: F.col(c).try_cast("timestamp_ntz") for c in ("start_time", "end_time")}
    flags = {
        c: F.col(c).try_cast("boolean")
        for c in ("domain_is_idn", "domain_has_hyphen", "domain_has_numbers")
    }
    numbers = {c: values.nullable_int(F.col(c)) for c in ("domain_length", "traffic")}
    price = {"reserve_price": values.money(F.col("reserve_price"))}
    return df.withColumns(moments | flags | numbers | price)


def label_shape(df: DataFrame, column: str = "name") -> DataFrame:
    label = F.col(column)
    return df.withColumns(
        {
            "domain_is_idn": names.is_idn(label),
            "domain_has_hyphen": names.has_hyphen(label),
            "domain_has_numbers": names.has_digits(label),
            "domain_length": F.length(label),
        }
    )


def to_contract(
    df: DataFrame,
    domain: str,
    registrar: Column | None = None,
    expired: Column | None = None,
    registered: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split, fold and project one feed; unknown dates stay NULL for the registry lookup."""
    no_date = F.lit(None).cast("timestamp_ntz")
    named = df.withColumnRenamed(domain, "_domain")
    split = split_domain(accepted(named, "_domain"), "_domain")
    return lower_keys(
        split.select(
            "seq",
            "name",
            "tld",
            (F.col("registrar") if registrar is None else registrar).alias("registrar"),
            (no_date if expired is None else expired).alias("expired"),
            (no_date if registered is None else registered).alias("registered"),
            *keep,
        )
    )


def reject_rows(df: DataFrame, domain: str, registrar: Column | None = None) -> DataFrame:
    """What :func:`to_contract` leaves out, with its reason."""
    bad = rejects(df, domain)
    return bad.select(
        "seq",
        F.lower(F.col("registrar") if registrar is None else registrar).alias("registrar"),
        F.col(domain).alias("domain"),
        "reason",
    )


def from_staged(df: DataFrame, seq: int = 0) -> DataFrame:
    """Staged batch rows (text dates, epoch for unknown) to the contract; ``seq`` is the batch's turn."""
    return lower_keys(
        df.select(
            F.lit(seq).cast("bigint").alias("seq"),
            "name",
            "tld",
            "registrar",
            values.known_date(F.col("expired")).alias("expired"),
            values.known_date(F.col("registered")).alias("registered"),
        )
    )


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All feeds as one bag of rows."""
    return reduce(DataFrame.unionByName, feeds)
