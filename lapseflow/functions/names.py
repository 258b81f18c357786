"""Column expressions over domain names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of version-3 UUIDs.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def first_label(domain: Column) -> Column:
    return F.substring_index(domain, ".", 1)


def tail(domain: Column) -> Column:
    """Everything after the first dot; empty when there is none."""
    return F.substr(domain, F.length(first_label(domain)) + 2)


def second_label(domain: Column) -> Column:
    return F.split_part(domain, F.lit("."), F.lit(2))


def qualified(name: Column, tld: Column) -> Column:
    return F.concat(name, F.lit("."), tld)


def reject_reason(domain: Column) -> Column:
    """Why a raw name cannot be split, or NULL when it can."""
    return (
        F.when(F.coalesce(domain, F.lit("")) == "", F.lit("empty"))
        .when(~domain.contains("."), F.lit("no_dot"))
        .when(domain.startswith("."), F.lit("no_name"))
        .when(tail(domain) == "", F.lit("no_tld"))
    )


def domain_uuid(name: Column, tld: Column) -> Column:
    """Version-3 UUID of the lower-cased ``name.tld`` in the URL namespace."""
    text = F.lower(qualified(name, tld))
    digest = F.md5(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(text, "UTF-8")))
    # The variant digit keeps its two low bits and sets the two high ones to binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-3"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def is_idn(label: Column) -> Column:
    return F.lower(label).startswith("xn--")


def has_hyphen(label: Column) -> Column:
    return label.contains("-")


def has_digits(label: Column) -> Column:
    return label.rlike("[0-9]")


def is_listing_file(file_name: Column) -> Column:
    """The full listing files, not the partial ones that carry a further suffix."""
    return file_name.startswith("all_listings") & ~file_name.startswith("all_listings_")
