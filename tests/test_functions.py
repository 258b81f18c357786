"""Literal expectations of the column expressions."""

from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapseflow.functions import names, responses, scoring, text, values


def column(spark, rows, expression, kind="string"):
    """Evaluate an expression of column ``v`` over the given values, in order."""
    df = spark.createDataFrame(list(enumerate(rows)), f"i INT, v {kind}")
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


V = F.col("v")


def test_split(spark):
    rows = ["a.com", "a.co.uk", "A-1.Org", "plain", "", ".com", "a.", None]
    assert column(spark, rows, names.first_label(V)) == ["a", "a", "A-1", "plain", "", "", "a", None]
    assert column(spark, rows, names.tail(V)) == ["com", "co.uk", "Org", "", "", "com", "", None]
    assert column(spark, rows, names.second_label(V))[:4] == ["com", "co", "Org", ""]
    # A name or a tld without letters can't be a domain.
    reasons = column(spark, rows, names.reject_reason(V))
    assert reasons == [None, None, None, "no_dot", "empty", "no_name", "no_tld", "empty"]


def test_uuid_equals_the_standard_library(spark):
    rows = ["google.com", "Bücher.DE", "a-b.co.uk", "日本.jp", "x1.io", "Q.COM"]
    got = column(spark, rows, names.domain_uuid(names.first_label(V), names.tail(V)))
    assert got == [str(uuid.uuid3(uuid.NAMESPACE_URL, r.lower())) for r in rows]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.from_regex(r"[a-z0-9-]{1,20}\.[a-z]{2,6}", fullmatch=True), min_size=20, max_size=40))
def test_uuid_property(spark, rows):
    got = column(spark, rows, names.domain_uuid(names.first_label(V), names.tail(V)))
    assert got == [str(uuid.uuid3(uuid.NAMESPACE_URL, r)) for r in rows]


def test_listing_files(spark):
    rows = ["all_listings.json.zip", "all_listings_2.json.zip", "other.zip", "all_listings2.zip"]
    assert column(spark, rows, names.is_listing_file(V)) == [True, False, False, True]


def test_label_shape(spark):
    rows = ["xn--bcher-kva", "XN--A", "a1", "plain"]
    assert column(spark, rows, names.is_idn(V)) == [True, True, False, False]
    assert column(spark, rows, names.has_hyphen(V)) == [True, True, False, False]
    assert column(spark, rows, names.has_digits(V)) == [False, False, True, False]


def test_values(spark):
    assert column(spark, ["$1,200", "$5.50", "n/a", None], values.money(V)) == [
        Decimal("1200.00"), Decimal("5.50"), None, None,
    ]
    assert column(spark, ["True", "true", "False", None], values.true_flag(V)) == [
        True, False, False, False,
    ]
    assert column(spark, ["7", "n/a", "", None], values.nullable_int(V)) == [7, None, None, None]
    assert column(spark, ["2021-02-04T10:00:00Z", "soon"], values.zulu_time(V)) == [
        datetime(2021, 2, 4, 10), None,
    ]


def test_placeholder_dates(spark):
    rows = ["01/01/1970 00:00:00", "02/04/2021 10:00:00", "bad", None]
    known = [None, datetime(2021, 2, 4, 10), None, None]
    assert column(spark, rows, values.known_date(V)) == known
    assert column(spark, [0, 86400, None], values.known_epoch(V), "BIGINT") == [
        None, datetime(1970, 1, 2), None,
    ]
    back = values.staged_date_text(values.known_date(V))
    assert column(spark, rows, back)[:2] == rows[:2]


def test_rank(spark):
    rows = ['x RANK="1" RANK="7"', "<none/>", 'RANK="12345"', "", None]
    assert column(spark, rows, responses.rank(V)) == [1, 0, 12345, 0, None]


def test_titles(spark):
    rows = ['["q",["a","b","c","d"],[],[]]', '["q",[],[],[]]', "oops", '{"a":1}', None]
    assert column(spark, rows, responses.title_count(V)) == [4, 0, None, None, None]
    assert column(spark, rows, responses.has_titles(V)) == [True, False, None, None, None]


def test_captures(spark):
    body = "[" + ",".join(['["statuscode"]'] + ['["200"]'] * 127) + "]"
    assert column(spark, [body, "[]"], responses.capture_count(V)) == [127, 0]


def test_registry_dates(spark):
    one = '"2003-03-15 00:00:00"'
    rows = [
        f'{{"creation_date":{one},"expiration_date":[{one},"1990-01-01 00:00:00"]}}',
        '{"creation_date":null,"expiration_date":null}',
        f'{{"creation_date":[],"expiration_date":{one}}}',
        f'{{"creation_date":{one},"expiration_date":[]}}',
        "{}",
        "oops",
        None,
    ]
    got = column(spark, rows, responses.registry_dates(V))
    day = datetime(2003, 3, 15)
    assert [tuple(g) if g else g for g in got] == [
        (day, day), (None, None), None, None, None, None, None,
    ]


def test_brandable(spark):
    rows = ["google", "sdkfasdsdadafkgajlqwe", "underxxxxxxx", "xxxxxxxness", "Underxxxxxxx"]
    got = column(spark, rows, scoring.brandable(V, F.lit(False)))
    assert got == [True, False, True, True, False]
    assert column(spark, rows[1:2], scoring.brandable(V, F.lit(True))) == [True]


def test_age(spark):
    born = V.cast("timestamp_ntz")
    as_of = F.lit("2021-03-01 00:00:00").cast("timestamp_ntz")
    rows = ["2020-02-29 00:00:00", "2020-03-01 00:00:00", "2020-03-02 00:00:00", "2022-01-01 00:00:00"]
    assert column(spark, rows, scoring.age_years(born, as_of)) == [1, 1, 0, -1]
    assert column(spark, rows[1:2], scoring.age_days(born, as_of)) == [365]


def test_sale_stage(spark):
    as_of = F.lit("2021-06-01 12:00:00").cast("timestamp_ntz")
    expired = V.cast("timestamp_ntz")
    rows = ["2021-07-01", "2021-05-01", "2021-03-03 12:00:00", "2021-03-03 12:00:01", None]
    first = column(spark, rows, scoring.sale_stage(expired, F.lit("godaddy"), as_of))
    assert first == ["listed", "grace", "sellable", "grace", "listed"]
    second = column(spark, rows[:3], scoring.sale_stage(expired, F.lit("sedo"), as_of))
    assert second == ["listed", "waiting", "sellable"]
    assert column(spark, rows[1:2], scoring.availability_text(expired, F.lit("godaddy"))) == ["July/30"]
    assert column(spark, rows[1:2], scoring.availability_text(expired, F.lit("other"))) == [None]


def test_trigram_example(spark):
    both = text.overlap(text.trigrams(V), text.trigrams(F.lit("tacos")))
    got = column(spark, ["tacojohns", "google", "tacos"], both)
    assert [round(g, 4) for g in got] == [0.3333, 0.0, 1.0]


def test_link(spark):
    assert column(spark, ["a.csv"], text.html_link(V, "https://files.example.org/")) == [
        '<a href="https://files.example.org/a.csv">a.csv</a>'
    ]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2020-01-01T00:00:00+05:00", datetime(2019, 12, 31, 19)),
        ("2020-01-01 10:30:00-0230", datetime(2020, 1, 1, 13)),
        ("2020-01-01T00:00:00Z", datetime(2020, 1, 1)),
        ("2020-01-01 00:00:00", datetime(2020, 1, 1)),
        ("2020-01-01", datetime(2020, 1, 1)),
        ("soon", None),
        (None, None),
    ],
)
def test_times_become_utc(spark, text, want):
    df = spark.createDataFrame([(text,)], "t STRING")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.select(responses.utc_time(F.col("t"))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rank_beyond_int_is_no_answer(spark):
    bodies = [('RANK="7"',), ('RANK="99999999999"',), ("none",), (None,)]
    got = spark.createDataFrame(bodies, "b STRING").select(responses.rank(F.col("b"))).collect()
    assert [r[0] for r in got] == [7, None, 0, None]
