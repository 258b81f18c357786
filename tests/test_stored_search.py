"""The stored index and the stored order against the scans they stand for."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lapseflow.operators import search, search_index, stored_pages

COLUMNS = ("term", "name", "similarity", "distance", "position")


def made(seed: int, n: int, letters: str = "abcde", most: int = 8) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices(letters, k=pick.randrange(1, most))) for _ in range(n)]


def rows(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(x,) for x in [*made(1, 400), *made(2, 40, "ABä-x1"), "Tacojohns", "", None, "aaaa", "aaaaaaaa"]], "name STRING")


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.55, 1.0])
def test_equals_the_scan_of_all_names(spark, labels, tmp_path, threshold):
    path = str(tmp_path / "index")
    search_index.build_index(labels, path, parts=7)
    terms = [*made(3, 25), "TACOS", "aaaa", "a", "zzzz", "ä-"]
    got = search_index.search_index(spark, path, spark.createDataFrame([(t,) for t in [*terms, None, "tacos"]], "term STRING"), 5, threshold)
    assert rows(got) == rows(search.term_search(labels.where("name IS NOT NULL"), sorted({t.lower() for t in terms}), 5, threshold))


def test_a_thousand_terms_take_one_plan(spark, labels, tmp_path):
    path = str(tmp_path / "index")
    search_index.build_index(labels, path)
    few, many = (spark.createDataFrame([(t,) for t in made(4, n)], "term STRING") for n in (2, 1000))
    plans = [search_index.search_index(spark, path, t)._jdf.queryExecution().executedPlan().toString() for t in (few, many)]
    assert len(plans[1].splitlines()) <= len(plans[0].splitlines()) and "Python" not in plans[1] and "NestedLoop" not in plans[1]
    assert search_index.search_index(spark, path, many).count() > 1000


def test_terms_read_their_postings_only(spark, labels, tmp_path):
    path = str(tmp_path / "index")
    search_index.build_index(labels, path, parts=64)
    asked = search_index._asked(spark, path, spark.createDataFrame([("tacojohns",)], "term STRING"), 0.6).collect()
    # Ten triples, of which six must be shared: one of the five rarest is.
    assert len(asked) == 5
    plan = search_index.candidates(spark, path, spark.createDataFrame([("tacojohns",)], "term STRING"), 0.6)._jdf.queryExecution().executedPlan().toString()
    assert len(plan.split("PartitionFilters: [part")[1].split("IN (")[1].split(")")[0].split(",")) <= 5


def test_common_triples_are_left_out(spark, tmp_path):
    path = str(tmp_path / "index")
    search_index.build_index(spark.createDataFrame([(f"the{i}",) for i in range(200)] + [("theatre",)], "name STRING"), path)
    asked = {r.gram for r in search_index._asked(spark, path, spark.createDataFrame([("theatre",)], "term STRING"), 0.5).collect()}
    assert "  t" not in asked and "the" not in asked
    hits = search_index.search_index(spark, path, spark.createDataFrame([("theatre",)], "term STRING"), threshold=0.5)
    assert [r.name for r in hits.collect()] == ["theatre"]


def test_empty_index_and_no_terms(spark, labels, tmp_path):
    search_index.build_index(labels.limit(0), str(tmp_path / "none"))
    terms = spark.createDataFrame([("a",)], "term STRING")
    assert search_index.search_index(spark, str(tmp_path / "none"), terms).count() == 0
    search_index.build_index(labels, str(tmp_path / "some"))
    assert search_index.search_index(spark, str(tmp_path / "some"), terms.limit(0)).count() == 0
    with pytest.raises(ValueError):
        search_index.search_index(spark, str(tmp_path / "some"), terms, threshold=0)


@pytest.fixture(scope="module")
def order(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("order") / "rows")
    # A third of the rows bear one key, some none.
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.md5(F.col("id").cast("string")))
    df = spark.range(30_000).select(key.alias("domain_name"), "id")
    stored_pages.store_order(df, path, ranges=32)
    return df, path


@pytest.mark.parametrize("number", [1, 2, 60, 250, 293, 294, 295, 100_000])
def test_pages_equal_sorting(spark, order, number):
    df, path = order
    got = stored_pages.stored_page(spark, path, 100, number)
    want = search.page(df, 100, number)
    assert got.columns == want.columns and [r.domain_name for r in got.collect()] == [r.domain_name for r in want.collect()]


def test_pages_hold_each_row_once(spark, order):
    df, path = order
    pages = [stored_pages.stored_page(spark, path, 499, n).collect() for n in range(1, 61)]
    ids = [r.id for p in pages for r in p]
    assert len(ids) == len(set(ids)) == df.where("domain_name IS NOT NULL").count()


def test_a_deep_page_reads_no_more_than_the_first(spark, tmp_path):
    path = str(tmp_path / "rows")
    stored_pages.store_order(spark.range(200_000).select(F.format_string("d%07d", "id").alias("domain_name")), path, ranges=32)
    for number in (1, 100_000):
        page = stored_pages.stored_page(spark, path, 1, number)
        assert [r.domain_name for r in page.collect()] == [f"d{number - 1:07d}"]
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert plan.split("PartitionFilters: [")[1].split("]")[0].count("=") == 1


def test_numbers_come_from_the_counts(spark, order):
    df, path = order
    for number in (1, 3, 500):
        assert stored_pages.stored_page_numbers(spark, path, 50, number).collect() == search.page_numbers(df.where("domain_name IS NOT NULL"), 50, number).collect()
