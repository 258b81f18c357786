"""The bucketed domain table: what its reads touch, and what happens to runs, folds and other sessions."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lapseflow.operators import dims, ingest
from lapseflow.plans.inputs import LOADED, moment
from lapseflow.session import scratch_path, stored
from lapseflow.sinks import domain_table


def domains(spark, n, prefix="d"):
    rows = spark.range(n).select(F.concat(F.lit(prefix), "id").alias("name"), F.lit("com").alias("tld"))
    return ingest.to_domain_layout(ingest.stamp_created(ingest.with_id(rows), moment(LOADED)))


def answers(spark, low, high, rank=7, day=9):
    at = F.lit(datetime(2021, 1, day)).cast("timestamp_ntz")
    rank = F.struct(at.alias("fetched_at"), F.col("id").alias("seq"), F.lit(rank).alias("answer"))
    name = F.concat(F.lit("d"), F.col("id")).alias("name")
    return spark.range(low, high).select(name, F.lit("com").alias("tld"), rank.alias("alexa"), F.lit(0).alias("failed"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folder(path: str) -> Path:
    return Path(path.removeprefix("file:"))


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-domain")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("changed", [1, 1_000_000])
def test_reading_moves_neither_the_table_nor_its_changes(spark, path, no_broadcast, changed):
    domain_table.append_domains(domains(spark, 2_000), path)
    domain_table.append_domains(domains(spark, 50, "e"), path)
    domain_table.append_changes(answers(spark, 0, changed), path, "1", moment(LOADED))
    before = set(folder(path).parent.iterdir())
    for _ in range(2):
        now = domain_table.read_current(spark, path)
        plan = plan_of(now)
        # All that is exchanged is the names of covered runs.
        assert "Exchange hashpartitioning" not in plan and "Exchange range" not in plan and "Bucketed: true" in plan
        assert set(folder(path).parent.iterdir()) - {Path(f"{folder(path)}-folds")} == before
        assert now.where("alexa_score = 7").count() == min(changed, 2_000) and now.count() == 2_050
        domain_table.fold_changes(spark, path)
        before = set(folder(path).parent.iterdir()) - {Path(f"{folder(path)}-folds")}


def test_a_small_load_opens_its_own_buckets_only(spark, path):
    domain_table.append_domains(domains(spark, 5_000), path, buckets=64)
    batch = spark.createDataFrame([(1, "d7", "com", "r"), (2, "new", "com", "r"), (3, "d7", "com", "r")], "seq BIGINT, name STRING, tld STRING, registrar STRING")
    part = domain_table.candidates(spark, path, batch)
    buckets = batch.select(domain_table.bucket_of(64)).distinct().count()
    assert len(part.inputFiles()) <= buckets < len(domain_table.read_domains(spark, path).inputFiles()) == 64
    plan = plan_of(ingest.not_stored(ingest.first_wins(batch), part))
    assert "PartitionFilters: [bucket" in plan and "ReadSchema: struct<name:string,tld:string>" in plan
    none = dims.empty_dimension(spark)
    fresh = ingest.insert_new_domains(batch, lambda firsts: domain_table.candidates(spark, path, firsts), none, none, moment(LOADED))
    assert [r.name for r in fresh.collect()] == ["new"]


def test_a_load_that_hits_nothing_reads_nothing(spark, path):
    domain_table.append_domains(domains(spark, 10), path)
    empty = spark.createDataFrame([], "name STRING, tld STRING")
    assert domain_table.candidates(spark, path, empty).count() == 0


def test_a_large_load_joins_the_table_where_it_lies(spark, path, no_broadcast, monkeypatch):
    monkeypatch.setattr(ingest, "is_small", lambda df: False)
    domain_table.append_domains(domains(spark, 100), path, buckets=16)
    # Written, since a tld known beforehand would be no key any more.
    batch = stored(domains(spark, 200).select("name", "tld"), "batch")
    fresh = ingest.not_stored(batch, domain_table.candidates(spark, path, batch))
    assert plan_of(fresh).count("Exchange hashpartitioning") == 1 and fresh.count() == 100


def test_files_lie_in_the_buckets_spark_expects(spark, path):
    domain_table.append_domains(domains(spark, 300), path, buckets=4)
    for file in folder(path).rglob("*.parquet"):
        own = int(file.parent.name.removeprefix("bucket="))
        assert file.name.split("_")[-1].startswith(f"{own:05d}")
        rows = spark.read.parquet(str(file)).select("name", "tld", domain_table.bucket_of(4).alias("b")).collect()
        assert {r.b for r in rows} == {own} and [r.name for r in rows] == sorted(r.name for r in rows)


def test_the_bucket_count_of_a_table_stays(spark, path):
    domain_table.append_domains(domains(spark, 5), path, buckets=4)
    domain_table.append_domains(domains(spark, 5, "e"), path, buckets=9)
    assert domain_table.buckets_of(spark, path) == 4 and domain_table.read_domains(spark, path).count() == 10


def test_other_sessions_see_what_was_written(spark, path):
    other = spark.newSession()
    domain_table.append_domains(domains(spark, 5), path)
    assert domain_table.read_current(other, path).count() == 5
    domain_table.append_domains(domains(other, 5, "e"), path)
    domain_table.append_changes(answers(other, 0, 3), path, "1", moment(LOADED))
    assert domain_table.read_current(spark, path).where("alexa_score = 7").count() == 3


def test_covered_runs_go_and_nothing_else(spark, path):
    domain_table.append_domains(domains(spark, 10), path)
    tomorrow = datetime.now() + timedelta(days=1)
    assert domain_table.drop_covered(spark, path, tomorrow) == 0
    for run, low in (("a:1", 0), ("b 2", 3)):
        domain_table.append_changes(answers(spark, low, low + 3, rank=low + 1), path, run, moment(LOADED))
        domain_table.fold_changes(spark, path)
    domain_table.append_changes(answers(spark, 6, 8, rank=9), path, "open", moment(LOADED))

    def ranks():
        return sorted((r.name, r.alexa_score) for r in domain_table.read_current(spark, path).where("alexa_score IS NOT NULL").collect())

    want = [("d0", 1), ("d1", 1), ("d2", 1), ("d3", 4), ("d4", 4), ("d5", 4), ("d6", 9), ("d7", 9)]
    assert ranks() == want
    # Two runs, the first fold and its list; nothing that is younger than the given moment.
    assert domain_table.drop_covered(spark, path, datetime.now() - timedelta(days=1)) == 0
    assert domain_table.drop_covered(spark, path, tomorrow) == 4
    assert ranks() == want and len(list(Path(f"{folder(path)}-changes").glob("run=*"))) == 2
    domain_table.fold_changes(spark, path)
    assert ranks() == want
    # The list of covered runs doesn't grow with those that are gone.
    assert domain_table._last_fold(spark, path)[2].count() == 1


def test_a_fold_that_was_never_named_counts_for_nothing(spark, path):
    domain_table.append_domains(domains(spark, 10), path)
    domain_table.append_changes(answers(spark, 0, 2), path, "1", moment(LOADED))
    domain_table._log(domain_table.merge_answers(domain_table._open(spark, path).drop("run")), path, "fold-lost")
    domain_table.append_changes(answers(spark, 0, 2, rank=8, day=10), path, "2", moment(LOADED))
    assert {r.alexa_score for r in domain_table.read_current(spark, path).collect()} == {None, 8}
    with pytest.raises(ValueError, match="fold-"):
        domain_table.append_changes(answers(spark, 0, 2), path, "fold-mine", moment(LOADED))


def test_apostrophes_in_paths(spark, path):
    place = f"{path}/o'clock"
    domain_table.append_domains(domains(spark, 3), place)
    assert domain_table.read_current(spark, place).count() == 3
