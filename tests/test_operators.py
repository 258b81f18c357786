"""Invariants and edge cases of the operators."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lapseflow.operators import dims, enrich, feed, ingest, joins, labels, normalise, search
from lapseflow.operators.enrich import ENRICHERS
from lapseflow.plans.inputs import LOADED, Inputs, moment

AS_OF = moment("2021-06-01 00:00:00")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def contract(spark):
    data = [
        (3, "a", "com", "sedo"), (1, "a", "com", "godaddy"), (2, "a", "net", "sedo"),
        (4, "b", "co.uk", "sedo"), (5, "b", "co.uk", "sedo"),
    ]
    return spark.createDataFrame(data, "seq BIGINT, name STRING, tld STRING, registrar STRING")


@pytest.fixture
def registrars(spark):
    rows = [(1, "godaddy", None, None), (2, "sedo", None, None)]
    return spark.createDataFrame(rows, "id INT, name STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")


def tlds_for(spark, contract):
    return dims.grow_dimension(dims.empty_dimension(spark), contract, "tld", AS_OF)


def insert(spark, contract, registrars, target):
    return ingest.insert_new_domains(contract, target, tlds_for(spark, contract), registrars, AS_OF)


def test_first_wins_whatever_the_partitioning(contract):
    wanted = [("a", "com", 1, "godaddy"), ("a", "net", 2, "sedo"), ("b", "co.uk", 4, "sedo")]
    for parts in (1, 3, 7):
        assert rows(ingest.first_wins(contract.repartition(parts))) == wanted


def test_insert_twice_adds_nothing(spark, contract, registrars):
    once = insert(spark, contract, registrars, ingest.empty_domains(spark))
    assert once.count() == 3
    assert insert(spark, contract, registrars, once).count() == 0


def test_unknown_member_gives_null_id(spark, contract):
    none = dims.empty_dimension(spark)
    fresh = insert(spark, contract, none, ingest.empty_domains(spark))
    assert [r.registrar_id for r in fresh.collect()] == [None] * 3


def test_dimension_ids_never_change(spark):
    names = spark.createDataFrame([(f"t{i}",) for i in range(300)], "tld STRING")
    first = tlds_for(spark, names.limit(100))
    old = {r.name: r.id for r in first.collect()}
    grown = dims.grow_dimension(first, names.union(names), "tld", AS_OF)
    new = {r.name: r.id for r in grown.collect()}
    assert {k: new[k] for k in old} == old
    assert sorted(new.values()) == list(range(1, 301))


def test_split_modes(spark):
    df = spark.createDataFrame([("a.co.uk",)], "domain_name STRING")
    assert normalise.split_domain(df).first().tld == "co.uk"
    assert normalise.split_domain(df, mode="second").first().tld == "co"
    with pytest.raises(ValueError):
        normalise.split_domain(df, mode="third")


def test_accepted_and_rejects_cover_all_rows(spark):
    df = spark.createDataFrame([("a.com",), ("plain",), ("",), (None,)], "domain_name STRING")
    assert normalise.accepted(df).count() == 1
    assert rows(normalise.rejects(df).select("reason")) == [("empty",), ("empty",), ("no_dot",)]


def landed(spark, data):
    return spark.createDataFrame(
        data, "domain STRING, source STRING, body STRING, fetched_at TIMESTAMP_NTZ, error STRING, seq BIGINT"
    )


def test_answers_overwrite_with_null_and_failures_do_not(spark, contract, registrars):
    table = insert(spark, contract, registrars, ingest.empty_domains(spark)).withColumn(
        "registered", F.lit("2001-01-01").cast("timestamp_ntz")
    )
    t1, t2 = datetime(2021, 1, 1), datetime(2021, 1, 2)
    answers = landed(
        spark,
        [
            ("A.com", "whois", '{"creation_date":null,"expiration_date":null}', t2, None, 1),
            ("a.com", "whois", '{"creation_date":"2009-01-01 00:00:00"}', t1, None, 2),
            ("a.NET", "whois", None, t1, None, 3),
            ("b.co.uk", "alexa", 'RANK="5"', t1, None, 4),
            ("b.co.uk", "alexa", 'RANK="6"', t1, None, 5),
            ("b.co.uk", "alexa", 'RANK="9"', t2, "timeout", 6),
            ("unknown.com", "alexa", 'RANK="1"', t2, None, 7),
        ],
    )
    now = moment("2021-07-01 00:00:00")
    out = enrich.apply_enrichment(table, answers, list(ENRICHERS.values()), now)
    assert out.columns == table.columns and out.count() == table.count()
    by = {(r.name, r.tld): r for r in out.collect()}
    new, old = datetime(2021, 7, 1), datetime(2021, 6, 1)
    a, n, b = by["a", "com"], by["a", "net"], by["b", "co.uk"]
    assert (a.registered, a.updated_at, a.attempts) == (None, new, 0)
    assert (n.registered, n.updated_at, n.attempts, n.last_attempt) == (
        datetime(2001, 1, 1), old, 1, new,
    )
    assert (b.alexa_score, b.updated_at, b.attempts) == (6, new, 1)


def test_backlog_rotates_failed_domains(spark, contract, registrars):
    table = insert(spark, contract, registrars, ingest.empty_domains(spark))
    rank = ENRICHERS["alexa"]
    head = rank.backlog(table, 1).first()
    failed = landed(spark, [(f"{head.name}.{head.tld}", "alexa", None, datetime(2021, 1, 1), "x", 1)])
    later = enrich.apply_enrichment(table, failed, [rank], moment("2021-07-01 00:00:00"))
    queue = [(r.name, r.tld) for r in rank.backlog(later, 10).collect()]
    assert len(queue) == 3 and queue[-1] == (head.name, head.tld)


def test_hot_keys_are_found_and_results_stay_whole(spark):
    facts = spark.range(30_000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("name"),
    )
    lookup = facts.groupBy("name").agg(F.count("seq").alias("n")).where("name <> 'k1'")
    hot = joins.hot_keys(facts, ["name"], min_rows=100)
    assert len(hot) == 1 and 1 < hot[0][1] <= joins.MAX_PARTS
    plain = facts.join(lookup, "name", "left")
    for how in ("left", "inner", "left_anti"):
        spread = joins.spread_join(facts, lookup, ["name"], how, ["seq"], min_rows=100)
        plain = facts.join(lookup, ["name"], how)
        assert spread.columns == plain.columns
        assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count()


def test_spread_join_splits_the_hot_group(spark):
    facts = spark.range(40_000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name")
    )
    lookup = facts.select("name").distinct().withColumn("flag", F.lit(1))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.spread_join(facts, lookup, ["name"], "left", ["seq"], min_rows=100)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_lookup_is_not_broadcast(spark):
    facts = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 50).alias("k"))
    lookup = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert joins.is_small(lookup) and not joins.is_small(lookup, max_rows=10)
    assert not joins.is_small(lookup, max_bytes=10)
    wide = joins.lookup_join(facts, lookup, "k", max_rows=10, min_rows=1)
    assert rows(wide) == rows(joins.lookup_join(facts, lookup, "k"))


def test_skewed_labels_give_the_same_answers(spark):
    domains = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "www").otherwise(F.concat(F.lit("n"), F.col("id") % 400)).alias("name"),
        F.when(F.col("id") == 0, "com").when(F.col("id") == 3, "org").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("tld"),
    )
    plain = labels.label_uniqueness(domains)
    split = labels.label_uniqueness(domains, min_rows=10)
    assert rows(split) == rows(plain)
    assert rows(plain.where("name = 'www'").groupBy("others").count()) == [(1, 2), (2, 998)]
    registry = domains.withColumn("created", moment("2001-01-01 00:00:00"))
    siblings = labels.sibling_availability(domains, registry, min_rows=10)
    assert rows(siblings) == rows(labels.sibling_availability(domains, registry))
    assert siblings.where("name = 'www' AND com = 1 AND org = 1 AND net = 0").count() == 1000


def test_equal_rows_of_a_hot_key_are_spread(spark):
    facts = spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("name"), F.lit(1).alias("seq"))
    lookup = spark.createDataFrame([("hot", 7)], "name STRING, v INT")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        joined = joins.spread_join(facts, lookup, ["name"], "left", ["seq"], min_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) < 40_000
    assert joined.where("v = 7").count() == 40_000


def test_measuring_moves_sums_only(spark):
    wide = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("k"))
    seen = []
    original = type(wide).agg
    type(wide).agg = lambda self, *a: seen.append(original(self, *a)) or seen[-1]
    try:
        assert joins.is_small(wide)
    finally:
        type(wide).agg = original
    plan = plan_of(seen[0])
    assert "LocalLimit" not in plan and "GlobalLimit" not in plan
    assert plan.index("partial_count") > plan.index("Exchange SinglePartition")


def test_small_batch_leaves_the_table_where_it_is(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"), F.lit("com").alias("tld")).write.parquet(path)
    batch = spark.createDataFrame([("n7", "com"), ("new", "com"), ("n7", "net")], "name STRING, tld STRING")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = ingest.not_stored(batch, spark.read.parquet(path))
        assert "Exchange hashpartitioning" not in plan_of(fresh)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows(fresh) == [("n7", "net"), ("new", "com")]


def test_attributes_on_top_of_a_stored_table(spark):
    def feed(*found):
        return spark.createDataFrame(found, "name STRING, tld STRING, seq BIGINT, price INT")

    layout = "domain_id STRING, seq BIGINT, price DECIMAL(19,2), pageviews INT"
    old = ingest.upsert_meta(feed(("a", "com", 5, 1), ("b", "com", 1, 2), ("b", "com", 2, 3)), layout)
    assert old.count() == 2 and old.columns == ["domain_id", "seq", "price", "pageviews"]
    new = ingest.upsert_meta(feed(("a", "com", 4, 9), ("b", "com", 3, 4), ("c", "com", 1, 5)), layout, old)
    assert sorted((r.seq, int(r.price)) for r in new.collect()) == [(1, 5), (3, 4), (5, 1)]


def test_search_gathers_near_matches_only(spark):
    names = spark.range(1000).select(F.concat(F.lit("zzz"), "id").alias("name")).unionAll(spark.createDataFrame([("ring",)], "name STRING"))
    plan = plan_of(search.term_search(names, ["ring"]))
    assert plan.index("Generate") > plan.index("Exchange")
    for threshold in (0, -1, 1.5):
        with pytest.raises(ValueError):
            search.term_search(names, ["ring"], threshold=threshold)


def test_search_finds_the_near_name(spark):
    names = spark.createDataFrame([("tacojohns",), ("google",), ("tacojohns",)], "name STRING")
    hits = search.term_search(names, ["tacos"])
    assert [(r.term, r.name, round(r.similarity, 2)) for r in hits.collect()] == [("tacos", "tacojohns", 0.33)]


def test_pages(spark):
    df = spark.range(95).select(F.format_string("d%03d", "id").alias("domain_name"))
    assert [r.domain_name for r in search.page(df, 10, 10).collect()] == [f"d{i:03}" for i in range(90, 95)]
    assert [r.domain_name for r in search.page_after(df, 2, "d010").collect()] == ["d011", "d012"]
    assert tuple(search.page_numbers(df, 10, 10).first()) == (90, 10, None, 9)
    assert tuple(search.page_numbers(df, 10, 1).first()) == (0, 10, 2, None)
    for limit, number in ((0, 1), (500, 1), (10, 0)):
        with pytest.raises(ValueError):
            search.page(df, limit, number)


def test_deep_pages_equal_shallow_ones(spark, monkeypatch):
    names = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.format_string("www.%04d", "id"))
        .otherwise(F.format_string("%s.%d", F.md5(F.col("id").cast("string")), "id"))
        .alias("domain_name")
    )
    wanted = [r.domain_name for r in names.orderBy("domain_name").collect()]
    monkeypatch.setattr(search, "SHALLOW", 20)
    for number in (1, 3, 30, 73, 80, 81):
        got = [r.domain_name for r in search.page(names, 50, number).collect()]
        assert got == wanted[(number - 1) * 50 : number * 50]


def test_pages_leave_out_rows_without_a_key_and_end(spark, monkeypatch):
    found = ["a", "b", "b", "b", "b", "b", "b", "b", "b", "c", "d", "", None, None, None]
    names = spark.createDataFrame([(n,) for n in found], "domain_name STRING")
    wanted = sorted(n for n in found if n is not None)
    for shallow in (50_000, 1):
        monkeypatch.setattr(search, "SHALLOW", shallow)
        pages = [[r.domain_name for r in search.page(names, 3, n).collect()] for n in range(1, 7)]
        assert pages == [wanted[i : i + 3] for i in range(0, 18, 3)]
    far = search.page(names, 50, 10**7)
    assert far.count() == 0 and "500000000" not in plan_of(far)


def test_retention_splits_without_loss(spark):
    df = spark.createDataFrame(
        [("a", datetime(2021, 3, 2)), ("b", datetime(2021, 3, 4)), ("c", datetime(2020, 1, 1))],
        "name STRING, at TIMESTAMP_NTZ",
    )
    keep, old = feed.retention(df, "at", moment("2021-06-01 00:00:00"))
    assert rows(keep.select("name")) == [("b",)]
    assert rows(old.select("name", "month")) == [("a", "2021-03"), ("c", "2020-01")]


# Plans


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_join_and_no_python_in_the_main_path(spark, folder):
    x = Inputs(spark, folder)
    for df in (
        x.enriched(),
        labels.sibling_availability(x.domains(), x.registry()),
        labels.brandable(x.domains(), x.words()),
        search.term_search(x.norm(), ["ring"]),
    ):
        plan = plan_of(df)
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
            assert node not in plan


def test_enrichment_leaves_the_table_where_it_is(spark, folder, tmp_path):
    x = Inputs(spark, folder)
    path = str(tmp_path / "domain")
    x.domain_table().write.parquet(path)
    x.responses().write.parquet(f"{path}-responses")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich.apply_enrichment(
            spark.read.parquet(path),
            spark.read.parquet(f"{path}-responses"),
            list(ENRICHERS.values()),
            moment(LOADED),
        )
        plan = plan_of(out)
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_backlog_predicate_reaches_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "domain")
    Inputs(spark, folder).domain_table().write.parquet(path)
    plan = plan_of(ENRICHERS["alexa"].backlog(spark.read.parquet(path)))
    assert "IsNull(alexa_score)" in plan and "TakeOrderedAndProject" in plan
    assert "has_wiki" not in plan
