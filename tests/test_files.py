"""Round trips through every file format, and the incremental jobs."""

from __future__ import annotations

import json
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lapseflow import schemas
from lapseflow.operators import enrich, feed, ingest, normalise
from lapseflow.operators.enrich import ENRICHERS, apply_enrichment
from lapseflow.plans.inputs import LOADED, Inputs, moment
from lapseflow.session import scratch_path
from lapseflow.sinks import dim_table, domain_table, files
from lapseflow.sources import auctions, feeds, tables
from lapseflow.streaming import loops

ENTRIES = [
    {
        "domainName": f"name{i}.com", "link": "l", "auctionType": "Bid", "price": "$1,200",
        "auctionEndTime": "2021-02-04T10:00:00Z", "numberOfBids": i, "domainAge": "3",
        "description": 'a "quoted", text', "pageviews": 1, "valuation": "$5",
        "monthlyParkingRevenue": "$0", "isAdult": "True",
    }
    for i in range(5)
]


def envelope(entries):
    return json.dumps({"meta": {"count": len(entries)}, "data": entries}, indent=1)


def test_json_envelopes(spark, tmp_path):
    (tmp_path / "one.json").write_text(envelope(ENTRIES[:2]))
    (tmp_path / "two.json").write_text(envelope(ENTRIES[2:]))
    df = auctions.auction_json(spark, str(tmp_path))
    assert df.count() == 5
    typed = normalise.type_auction_attributes(df).where("domainName = 'name4.com'").first()
    assert (float(typed.price), typed.isAdult, typed.domainAge) == (1200.0, True, 3)
    assert typed.auctionEndTime == datetime(2021, 2, 4, 10)
    metas = [json.loads(r.meta)["count"] for r in auctions.envelope_meta(spark, str(tmp_path)).collect()]
    assert sorted(metas) == [2, 3]


def test_zip_archives_and_file_selection(spark, tmp_path):
    for name, part in (("all_listings.json.zip", ENTRIES[:2]), ("all_listings_old.json.zip", ENTRIES[2:])):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr(name.rsplit(".", 1)[0], envelope(part))
    df = auctions.zipped_auction_json(spark, str(tmp_path))
    assert sorted(r.domainName for r in df.collect()) == ["name0.com", "name1.com"]


def test_market_csv(spark, tmp_path):
    head = "Domain Name;Start Time;End Time;Reserve Price;Domain is IDN;Domain has hyphen;Domain has numbers;Domain Length;TLD;Traffic;Link"
    lines = ["sep=;", head] + [f'"bücher{i}.de";s;e;"1;2";0;0;1;7;de;{i};http://x' for i in range(50)]
    (tmp_path / "market.csv").write_bytes("\r\n".join(lines).encode("utf-16"))
    df = normalise.rename_market_columns(auctions.market_csv(spark, str(tmp_path)))
    assert "link" not in [c.lower() for c in df.columns] and df.count() == 50
    assert df.where("traffic = '7'").first().name == "bücher7.de"
    assert df.first().reserve_price == "1;2"


def test_feeds_reach_the_contract(spark, tmp_path):
    (tmp_path / "one.json").write_text(envelope(ENTRIES))
    rows = feeds.AUCTION_JSON.load(spark, str(tmp_path / "one.json"), 1)
    assert rows.columns == list(normalise.CONTRACT)
    first = rows.orderBy("name").first()
    assert (first.seq, first.name, first.tld, first.registrar, first.expired) == (1, "name0", "com", "godaddy", None)


def test_word_lists(spark, tmp_path):
    (tmp_path / "w.txt").write_text("tree\nhouse\n\ntree\n")
    (tmp_path / "w.json").write_text('["tree",\n "house"]')
    for df in (tables.words(spark, str(tmp_path / "w.txt")), tables.words_json(spark, str(tmp_path / "w.json"))):
        assert sorted(r.word for r in df.collect()) == ["house", "tree"]


def test_recordset(spark):
    text = '[{"p_id":1,"first_name":"a","other":9},{"p_id":2,"p_attribute":{"k":[1]}}]'
    df = tables.json_recordset(spark.createDataFrame([(text,)], "t STRING"), "t")
    assert [tuple(r) for r in df.collect()] == [(1, "a", None, None, None), (2, None, None, '{"k":[1]}', None)]


def test_batches_are_cut_and_read_back(spark, tmp_path):
    rows = spark.range(1050).select(
        F.concat(F.lit("n,"), "id").alias("name"), F.lit("com").alias("tld"), F.lit("sedo").alias("registrar"),
        F.lit(None).cast("timestamp_ntz").alias("expired"),
        F.lit("2021-02-04 10:00:00").cast("timestamp_ntz").alias("registered"),
    )
    path = str(tmp_path / "batches")
    files.write_batches(rows.coalesce(1), path, rows=500)
    assert len(list((tmp_path / "batches").glob("*.csv"))) == 3
    back = normalise.from_staged(tables.staged_csv(spark, path))
    assert back.count() == 1050
    first = back.where("name = 'n,7'").first()
    assert (first.expired, first.registered) == (None, datetime(2021, 2, 4, 10))


def test_export_and_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    files.export_csv(spark.createDataFrame([('a "b", c',)], "v STRING").coalesce(1), path)
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text() == 'v\n"a ""b"", c"\n'
    row = files.export_manifest(spark, path, "https://files.example.org/").first()
    assert row["size"] == part.stat().st_size and part.name in row.file_name
    assert row.date == datetime.fromtimestamp(part.stat().st_mtime).date()
    kept = str(tmp_path / "kept")
    for _ in range(2):
        files.append_manifest(files.export_manifest(spark, path, "https://files.example.org/"), kept)
    assert spark.read.csv(kept, header=True).count() == 2


def test_archive_by_month(spark, tmp_path):
    old = spark.createDataFrame([("a", "2020-01"), ("b", "2020-02")], "name STRING, month STRING")
    files.write_archive(old, str(tmp_path / "old"))
    assert sorted(p.name for p in (tmp_path / "old").glob("month=*")) == ["month=2020-01", "month=2020-02"]


@pytest.fixture(scope="module")
def x(spark, folder):
    return Inputs(spark, folder)


def contract_rows(x):
    return normalise.to_contract(x.listing(), "domain_name")


def test_stream_in_bites_equals_batch(spark, x, tmp_path):
    source = str(tmp_path / "landed")
    rows = x.listing().repartitionByRange(12, "seq")
    rows.write.parquet(source)
    root = scratch_path(spark, "test-tables")
    loops.create_tables(spark, root)
    layout = rows.schema
    stream = loops.file_stream(spark, source, layout)
    query = loops.stream_listing_ingest(stream, root, moment(LOADED), root.rsplit("/", 1)[-1])
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    got = domain_table.read_domains(spark, f"{root}/domain").select("name", "tld", "created_at")
    want = ingest.first_wins(contract_rows(x)).select("name", "tld", moment(LOADED).alias("created_at"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    tlds = dim_table.read(spark, f"{root}/tld").collect()
    assert sorted(r.id for r in tlds) == list(range(1, len(tlds) + 1))
    assert len({r.name for r in tlds}) == len(tlds)


def test_two_interleaved_loads_give_no_id_twice(spark):
    path = scratch_path(spark, "test-dim")

    def load(names, **options):
        rows = spark.createDataFrame([(n,) for n in names], "tld STRING")
        return dim_table.grow(spark, path, rows, "tld", moment(LOADED), **options)

    # Twice another writer is faster, then nobody is.
    others = [["d", "e"], ["b", "c", "d"]]
    got = load(["A", "b", "f"], before_claim=lambda: others and load(others.pop())).collect()
    assert sorted(r.name for r in got) == list("abcdef") and sorted(r.id for r in got) == list(range(1, 7))
    kept = {r.name: r.id for r in got}
    assert [v[0] for v in dim_table.versions(spark, path)] == [3, 2, 1]
    # A load without new members makes no version.
    assert load(["a", "F", None]).count() == 6 and len(dim_table.versions(spark, path)) == 3
    # Whole versions bound what a reader opens; ids stay.
    for i in range(6):
        load([f"n{i}"], whole=3)
        assert len(dim_table.versions(spark, path)) <= 4
    members = {r.name: r.id for r in dim_table.read(spark, path).collect()}
    assert {n: members[n] for n in kept} == kept and sorted(members.values()) == list(range(1, 13))


def test_counts_come_with_the_writes(spark, x):
    root = scratch_path(spark, "test-tables")
    loops.create_tables(spark, root)
    source = f"{root}/landed"
    x.listing().repartitionByRange(6, "seq").write.parquet(source)
    for _ in range(2):
        loops.stream_listing_ingest(loops.file_stream(spark, source, x.listing().schema), root, moment(LOADED), root.rsplit("/", 1)[-1]).awaitTermination()
    report = loops.read_report(spark, root).collect()
    assert len(report) == 2 and sum(r.rows_read for r in report) == x.listing().count()
    assert sum(r.rows_rejected for r in report) == loops.read_rejects(spark, root).count()
    assert sum(r.rows_inserted for r in report) == domain_table.read_domains(spark, f"{root}/domain").count()


def logged(spark, path):
    """The stored table with its answers, as comparable rows."""
    columns = ("name", "tld", "alexa_score", "has_wiki", "registered", "expired", "attempts")
    return sorted(map(tuple, domain_table.read_current(spark, path).select(*columns).collect()), key=str)


def fresh_table(spark, domains):
    path = scratch_path(spark, "test-domain")
    domain_table.append_domains(domains, path)
    return path


def applied(domains, answers):
    columns = ("name", "tld", "alexa_score", "has_wiki", "registered", "expired", "attempts")
    out = apply_enrichment(domains, answers, list(ENRICHERS.values()), moment(LOADED))
    return sorted(map(tuple, out.select(*columns).collect()), key=str)


def test_stream_of_answers_equals_batch(spark, x, tmp_path):
    """All kinds in one stream, in several batches, newest answers first."""
    source = str(tmp_path / "answers")
    answers = x.responses()
    days = [r.d for r in answers.select(F.to_date("fetched_at").alias("d")).distinct().orderBy(F.desc("d")).collect()]
    cuts = days[:: max(1, len(days) // 6)][1:7]
    for number, (high, low) in enumerate(zip([None, *cuts], [*cuts, None], strict=True)):
        part = answers
        part = part if high is None else part.where(F.to_date("fetched_at") < F.lit(high))
        part = part if low is None else part.where(F.to_date("fetched_at") >= F.lit(low))
        part.coalesce(1).write.parquet(f"{source}/{number}")
    path = fresh_table(spark, x.domain_table())
    stream = loops.file_stream(spark, f"{source}/*", answers.schema, files_per_pass=2)
    query = loops.stream_enrichment_apply(stream, list(ENRICHERS.values()), path, moment(LOADED), path.rsplit("/", 1)[-1])
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) >= 3
    assert logged(spark, path) == applied(x.domain_table(), answers)


def one_answer(spark, domain, source, body, day, seq):
    return spark.createDataFrame(
        [(domain, source, body, datetime(2021, 1, day), None, seq)], f"{schemas.RESPONSE}, seq BIGINT"
    )


def three_domains(spark):
    return ingest.to_domain_layout(
        ingest.stamp_created(
            ingest.with_id(spark.createDataFrame([("a", "com"), ("b", "com"), ("c", "net")], "name STRING, tld STRING")),
            moment(LOADED),
        )
    )


def ranked(spark, path):
    return {r.name: r.alexa_score for r in domain_table.read_current(spark, path).collect()}


def log(spark, path, run, *answers):
    landed = normalise.union_feeds(*answers)
    domain_table.append_changes(enrich.latest_answers(landed, list(ENRICHERS.values())), path, run, moment(LOADED))


def test_an_older_answer_in_a_later_run_changes_nothing(spark):
    path = fresh_table(spark, three_domains(spark))
    log(spark, path, "1", one_answer(spark, "a.com", "alexa", 'RANK="2"', 9, 1))
    log(spark, path, "2", one_answer(spark, "a.com", "alexa", 'RANK="1"', 3, 2))
    assert ranked(spark, path) == {"a": 2, "b": None, "c": None}
    domain_table.fold_changes(spark, path)
    log(spark, path, "3", one_answer(spark, "a.com", "alexa", 'RANK="5"', 8, 3), one_answer(spark, "b.com", "alexa", 'RANK="7"', 1, 4))
    assert ranked(spark, path) == {"a": 2, "b": 7, "c": None}


def test_replays_appends_and_two_enrichers_lose_nothing(spark):
    path = fresh_table(spark, three_domains(spark))
    rank = one_answer(spark, "a.com", "alexa", 'RANK="2"', 9, 1)
    wiki = one_answer(spark, "a.com", "wiki", '["q",["x"],[],[]]', 9, 2)
    log(spark, path, "rank-1", rank)
    # Domains that come in between, another enricher, and the first run again.
    more = ingest.to_domain_layout(ingest.stamp_created(ingest.with_id(spark.createDataFrame([(f"n{i}", "org") for i in range(40)], "name STRING, tld STRING")), moment(LOADED)))
    domain_table.append_domains(more, path)
    log(spark, path, "wiki-1", wiki)
    log(spark, path, "rank-1", rank)
    for _ in range(2):
        now = domain_table.read_current(spark, path)
        assert now.count() == 43
        assert [(r.alexa_score, r.has_wiki, r.attempts) for r in now.where("name = 'a'").collect()] == [(2, True, 0)]
        domain_table.fold_changes(spark, path)
        log(spark, path, "rank-1", rank)


def test_failures_are_counted_once_per_run(spark):
    path = fresh_table(spark, three_domains(spark))
    failed = one_answer(spark, "a.com", "alexa", None, 2, 1)
    for run in ("1", "1", "2"):
        log(spark, path, run, failed)
    domain_table.fold_changes(spark, path)
    domain_table.fold_changes(spark, path)
    log(spark, path, "3", failed)
    attempts = {r.name: r.attempts for r in domain_table.read_current(spark, path).collect()}
    assert attempts == {"a": 3, "b": 0, "c": 0}


def test_log_follows_the_answers(spark, x):
    path = fresh_table(spark, x.domain_table())
    log(spark, path, "1", one_answer(spark, "a.com", "alexa", 'RANK="2"', 9, 1))
    files_written = list(Path(f"{path.removeprefix('file:')}-changes").rglob("*.parquet"))
    assert sum(spark.read.parquet(str(f)).count() for f in files_written) == 1


def test_rows_in_are_accepted_plus_rejected(spark, tmp_path):
    names = ["a.com", "undotted", "", ".com", "foo.", "B.co.uk"]
    (tmp_path / "one.json").write_text(json.dumps({"meta": {}, "data": [{"domainName": n} for n in names] + [{"link": "x"}]}))
    path, rejected = str(tmp_path / "one.json"), str(tmp_path / "rejects")
    loaded = feeds.AUCTION_JSON.load_all(spark, path, rejected, 3)
    assert sorted(r.name for r in loaded.collect()) == ["a", "b"]
    assert loaded.exceptAll(feeds.AUCTION_JSON.load(spark, path, 3)).count() == 0
    reasons = {(r.domain, r.reason) for r in spark.read.parquet(rejected).collect()}
    assert reasons == {("undotted", "no_dot"), ("", "empty"), (".com", "no_name"), ("foo.", "no_tld"), (None, "empty")}
    assert reasons == {(r.domain, r.reason) for r in feeds.AUCTION_JSON.rejects(spark, path).collect()}


def test_market_rows_without_a_name_are_rejected(spark, tmp_path):
    titles = [*schemas.MARKET_COLUMNS, *schemas.MARKET_EXTRA]
    lines = ["sep=;", ";".join(titles), "a.com" + ";1" * 10, ";2" + ";1" * 9, "nodot" + ";1" * 10]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n", encoding="utf-16")
    assert feeds.MARKET_CSV.load(spark, str(tmp_path / "m.csv")).count() == 1
    assert sorted(r.reason for r in feeds.MARKET_CSV.rejects(spark, str(tmp_path / "m.csv")).collect()) == ["empty", "no_dot"]


def test_broken_files_fail_the_read(spark, tmp_path):
    whole = envelope(ENTRIES)
    (tmp_path / "one.json").write_text(whole)
    (tmp_path / "two.json").write_text(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        auctions.auction_json(spark, str(tmp_path)).collect()
    half = spark.createDataFrame([(whole[: len(whole) // 2],)], "document STRING")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        auctions.entries_of(half).collect()


def test_archive_glob_equals_the_file_test(spark, tmp_path):
    names = ["all_listings.zip", "all_listings1.zip", "all_listings_x.zip", "all_listings2.json.zip", "other.zip", "my_all_listings.zip"]
    for name in names:
        (tmp_path / name).write_bytes(b"x")
    got = {r.file_name for r in auctions.archives(spark, str(tmp_path)).select("file_name").collect()}
    files_of = spark.createDataFrame([(n,) for n in names], "file_name STRING")
    assert got == {r.file_name for r in auctions.select_listing_files(files_of).collect()}


def test_staged_batches_keep_any_text(spark, tmp_path):
    odd = ['a"b,c', "line\nbreak", "", " space ", "plain", "back\\slash", "'quote'"]
    rows = spark.createDataFrame([(t, "", "sedo", None, None) for t in odd], "name STRING, tld STRING, registrar STRING, expired TIMESTAMP_NTZ, registered TIMESTAMP_NTZ")
    files.write_batches(rows, str(tmp_path / "b"))
    back = normalise.from_staged(tables.staged_csv(spark, str(tmp_path / "b")), seq=4).collect()
    assert sorted(r.name for r in back) == sorted(odd)
    assert {(r.seq, r.tld, r.registrar) for r in back} == {(4, "", "sedo")}


def test_stream_keeps_its_rejects(spark, x, tmp_path):
    source = str(tmp_path / "listings")
    x.listing().write.parquet(source)
    root = scratch_path(spark, "test-tables")
    loops.create_tables(spark, root)
    for turn in ("one", "two"):
        stream = loops.file_stream(spark, source, x.listing().schema)
        loops.stream_listing_ingest(stream, root, moment(LOADED), f"{root.rsplit('/', 1)[-1]}-{turn}").awaitTermination()
    rejected = loops.read_rejects(spark, root)
    assert rejected.where("run LIKE '%one%'").count() == normalise.rejects(x.listing()).count()
    accepted = normalise.accepted(x.listing()).count()
    assert accepted + rejected.count() // 2 == x.listing().count()


def test_retention_by_month_loses_nothing(spark, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    layout = "name STRING, at TIMESTAMP_NTZ"
    days = [datetime(2020, 1, 5), datetime(2021, 1, 31), datetime(2021, 3, 2), datetime(2021, 3, 3), datetime(2021, 3, 31), datetime(2021, 9, 1), None, None]
    listings = spark.createDataFrame([(f"n{i}", d) for i, d in enumerate(days)], layout)
    as_of = moment("2021-06-01 00:00:00")

    def sides():
        return feed.stored_retention(files.read_listings(spark, live, layout), files.read_listings(spark, archive, layout), "at", as_of)

    def names(df):
        return sorted(r.name for r in df.collect())

    want = feed.retention(listings, "at", as_of)
    assert (names(want[0]), names(want[1])) == (["n3", "n4", "n5", "n6", "n7"], ["n0", "n1", "n2"])
    files.write_listings(listings, live, "at")
    for before, moved in (("2020-01", 0), ("2021-03", 2), ("2021-03", 0)):
        assert files.archive_months(spark, live, archive, before) == moved
        keep, old = sides()
        assert names(keep) == names(want[0]) and sorted(map(tuple, old.collect())) == sorted(map(tuple, want[1].select(*old.columns).collect()))
    # A late listing of a month that has moved already.
    files.write_listings(spark.createDataFrame([("late", datetime(2021, 1, 2))], layout), live, "at")
    assert files.archive_months(spark, live, archive, "2021-02") == 1
    assert names(sides()[1]) == ["late", "n0", "n1", "n2"]
    # The border is known beforehand, so that months are chosen while files are listed.
    for side, test in zip(sides(), (">= 2021-03", "<= 2021-03"), strict=True):
        scans = side._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]
        assert len(scans) == 2 and all("month" in s.split("]")[0] and test in s.split("PushedFilters")[0] for s in scans)


def test_archives_are_written_in_pieces(spark, tmp_path):
    from lapseflow.plans import files as plans

    # Letters of two bytes, so that pieces end within some; many long documents in one task.
    texts = {f"all_listings{i}.json.zip": "x" * (i % 2) + "é" * (plans.PIECE * i // 2) + "漢" for i in range(8)}
    documents = spark.createDataFrame([*texts.items()], "file_name STRING, document STRING").coalesce(1)
    sizes = plans.document_pieces(documents).selectExpr("max(octet_length(piece))", "count(*)").first()
    assert sizes[0] == plans.PIECE and sizes[1] == sum(-(-len(t.encode()) // plans.PIECE) for t in texts.values())
    plans.land_archives(documents, str(tmp_path / "archives"))
    for name, text in texts.items():
        with zipfile.ZipFile(tmp_path / "archives" / name) as archive:
            assert archive.namelist() == [name.removesuffix(".zip")]
            assert archive.read(archive.namelist()[0]).decode() == text
