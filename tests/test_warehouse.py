import json
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_feeds import AUTHOR, document, land

from newsloom.operators.content import table_features
from newsloom.plans.bronze import active_documents, flat_documents, load_feed
from newsloom.plans.refresh import main, refresh
from newsloom.plans.warehouse import Warehouse
from newsloom.session import cut_lineage, dropping
from newsloom.sources import tables
from newsloom.streaming.landing import stream_feed

WORDS = ["rocket engine fuel test", "market price falls", "moon landing crew good", "bad weather delays"]


def feed(offset, count=12, **fields):
    return [
        document(
            offset + i, title=f"Big {WORDS[i % 4]}", summary=WORDS[i % 4] + " Luna", news_site=f"Site{i % 3}",
            url=f"https://site{i % 3}.org/{i}", published_at=f"2025-0{1 + i % 3}-10T12:00:00Z", **fields,
        )
        for i in range(count)
    ]


@pytest.fixture
def tools(spark):
    return table_features(
        spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double"),
        spark.createDataFrame([("Luna", "GPE")], "phrase string, label string"),
    )


def content_of(warehouse, name):
    return rows(warehouse.table(name))


def test_three_feeds_twice(spark, tmp_path, tools):
    landing = tmp_path / "landing"
    land(landing / "articles", feed(0), feed(100))
    land(landing / "blogs", feed(0))
    reports = [{k: v for k, v in d.items() if k not in ("featured", "launches", "events")} for d in feed(0)]
    land(landing / "reports", reports)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))

    refresh(warehouse, str(landing), *tools, run_id="one")
    bronze = warehouse.table("bronze")
    assert dict(rows(bronze.groupBy("source").count())) == {"articles": 24, "blogs": 12, "reports": 12}
    analysis = warehouse.table("analysis")
    assert analysis.count() == 48 and analysis.filter("locations = array('Luna')").count() == 48
    assert dict(rows(warehouse.table("trends").filter("word = 'big'").groupBy("source").agg(F.sum("count")))) == {
        "articles": 24, "blogs": 12, "reports": 12,
    }
    fact = spark.read.parquet(warehouse.path("fact_article"))
    assert fact.count() == 48 and fact.filter("source_id IS NULL OR topic_id IS NULL").count() == 0
    names = ("bronze", "trends", "sources", "dim_news_source", "dim_topic")
    before = {name: content_of(warehouse, name) for name in names}

    refresh(warehouse, str(landing), *tools, steps=("load", "trends", "gold"), run_id="two")
    assert {name: content_of(warehouse, name) for name in names} == before
    audit = warehouse.table("audit")
    assert dict(rows(audit.filter("process_name = 'load articles' AND stage = 'merge'").select("run_id", "record_count"))) == {
        "one": 24, "two": 0,
    }
    assert rows(audit.select("status").distinct()) == [("Completed",), ("Running",)]

    land(landing / "articles", feed(0, 2, updated_at="2025-05-01T00:00:00Z") + feed(500, 1, updated_at="2025-05-01T00:00:00Z"))
    refresh(warehouse, str(landing), *tools, sources=["articles"], run_id="three")
    assert active_documents(warehouse, "articles").count() == 25
    assert warehouse.table("bronze").filter("source = 'articles'").count() == 27
    assert warehouse.table("bronze").filter("source = 'blogs'").count() == 12
    old = {row[1:3] + row[4:]: row[0] for row in before["dim_news_source"]}
    new = {row[1:3] + row[4:]: row[0] for row in content_of(warehouse, "dim_news_source")}
    assert old == {key: new[key] for key in old}


def test_rejects_and_failures_are_recorded(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = land(tmp_path / "in", [document(1), document(None), document(2, updated_at="x")])
    load_feed(warehouse, "articles", folder, "one")
    rejects = spark.read.parquet(warehouse.path("rejects"))
    assert rows(rejects.select("reject_reason", "run_id", "source")) == [
        ("malformed updated_at", "one", "articles"), ("null key", "one", "articles"),
    ]
    with pytest.raises(ValueError):
        load_feed(warehouse, "articles", folder, "two", policy="neither")
    audit = warehouse.table("audit")
    assert rows(audit.filter("run_id = 'two'").select("stage", "status")) == [
        ("end: ValueError", "Failed"), ("reject", "Completed"), ("start", "Running"),
    ]
    assert dict(rows(audit.filter("run_id = 'one'").select("stage", "record_count"))) == {
        "start": 0, "reject": 2, "merge": 1, "end": 0,
    }


def test_flag_only_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    load_feed(warehouse, "blogs", land(tmp_path / "a", [document(1), document(2)]), "one", "flag_only")
    again = [document(1, updated_at="2025-06-01T00:00:00Z"), document(3, updated_at="2025-06-01T00:00:00Z")]
    load_feed(warehouse, "blogs", land(tmp_path / "b", again), "two", "flag_only")
    assert rows(warehouse.table("bronze").select("id", "is_active")) == [("1", False), ("2", True), ("3", True)]
    with pytest.raises(ValueError):
        load_feed(warehouse, "blogs", str(tmp_path / "b"), "three", "neither")


def test_nothing_stored_is_rewritten(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [
        document(1), document(2, published_at="2024-01-01T00:00:00Z"),
    ]), "one")
    old = set((tmp_path / "warehouse" / "bronze").glob("source=*/*/*.parquet"))
    moved = document(1, updated_at="2025-06-01T00:00:00Z", published_at="2025-04-01T00:00:00Z")
    load_feed(warehouse, "articles", land(tmp_path / "b", [moved]), "two")
    assert rows(warehouse.table("bronze").select("id", "published_month", "is_active")) == [
        ("1", "2025-03", False), ("1", "2025-04", True), ("2", "2024-01", True),
    ]
    now = set((tmp_path / "warehouse" / "bronze").glob("source=*/*/*.parquet"))
    assert old < now and len(now - old) == 1


def test_flat_documents(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [document(1, authors=[AUTHOR, AUTHOR]), document(2)]), "one")
    assert flat_documents(warehouse, "articles").count() == 3


def test_streaming_reads_each_page_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = land(tmp_path / "in", [document(1)], [document(2)])

    def run():
        query = stream_feed(warehouse, "articles", folder, str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
        assert query.exception() is None

    run()
    land(tmp_path / "in", [document(2, updated_at="2025-06-01T00:00:00Z"), document(3)])
    run()
    assert rows(warehouse.table("bronze").select("id", "is_active")) == [
        ("1", True), ("2", False), ("2", True), ("3", True),
    ]


def test_replace_table_may_read_its_target(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    tables.replace_table(spark.read.parquet(path).unionByName(spark.range(10, 12)), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (10,), (11,), (2,)]
    with pytest.raises(Exception):
        tables.replace_table(spark.read.parquet(path).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_partition_overwrite_append_and_schema_growth(spark, tmp_path):
    path = str(tmp_path / "t")
    feed_of = lambda name, n: spark.range(n).withColumn("source", F.lit(name))
    for name, n in (("articles", 2), ("blogs", 3), ("articles", 1)):
        tables.overwrite_partitions(feed_of(name, n), path)
    assert dict(rows(spark.read.parquet(path).groupBy("source").count())) == {"articles": 1, "blogs": 3}
    tables.append(feed_of("blogs", 1).withColumn("news_site", F.lit("S")), path, ["source"])
    grown = tables.scan(spark, path, ["source", "news_site"])
    assert dict(rows(grown.groupBy("news_site").count())) == {None: 4, "S": 1}
    assert tables.scan_or_empty(spark, str(tmp_path / "none"), grown.schema).count() == 0


def test_a_half_swap_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    spark.range(4).write.parquet(path + tables.RETIRED)
    assert tables.scan_or_empty(spark, path, schema).count() == 4
    tables.replace_table(spark.range(2), path)
    assert tables.scan_or_empty(spark, path, schema).count() == 2


def test_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(10_000).withColumn("month", F.pmod(F.xxhash64("id"), F.lit(5))).repartition(20)
    tables.append(tables.few_files(frame, "month"), path, ["month"])
    assert len(list((tmp_path / "t").glob("month=*/*.parquet"))) == 5
    assert spark.read.parquet(path).count() == 10_000


def test_command_line(spark, tmp_path):
    land(tmp_path / "landing" / "reports", feed(0))
    spark.createDataFrame([("good", 1.9)], "token string, valence double").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("Luna", "GPE")], "phrase string, label string").write.parquet(str(tmp_path / "g"))
    main([
        "--warehouse", str(tmp_path / "w"), "--landing", str(tmp_path / "landing"), "--lexicon", str(tmp_path / "x"),
        "--gazetteer", str(tmp_path / "g"), "--source", "reports", "--step", "load", "trends",
    ])
    assert Warehouse(spark, str(tmp_path / "w")).table("trends").filter("word = 'big'").agg(F.sum("count")).first()[0] == 12


def test_broken_pages_are_set_aside(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = land(tmp_path / "in", [document(1)])
    (tmp_path / "in" / "bad.json").write_text("{ not json\n")
    (tmp_path / "in" / "error.json").write_text('{"detail": "throttled"}\n')
    load_feed(warehouse, "articles", folder, "one")
    rejects = spark.read.parquet(warehouse.path("rejects"))
    assert rows(rejects.select("reject_reason", "title")) == [("broken page", "no results"), ("broken page", "{ not json")]
    assert dict(rows(warehouse.table("audit").select("stage", "record_count"))) == {"start": 0, "reject": 2, "merge": 1, "end": 0}
    pretty = tmp_path / "pretty"
    pretty.mkdir()
    (pretty / "p.json").write_text(json.dumps({"next": None, "results": [document(7)]}, indent=2))
    load_feed(warehouse, "articles", str(pretty), "two", multi_line=True)
    assert rows(warehouse.table("bronze").select("id")) == [("1",), ("7",)]


def test_late_pages_and_since(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [document(1, updated_at="2025-06-01T00:00:00Z")]), "one")
    late = land(tmp_path / "b", [document(9, updated_at="2025-01-01T00:00:00Z"), document(1, updated_at="2025-02-01T00:00:00Z")])
    load_feed(warehouse, "articles", late, "two", since=datetime(2025, 1, 15, tzinfo=timezone.utc))
    assert rows(warehouse.table("bronze").select("id", "is_active")) == [("1", True)]
    load_feed(warehouse, "articles", late, "three")
    assert rows(warehouse.table("bronze").select("id", "is_active")) == [("1", True), ("9", True)]


@pytest.mark.parametrize("policy", ["history", "flag_only"])
def test_a_load_that_dies_at_any_write_can_be_repeated(spark, tmp_path, monkeypatch, policy):
    first = land(tmp_path / "a", [document(1), document(2)])
    second = land(tmp_path / "b", [
        document(1, updated_at="2025-06-01T00:00:00Z"), document(3, updated_at="2024-01-01T00:00:00Z"),
    ])

    def loaded(name, fail_at):
        warehouse = Warehouse(spark, str(tmp_path / name))
        load_feed(warehouse, "articles", first, "one", policy)
        writes, store = [], tables.append

        def dies(df, path, by=()):
            writes.append(path)
            if len(writes) == fail_at:
                raise RuntimeError("killed")
            store(df, path, by)

        monkeypatch.setattr(tables, "append", dies)
        if fail_at:
            with pytest.raises(RuntimeError):
                load_feed(warehouse, "articles", second, "two", policy)
        monkeypatch.setattr(tables, "append", store)
        load_feed(warehouse, "articles", second, "two", policy)
        return rows(warehouse.table("bronze").select("id", "updated_at", "is_active"))

    undisturbed = loaded("whole", 0)
    for fail_at in (1, 2, 3):  # rejects, then the two writes of the merge
        assert loaded(f"dies{fail_at}", fail_at) == undisturbed


def test_a_feed_without_documents_leaves_no_rows(spark, tmp_path, tools):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landing = tmp_path / "landing"
    land(landing / "articles", feed(0))
    land(landing / "blogs", feed(0))
    refresh(warehouse, str(landing), *tools, sources=["articles", "blogs"], run_id="one", policy="flag_only")
    refresh(warehouse, str(landing), *tools, sources=["blogs"], run_id="two", policy="flag_only")
    for name in ("analysis", "trends", "sources", "topic_terms"):
        assert rows(warehouse.table(name).select("source").distinct()) == [("articles",)]
    assert rows(spark.read.parquet(warehouse.path("fact_article")).select("source").distinct()) == [("articles",)]


def test_the_stream_takes_no_other_policy(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_feed(Warehouse(spark, str(tmp_path)), "articles", str(tmp_path), str(tmp_path / "c"), "flag_only")


def test_intermediate_tables_are_deleted(spark, tmp_path):
    with dropping(spark):
        kept = cut_lineage(spark.range(3))
        [path] = {f.rpartition("/")[0] for f in kept.inputFiles()}
        assert kept.count() == 3
    assert not tables.exists(spark, path)
