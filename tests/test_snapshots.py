import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_feeds import document, land

from newsloom.operators import keys
from newsloom.operators.lookup import Limits
from newsloom.plans import silver
from newsloom.plans.bronze import files_with, load_feed, named
from newsloom.plans.compaction import compact
from newsloom.plans.silver import changes_since, refresh_trends
from newsloom.plans.warehouse import Warehouse
from newsloom.sources import feeds, snapshots, tables
from newsloom.sources.snapshots import Conflict, Snapshots

LATER = "2025-06-01T00:00:00Z"


def members(spark, name, n):
    return spark.range(0, n, 1, 1).select(
        F.lit(name).alias("source"), F.col("id").cast("string").alias("news_site"), F.lit("").alias("domain_url"), F.lit(1).cast("long").alias("count")
    )


def put(warehouse, name, n, replace=False):
    change = warehouse.change()
    if replace:
        change.remove("sources", change.of("sources", f"source={name}/"))
    change.append(members(warehouse.spark, name, n), "sources", ["source"])
    return change.commit()


def sizes(warehouse):
    return dict(rows(warehouse.stored("sources").groupBy("source").count()))


def test_readers_keep_to_their_version(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    first = put(warehouse, "a", 3)
    pinned = warehouse.at()
    frame = pinned.stored("sources")
    put(warehouse, "b", 2)
    put(warehouse, "a", 5, replace=True)
    assert sizes(warehouse) == {"a": 5, "b": 2} and sizes(pinned) == {"a": 3} and frame.count() == 3
    assert sizes(warehouse.at(first.version + 1)) == {"a": 3, "b": 2}
    with pytest.raises(ValueError):
        warehouse.at(99).stored("sources")
    assert warehouse.snapshots().vacuum(["sources"], keep=1, older_than=3600) == 0
    assert warehouse.snapshots().vacuum(["sources"], keep=1, older_than=0) == 1
    assert sizes(warehouse) == {"a": 5, "b": 2} and len(list((tmp_path / "w").glob("sources/source=a/*.parquet"))) == 1


def test_of_two_commits_one_is_second(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    put(warehouse, "a", 3)
    one, two = warehouse.change(), warehouse.change()
    rival = warehouse.change(["sources/source=a/"])
    for change, name in ((one, "b"), (two, "c"), (rival, "d")):
        change.append(members(spark, name, 1), "sources", ["source"])
    one.remove("sources", one.of("sources", "source=a/"))
    two_removes = warehouse.change()
    two_removes.remove("sources", two_removes.of("sources", "source=a/"))
    one.commit()
    assert two.commit().version == 4 and sizes(warehouse) == {"b": 1, "c": 1}
    for late in (two_removes, rival):
        with pytest.raises(Conflict):
            late.commit()
    assert sizes(warehouse) == {"b": 1, "c": 1}


def test_many_versions(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    base = store.read()
    for i in range(70):
        base = store.commit(base, {"t": [f"t/{i}"]}, {"t": [f"t/{i - 10}"]} if i >= 10 else {}, {"last": i})
    assert store.read() == base and base.of("t") == sorted(f"t/{i}" for i in range(60, 70)) and base.marks == {"last": 69}
    assert store.read(40).marks == {"last": 39} and len(store.read(40).files["t"]) == 10


def test_tables_from_before_are_taken_over(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    tables.append(members(spark, "a", 2), warehouse.path("sources"), ["source"])
    assert sizes(warehouse) == {"a": 2}
    put(warehouse, "b", 1)
    assert sizes(warehouse) == {"a": 2, "b": 1}


@pytest.mark.parametrize("kind", ["load", "compact"])
def test_dying_between_any_two_writes_changes_nothing(spark, tmp_path, monkeypatch, kind):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [document(1), document(2)]), "one")
    load_feed(warehouse, "articles", land(tmp_path / "b", [document(2, updated_at=LATER)]), "two")
    more = land(tmp_path / "c", [document(1, updated_at=LATER, news="x"), document(3)])

    def seen():
        return [rows(warehouse.table(n).drop("ingested_at", "fields", "run_id", "modified_at", "path")) for n in ("bronze", "retired", "ledger", "rescued")]

    def act():
        if kind == "load":
            load_feed(warehouse, "articles", more, "three")
        else:
            compact(warehouse, "articles", "four", files_per_month=1)

    before, append, create = seen(), tables.append, Snapshots._create
    writes = []

    def dies(*given):
        writes.append(given)
        if len(writes) == fail_at:
            raise RuntimeError("killed")
        return (create if isinstance(given[0], Snapshots) else append)(*given)

    monkeypatch.setattr(tables, "append", dies)
    monkeypatch.setattr(Snapshots, "_create", dies)
    for fail_at in range(1, 20):
        writes.clear()
        try:
            act()
            break
        except RuntimeError:
            assert seen() == before
    assert fail_at == (7 if kind == "load" else 4) + 1
    after = seen()
    if kind == "load":
        assert after != before and len(after[0]) == 5 and len(after[3]) == 1
    else:
        assert after[0] == before[0] and after[1] == []


def test_a_second_run_opens_the_new_page_only(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    folder = land(tmp_path / "in", [document(1)])
    load_feed(warehouse, "articles", folder, "one")
    read, landed = [], feeds.landed_pages
    monkeypatch.setattr(feeds, "landed_pages", lambda spark, paths, *more: (read.append(paths), landed(spark, paths, *more))[1])
    load_feed(warehouse, "articles", folder, "two")
    assert read == []
    land(tmp_path / "in", [document(2, updated_at="2020-01-01T00:00:00Z")])  # late
    load_feed(warehouse, "articles", folder, "three")
    assert [[os.path.basename(p) for p in paths] for paths in read] == [["page1.json"]]
    page = json.dumps({"results": [document(1, updated_at=LATER)]})
    (tmp_path / "in" / "page0.json").write_text(page + "\n")  # written anew
    load_feed(warehouse, "articles", folder, "four")
    assert [os.path.basename(p) for p in read[-1]] == ["page0.json"]
    assert rows(warehouse.table("bronze").select("id", "is_active")) == [("1", False), ("1", True), ("2", True)]
    assert dict(rows(warehouse.stored("ledger").groupBy("run_id").count())) == {"one": 1, "three": 1, "four": 1}
    audit = warehouse.table("audit").filter("stage = 'merge'").select("run_id", "record_count")
    assert dict(rows(audit)) == {"one": 1, "two": 0, "three": 1, "four": 1}


def test_compaction(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for i in range(3):
        stamp = f"2025-0{i + 4}-01T00:00:00Z"
        load_feed(warehouse, "articles", land(tmp_path / f"{i}", [document(1, updated_at=stamp), document(10 + i)]), f"r{i}")
    load_feed(warehouse, "blogs", land(tmp_path / "x", [document(1)]), "b")
    old = warehouse.at()
    before = rows(warehouse.table("bronze").drop("ingested_at"))
    assert warehouse.stored("retired").count() == 2
    assert compact(warehouse, "articles", "c", files_per_month=1) == ["2025-03"]
    assert rows(warehouse.table("bronze").drop("ingested_at")) == before == rows(old.table("bronze").drop("ingested_at"))
    assert warehouse.stored("retired").count() == 0 and len(warehouse.snapshot().of("bronze", "source=articles/")) == 1
    assert {r["file"] for r in warehouse.stored("bronze_keys", "articles").select("file").collect()} == {
        named(f) for f in warehouse.snapshot().of("bronze", "source=articles/")
    }
    assert compact(warehouse, "articles", "c", files_per_month=1) == []
    load_feed(warehouse, "articles", land(tmp_path / "y", [document(1, updated_at="2025-08-01T00:00:00Z")]), "r9")
    assert rows(warehouse.table("bronze", "articles").filter("is_active").select("id")) == [("1",), ("10",), ("11",), ("12",)]


def test_a_batch_opens_the_files_that_may_hold_its_keys(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for i in range(6):
        pages = [document(100 * i + j, published_at=f"2024-0{1 + i}-01T00:00:00Z") for j in range(40)]
        load_feed(warehouse, "articles", land(tmp_path / f"{i}", pages), f"r{i}")
    files = warehouse.snapshot().of("bronze")
    assert len(files) == 6
    ids = spark.createDataFrame([("105",), ("139",), ("520",), ("999",)], "id string")
    opened = files_with(warehouse, "articles", ids)
    assert [f.split("published_month=")[1][:7] for f in opened] == ["2024-02", "2024-06"]
    assert files_with(warehouse, "articles", ids, most=3) == files
    load_feed(warehouse, "articles", land(tmp_path / "n", [document(105, updated_at=LATER), document(700)]), "n")
    assert rows(warehouse.table("bronze").filter("id in ('105', '700')").select("id", "is_active")) == [
        ("105", False), ("105", True), ("700", True),
    ]


@pytest.mark.parametrize("n", [5, 40_000])
def test_the_index_misses_no_file(spark, n):
    held = spark.range(n).select(F.pmod("id", F.lit(7)).alias("file"), (F.col("id") * 977).cast("string").alias("id"))
    index = keys.key_index(held, "id", ["file"], n / 7).withColumnRenamed("file", "name")
    asked = spark.range(0, n * 977, 977 * max(1, n // 40)).select(F.col("id").cast("string").alias("id"))
    want = held.join(asked, "id").select("file").distinct()
    assert set(rows(want)) <= set(rows(keys.holding(index, asked, "id", "name")))
    absent = spark.range(200).select((F.col("id") * 977 + 1).cast("string").alias("id"))
    apart = keys.holding(index, absent.limit(1), "id", "name").count()
    assert apart <= 1


def test_readers_of_bronze_store_keys_only(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [document(i) for i in range(20)]), "one")
    load_feed(warehouse, "articles", land(tmp_path / "b", [document(i, updated_at=LATER) for i in range(20)]), "two")
    from newsloom.operators import lookup

    stored, cut = [], lookup.cut_lineage
    monkeypatch.setattr(lookup, "cut_lineage", lambda df: (stored.append(df.columns), cut(df))[1])
    found = warehouse.table("bronze", "articles", limits=Limits(table_bytes=0, heavy_keys=3))
    assert rows(found.groupBy("is_active").count()) == [(False, 20), (True, 20)]
    assert stored == [["source", "id", "updated_at"]]


def test_counts_follow_batches(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    other = Warehouse(spark, str(tmp_path / "o"))
    batches = [
        [document(1, title="moon base"), document(2, title="moon")],
        [document(1, title="mars base", updated_at=LATER, news_site="New"), document(3, title="moon", published_at=None)],
        [document(1, title="moon moon", updated_at="2025-07-01T00:00:00Z"), document(2, title="old", updated_at="2020-01-01T00:00:00Z")],
        [document(9, title="sun")],
    ]
    monkeypatch.setattr(silver, "COUNT_FILES", 2)
    for i, batch in enumerate(batches):
        folder = land(tmp_path / f"in{i}", batch)
        for w in (warehouse, other):
            load_feed(w, "articles", folder, f"r{i}")
        assert (changes_since(warehouse.at(), "articles") is None) == (i == 0)
        refresh_trends(warehouse, "articles", f"t{i}")
        if i == 2:
            compact(warehouse, "articles", "c", files_per_month=1)
            refresh_trends(warehouse, "articles", "again")
    refresh_trends(other, "articles", "whole")
    for name in ("trends", "sources"):
        found = rows(warehouse.table(name))
        assert found == rows(other.table(name)) and found
    refresh_trends(warehouse, "articles", "words", ["moon"])
    assert warehouse.table("trends").filter("word = 'moon'").count() == 0 and warehouse.table("trends").filter("word = 'sun'").count() == 1


def test_changes_read_the_files_of_the_batch(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load_feed(warehouse, "articles", land(tmp_path / "a", [document(i, published_at=f"2024-0{1 + i}-01T00:00:00Z") for i in range(8)]), "one")
    refresh_trends(warehouse, "articles", "t")
    load_feed(warehouse, "articles", land(tmp_path / "b", [document(3, updated_at=LATER)]), "two")
    added, lost = changes_since(warehouse.at(), "articles")
    assert len(added.inputFiles()) == 1 and rows(added.select("id")) == [("3",)]
    assert len([f for f in lost.inputFiles() if "/w/bronze/" in f]) == 2 and rows(lost.select("id")) == [("3",)]


def test_broken_pages_keep_their_text(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    folder = land(tmp_path / "in", [document(1)])
    long = "{ not json " + "x" * 5000
    (tmp_path / "in" / "bad.json").write_text(long + "\n\n")
    (tmp_path / "in" / "none.json").write_text('{"detail": "throttled"}\n')
    load_feed(warehouse, "articles", folder, "one")
    assert rows(warehouse.table("rejects").select("title", "page")) == sorted([
        ("no results", '{"detail": "throttled"}'), (long[:1000], long),
    ])


def test_unknown_fields_are_kept(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    folder = land(tmp_path / "in", [document(1, mood="good", deep={"a": [1, None]}), document(2)])
    load_feed(warehouse, "articles", folder, "one")
    found = warehouse.table("rescued").select("source", "id", F.to_json("fields"))
    assert rows(found) == [("articles", "1", '{"deep":{"a":[1,null]},"mood":"good"}')]
    assert dict(rows(warehouse.table("audit").filter("stage IN ('rescued', 'merge')").select("stage", "record_count"))) == {"rescued": 1, "merge": 2}


def test_a_store_without_versions(spark, tmp_path):
    assert Snapshots(spark, str(tmp_path / "none")).read() == snapshots.Snapshot()
    assert Snapshots(spark, str(tmp_path / "none")).vacuum(["bronze"]) == 0
