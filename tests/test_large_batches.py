from conftest import rows
from pyspark.sql import functions as F
from test_feeds import document, land

from newsloom.operators.lookup import Limits, frequency_join, heavy_keys, least_frequent, lookup_join
from newsloom.operators.terms import tfidf
from newsloom.plans import bronze
from newsloom.plans.bronze import load_feed
from newsloom.plans.warehouse import Warehouse

LATER = "2025-06-01T00:00:00Z"
NONE = Limits(table_bytes=0, heavy_keys=3)


def test_without_heavy_keys_the_join_is_plain(spark):
    facts = spark.range(200).select(F.concat(F.lit("k"), F.col("id") % 50).alias("key"), "id")
    table = spark.range(40).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("v"))
    joined = lookup_join(facts, table, ["key"], "left", limits=NONE)
    assert joined.groupBy("v").count().orderBy("v").collect() == [(None, 40), (1, 160)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_heavy_keys_are_exact(spark):
    for limit in (1, 2, 3, 10, 40):
        counts = {"a": 61, None: 30, "b": 25, **{f"k{i}": 1 + i % 3 for i in range(40)}}
        facts = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "key string").repartition(3)
        heavy, any_heavy = heavy_keys(facts, ["key"], Limits(heavy_keys=limit))
        want = sorted([(k,) for k, n in counts.items() if n * limit > sum(counts.values())], key=repr)
        assert rows(heavy) == want and any_heavy == bool(want)


def test_a_batch_too_large_to_broadcast_meets_the_files_in_one_aggregate(spark, tmp_path, monkeypatch):
    batches = [
        [document(i) for i in range(12)],
        [document(i, updated_at=LATER) for i in range(0, 12, 2)] + [document(3, updated_at="2020-01-01T00:00:00Z"), document(20)],
        [document(0, updated_at=None), document(20, updated_at=LATER), document(20, updated_at="2025-05-01T00:00:00Z")],
    ]
    seen = []
    for large in (False, True):
        warehouse = Warehouse(spark, str(tmp_path / f"w{large}"))
        if large:
            monkeypatch.setattr(bronze, "INDEXED_KEYS", 0)
            monkeypatch.setattr(bronze, "stored_versions", None)  # is not asked
        for i, batch in enumerate(batches):
            load_feed(warehouse, "articles", land(tmp_path / f"in{large}{i}", batch), f"r{i}", limits=NONE if large else Limits())
        seen.append(rows(warehouse.table("bronze", "articles").select("id", "updated_at", "is_active")))
        seen.append(rows(warehouse.table("retired", "articles").select("id", "updated_at")))
    assert seen[0] == seen[2] and seen[1] == seen[3] and len(seen[1]) == 7


def test_frequent_terms_are_broadcast_as_far_as_the_limit_goes(spark):
    counts = {f"t{i}": 1 + i for i in range(30)}
    facts = spark.createDataFrame([(k, j) for k, n in counts.items() for j in range(n)], "term string, doc int")
    table = spark.createDataFrame(list(counts.items()), "term string, df long")
    want = sorted((k, j, n) for k, n in counts.items() for j in range(n))
    leasts = []
    for size, heavy in ((0, 1), (0, 40), (100, 1), (400, 1), (10**6, 1)):
        limits = Limits(table_bytes=size, heavy_keys=heavy)
        joined = frequency_join(facts, table, ["term"], "df", limits).select("term", "doc", "df")
        assert sorted(tuple(r) for r in joined.collect()) == want
        leasts.append(least_frequent(table, "df", limits))
    assert leasts[0] is None and leasts[1] == sum(counts.values()) // 40 + 1 and leasts[2] > leasts[3] > leasts[4] == 1
    plan = frequency_join(facts, table, ["term"], "df", Limits(table_bytes=400))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "broadcast" not in plan  # only what the frequent terms have left over is joined


def test_weights_beyond_the_limit(spark):
    documents = spark.createDataFrame([(1, "moon moon base"), (2, "moon mars"), (2, "mars again"), (None, "base"), (4, None)], "doc_id long, summary string")
    within, beyond = (tfidf(documents, key=["doc_id"], stop_words=(), limits=limits) for limits in (Limits(), Limits(60, 5)))
    assert within.columns == beyond.columns and rows(within) == rows(beyond) and within.count() == 6
