from conftest import rows
from pyspark.sql import functions as F

from newsloom.operators import dimensions, trends


def activity(spark, *given):
    return spark.createDataFrame(given, "source string, news_site string, domain_url string, count long")


def test_numbering_is_dense_and_ordered(spark):
    members = spark.range(1000).select(F.format_string("m%04d", "id").alias("name")).repartition(7)
    numbered = dimensions.numbered(members, ["name"], "key", first=10).collect()
    assert sorted((r["key"], r["name"]) for r in numbered) == [(10 + i, f"m{i:04d}") for i in range(1000)]
    assert dimensions.numbered(members.limit(0), ["name"], "key").count() == 0


def test_dim_news_source_keeps_keys(spark, limits):
    first = dimensions.dim_news_source(activity(
        spark, ("articles", "S", "https://s.org", 3), ("blogs", "S", "https://s.org", 1),
        ("articles", None, "", 2), ("articles", "S", "https://s.com", 1),
    ))
    keys = {(r["source"], r["name"], r["url"]): r["source_id"] for r in first.collect()}
    assert sorted(keys.values()) == [1, 2, 3, 4] and keys[("articles", None, "")] == 1
    later = dimensions.dim_news_source(activity(
        spark, ("articles", "A", "https://a.org", 9), ("articles", None, "", 5),
        ("articles", "S", "https://s.org", 4),
    ), first, limits)
    found = {(r["source"], r["name"], r["url"]): (r["source_id"], r["reliability_score"]) for r in later.collect()}
    assert found == {
        ("articles", None, ""): (1, 5), ("articles", "S", "https://s.com"): (2, 1),
        ("articles", "S", "https://s.org"): (3, 4), ("blogs", "S", "https://s.org"): (4, 1),
        ("articles", "A", "https://a.org"): (5, 9),
    }


def test_topics_of_two_feeds_are_two_members(spark):
    topics = spark.createDataFrame(
        [("articles", 0), ("articles", 0), ("blogs", 0), ("blogs", None)], "source string, topic long"
    )
    terms = spark.createDataFrame([("articles", 0, ["x"])], "source string, topic long, top_terms array<string>")
    assert rows(dimensions.dim_topic(topics, terms)) == [(1, "articles", 0, ["x"]), (2, "blogs", 0, None)]


def test_fact_rows_are_not_multiplied(spark, limits):
    analysis = spark.createDataFrame([
        ("articles", "1", "S", "https://s.org", 0, "t"), ("articles", "2", "S", "https://s.com", None, "t"),
        ("blogs", "1", "S", "https://s.org", 0, "t"), ("articles", "3", None, "", 0, "t"),
        ("articles", "4", "unknown", "", 7, "t"),
    ], "source string, id string, news_site string, domain_url string, topic long, title string")
    sites = dimensions.dim_news_source(activity(
        spark, ("articles", "S", "https://s.org", 1), ("articles", "S", "https://s.com", 1),
        ("blogs", "S", "https://s.org", 1), ("articles", None, "", 1),
    ))
    topics = dimensions.dim_topic(analysis.filter("topic = 0").select("source", "topic"))
    fact = dimensions.fact_article(analysis, sites, topics, limits)
    assert rows(fact.select("source", "article_id", "source_id", "topic_id")) == [
        ("articles", "1", 3, 1), ("articles", "2", 2, None), ("articles", "3", 1, 1),
        ("articles", "4", None, None), ("blogs", "1", 4, 2),
    ]


def test_word_trends(spark):
    documents = spark.createDataFrame([
        ("s", "1", "The Moon, the Moon", "2025-01-03 00:00:00"), ("s", "2", "Moon 2", "2025-01-31 23:59:59"),
        ("s", "3", "moon", "2025-02-01 00:00:00"), ("s", "4", "of the", "2025-01-01 00:00:00"),
        ("s", "5", "moon", None), ("r", "1", "moon", None), ("s", "6", None, None),
    ], "source string, id string, title string, at string")
    found = trends.word_trends(documents.withColumn("published_at", F.col("at").cast("timestamp")))
    assert rows(found) == sorted([
        ("s", 2025, 1, "moon", 3), ("s", 2025, 1, "2", 1), ("s", 2025, 2, "moon", 1),
        ("s", None, None, "moon", 1), ("r", None, None, "moon", 1),
    ], key=repr)


def test_source_activity(spark):
    documents = spark.createDataFrame([
        ("s", "1", "A", "https://a.org/x"), ("s", "2", "A", "https://a.org/y"), ("s", "3", "A", "a.org"),
        ("s", "4", None, None),
    ], "source string, id string, news_site string, url string")
    assert rows(trends.source_activity(documents)) == sorted([
        ("s", "A", "https://a.org", 2), ("s", "A", "", 1), ("s", None, None, 1),
    ], key=repr)
