import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.operators import merge

KEY = ["id"]


def versions(spark, *given, active=None):
    frame = spark.createDataFrame(given, "id string, title string, day int")
    frame = frame.select("id", "title", F.timestamp_seconds(F.col("day") * 86400).alias("updated_at"))
    return frame if active is None else frame.withColumn("is_active", F.lit(active))


def told(frame):
    day = (F.unix_seconds("updated_at") / 86400).cast("int")
    return rows(frame.select("id", "title", day, "is_active"))


@pytest.fixture
def stage(spark):
    return versions(spark, ("a", "a5", 5), ("b", "b5", 5), ("c", "c5", 5), active=True).unionByName(
        versions(spark, ("a", "a1", 1), active=False)
    )


@pytest.fixture
def incoming(spark):
    return versions(
        spark, ("a", "a7", 7), ("a", "a6", 6), ("b", "b5 again", 5), ("d", "d1", 1), ("d", "d2", 2),
        ("d", "d2", 2),
    )


def test_history(stage, incoming, limits):
    assert told(merge.merge_history(stage, incoming, KEY, limits=limits)) == [
        ("a", "a1", 1, False), ("a", "a5", 5, False), ("a", "a7", 7, True),
        ("b", "b5", 5, True), ("c", "c5", 5, True), ("d", "d2", 2, True),
    ]


def test_history_twice_is_once(stage, incoming, limits):
    once = merge.merge_history(stage, incoming, KEY, limits=limits)
    assert told(merge.merge_history(once, incoming, KEY, limits=limits)) == told(once)


def test_history_compares_with_inactive_versions_too(spark, limits):
    stage = versions(spark, ("a", "a9", 9), active=False)
    merged = merge.merge_history(stage, versions(spark, ("a", "a8", 8)), KEY, limits=limits)
    assert told(merged) == [("a", "a9", 9, False)]


def test_history_of_unknown_versions(spark, limits):
    stage = versions(spark, ("a", "none", None), ("b", "none", None), active=True)
    merged = merge.merge_history(
        stage, versions(spark, ("a", "a1", 1), ("b", "again", None), ("c", "c", None)), KEY, limits=limits
    )
    assert told(merged) == [
        ("a", "a1", 1, True), ("a", "none", None, False), ("b", "none", None, True), ("c", "c", None, True),
    ]


def test_flag_only(stage, incoming, limits):
    assert told(merge.merge_flag_only(stage, incoming, KEY, limits=limits)) == [
        ("a", "a1", 1, False), ("a", "a5", 5, False), ("b", "b5", 5, False), ("c", "c5", 5, True),
        ("d", "d2", 2, True),
    ]


def test_empty_stage_is_a_first_load(spark, stage, incoming, limits):
    for policy in (merge.merge_history, merge.merge_flag_only):
        merged = policy(stage.limit(0), incoming, KEY, limits=limits)
        assert told(merged) == [("a", "a7", 7, True), ("b", "b5 again", 5, True), ("d", "d2", 2, True)]


def test_latest_of_a_hot_key_and_equal_versions(spark):
    many = versions(spark, *[("hot", f"t{i}", i % 50) for i in range(500)], ("cold", "c", None))
    latest = merge.latest_versions(many, KEY)
    assert rows(latest.select("id")) == [("cold",), ("hot",)]
    again = merge.latest_versions(many.repartition(7, "title"), KEY)
    assert rows(latest) == rows(again)


def test_integer_flags_become_boolean(spark, limits):
    stage = versions(spark, ("a", "a", 1), ("b", "b", 1)).withColumn("is_active", F.lit(1))
    marked = merge.mark_superseded(stage, versions(spark, ("a", "x", 0), ("a", "y", 0)), KEY, limits)
    assert told(marked) == [("a", "a", 1, False), ("b", "b", 1, True)]


def test_new_rows_keep_copies(spark, stage, incoming, limits):
    assert rows(merge.new_rows(stage, incoming, KEY, limits).select("title")) == [("d1",), ("d2",), ("d2",)]
