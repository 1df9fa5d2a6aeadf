import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.operators.lookup import Limits, fits, lookup_join

SKEWED = [("hot", i) for i in range(60)] + [(None, i) for i in range(30)] + [
    (f"k{i % 7}", i) for i in range(40)
]
TABLE = [("hot", 1.0), ("k1", 2.0), ("k2", 3.0), ("absent", 4.0)]


def expected(facts, table, how, null_safe):
    known = dict(table)
    found = lambda key: key in known and (key is not None or null_safe)
    if how == "left_semi":
        return sorted([f for f in facts if found(f[0])], key=repr)
    if how == "left_anti":
        return sorted([f for f in facts if not found(f[0])], key=repr)
    joined = [(*f, known[f[0]] if found(f[0]) else None) for f in facts if how == "left" or found(f[0])]
    return sorted(joined, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_same_result_with_and_without_broadcast(spark, limits, how, null_safe):
    table = [*TABLE, (None, 5.0)]
    facts = spark.createDataFrame(SKEWED, "key string, n int").repartition(3)
    lookup = spark.createDataFrame(table, "key string, v double")
    joined = lookup_join(facts, lookup, ["key"], how, null_safe, limits)
    assert rows(joined) == expected(SKEWED, table, how, null_safe)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 9)), min_size=1))
def test_split_join_equals_brute_force(spark, facts):
    frame = spark.createDataFrame(facts, "key string, n int")
    lookup = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "key string, v double")
    joined = lookup_join(frame, lookup, ["key"], "left", limits=Limits(table_bytes=0, heavy_keys=3))
    assert rows(joined) == expected(facts, [("a", 1.0), ("c", 2.0)], "left", False)


def test_two_keys(spark, limits):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "x string, y int")
    lookup = spark.createDataFrame([("a", 1, "found")], "x string, y int, v string")
    assert rows(lookup_join(facts, lookup, ["x", "y"], "left", limits=limits)) == [
        ("a", 1, "found"), ("a", 2, None), ("b", 1, None),
    ]


def test_size_is_measured(spark):
    table = spark.range(1000).select(F.concat(F.lit("word"), "id").alias("key"))
    assert fits(table, Limits(table_bytes=1 << 20))
    assert not fits(table, Limits(table_bytes=100))
    assert fits(table.limit(0), Limits(table_bytes=0))


def test_hot_keys_are_not_shuffled(spark):
    facts = spark.createDataFrame(SKEWED, "key string, n int")
    lookup = spark.createDataFrame(TABLE, "key string, v double")
    joined = lookup_join(facts, lookup, ["key"], limits=Limits(table_bytes=0, heavy_keys=3))
    assert rows(joined) == expected(SKEWED, TABLE, "inner", False)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 3
