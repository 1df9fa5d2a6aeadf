import itertools

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.operators.topics import assignment, continued, fit_topics, lasting_numbers, likeness

SCHEMA = "topic long, term string, weight double"


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (5, 5), (4, 7), (5, 8)])
def test_assignment_is_the_best(shape):
    r = np.random.RandomState(shape[1])
    for _ in range(40):
        gains = r.choice([0.0, 0.1, 0.5, 0.9, 1.0], shape) + r.rand(*shape) * r.choice([0, 1])
        found = assignment(gains)
        assert len(set(found)) == shape[0]
        best = max(sum(gains[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(shape[1]), shape[0]))
        assert abs(sum(gains[i, c] for i, c in enumerate(found)) - best) < 1e-9


def test_numbers_follow_topics(spark):
    stored = spark.createDataFrame([
        (0, "moon", 0.8), (0, "base", 0.2), (1, "rain", 0.7), (1, "sun", 0.3), (4, "cat", 1.0),
    ], SCHEMA)
    new = spark.createDataFrame([
        (0, "rain", 0.5), (0, "sun", 0.5), (1, "tax", 0.9), (1, "moon", 0.1), (2, "moon", 0.6), (2, "rocket", 0.4), (3, "dog", 1.0),
    ], SCHEMA)
    assert lasting_numbers(new, stored, 4) == [1, 5, 0, 6]
    assert lasting_numbers(new, stored.limit(0), 4) == [0, 1, 2, 3]
    found = {(t, s): v for t, s, v in rows(likeness(new, stored))}
    assert abs(found[0, 1] - (0.35 + 0.15) / (0.5**0.5 * 0.58**0.5)) < 1e-9


def test_a_refit_keeps_numbers(spark):
    words = [f"w{'abcdefghij'[t]}{'klmnopqrst'[i]}x" for t in range(3) for i in range(8)]
    texts = spark.range(240).select(
        F.lit("s").alias("source"), F.col("id").cast("string").alias("id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.get(
            F.array(*map(F.lit, words)), ((F.col("id") % 3) * 8 + F.pmod(F.xxhash64("id", i), F.lit(8))).cast("int")
        ))).alias("summary"),
    )
    first = fit_topics(texts, topics=3, iterations=20, subsampling=0.5)
    stored = first.weights("s")
    second = continued(fit_topics(texts, topics=3, iterations=20, seed=7, subsampling=0.5), stored, "s")
    assert sorted(second.numbers) == [0, 1, 2]
    old = {r["topic"]: set(r["top_terms"]) for r in first.top_terms("s", 8).collect()}
    new = {r["topic"]: set(r["top_terms"]) for r in second.top_terms("s", 8).collect()}
    assert all(len(old[t] & new[t]) >= 6 for t in old)
