import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm.negatives import Block, coded, hard_negatives, rotated, whole_numbers

SCHEMA = "vec_id long, label int, embedding array<float>, row int"


def plain(rows, positives=5, negatives=5):
    some = []
    for vec_id, label, vec, _ in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        some.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vec]))
    out = []
    for i, (anchor, label, a) in enumerate(some):
        if anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), other, j, kind == label) for j, (other, kind, b) in enumerate(some) if j != i]
        scored.sort()
        for minus, positive, _, _ in [s for s in scored if s[3]][:positives]:
            fitting = [s for s in scored if not s[3] and 80 * -minus <= 100 * -s[0] <= 100 * -minus]
            out += [(anchor, positive, k, s[1], -minus, -s[0]) for k, s in enumerate(fitting[:negatives], 1)]
    return sorted(out)


def made(seed, n=700, width=20):
    r, g = random.Random(seed), np.random.RandomState(seed)
    centres = g.normal(size=(6, width))
    rows = []
    for i in range(n):
        vec = (centres[r.randrange(6)] + 0.5 * g.normal(size=width)).astype(np.float32).tolist()
        rows.append((i, r.randrange(4), vec, i))
    for i in range(0, 60, 7):
        rows[i * 5 + 1] = (i * 5 + 1, 1, rows[3][2], 0)  # one vector many times
    rows[10] = (10, None, rows[10][2], 0)
    rows[11] = (11, 1, None, 0)
    rows[12] = (12, 1, [None] + rows[12][2][1:], 0)
    rows[13] = (13, 1, [float("nan")] + rows[13][2][1:], 0)
    rows[14] = (14, 1, [float("-inf")] + rows[14][2][1:], 0)
    rows[15] = (None, 1, rows[15][2], 0)
    rows[16] = (16, 1, [], 0)
    rows[17] = (17, 1, rows[17][2][:5], 0)
    return rows + [rows[100], rows[100], (200, 2, rows[5][2], 0), rows[333]]


@pytest.mark.parametrize("block", [8192, 3])
def test_against_all_pairs(spark, block):
    rows = made(block)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = hard_negatives(frame, block=block)
    assert found.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                            ("positive_score", "bigint"), ("negative_score", "bigint")]
    want = plain(rows)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 50


def test_intervals_hold_and_select():
    g = np.random.RandomState(5)
    centres = g.normal(size=(20, 64)) * 60
    rows = np.rint(centres[g.randint(20, size=1000)] + g.normal(size=(1000, 64)) * 20).astype(np.int64)
    anchors = rows[:30]
    assert np.allclose(np.linalg.norm(rotated(rows), axis=1), np.linalg.norm(rows, axis=1))
    block = Block(np.arange(30), np.arange(30), np.array(["a"] * 30, object), anchors)
    low, high = block.intervals(slice(0, 30), *coded(rows))
    exact = anchors @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    fifth = np.sort(low, axis=1)[:, -5]
    assert (high >= fifth[:, None]).mean() < 0.2


def test_no_anchor_and_no_row(spark):
    frame = spark.createDataFrame(made(1)[1:90], SCHEMA)
    assert hard_negatives(frame).count() == 0
    assert hard_negatives(frame.limit(0)).count() == 0


def test_too_long_vectors_are_refused(spark):
    frame = spark.createDataFrame([(0, 1, [1e8, 1e8], 0)], SCHEMA)
    with pytest.raises(ValueError):
        hard_negatives(frame)


def test_whole_numbers(spark):
    frame = spark.createDataFrame([(1, 3, [0.5, -0.001, 1.0], 0)], SCHEMA)
    assert whole_numbers(frame, "vec_id", F.col("label"), "embedding").first()["vec"] == [128, -1, 256]
