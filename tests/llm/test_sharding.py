import random
import zlib

import numpy as np

from newsloom.llm.sharding import place, shard


def test_near_equal_and_whole_groups(spark):
    r = random.Random(6)
    texts = [None, "", "é😀"] + ["w " * r.randrange(1, 400) + str(i) for i in range(900)]
    texts += ["copy " * 20] * 400 + ["pair"] * 2
    rows = [(None if i == 5 else i // 2, t, "x", 7) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, law string, slot int").repartition(4)
    found = shard(frame, ["doc_id", "text", "slot"], shards=8).toPandas()
    assert len(found) == len(rows) and set(found["law"]) == {"bytes"}
    for t, size, crc in zip(found["text"], found["size"], found["text_crc32"]):
        raw = (t or "").encode()
        assert size == len(raw) + 16 and crc == zlib.crc32(raw)
    loads = found.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() <= found["size"].max()
    for _, slots in found.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    spread = found.assign(text=found["text"].fillna("")).groupby("text")["shard"].nunique()
    assert set(spread[spread > 1].index) <= {"copy " * 20}


def test_dot_product_places_opposites_together():
    vectors = np.array([[8, 1], [1, 8], [8, 1], [1, 8]], float)
    found = place(vectors, 2)
    assert len(set(found[[0, 2]])) == 2 and len(set(found[[1, 3]])) == 2


def test_hot_text(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    found = shard(frame, ["doc_id"], shards=5).toPandas()
    assert sorted(found["doc_id"]) == list(range(3000))
    loads = found.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= 100


def test_many_rows_of_few_bytes_stay_together(spark):
    text = "if(id % 3 = 0, '', repeat(concat(id, ' words of a text that has some weight '), 30))"
    frame = spark.range(6000).selectExpr("id AS doc_id", f"{text} AS text")
    found = shard(frame, ["doc_id", "text"]).toPandas()
    assert sorted(found["doc_id"]) == list(range(6000))
    assert found[found["text"] == ""]["shard"].nunique() == 1
    loads = found.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= 2 * found["size"].max()


def test_empty_table(spark):
    assert shard(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0
