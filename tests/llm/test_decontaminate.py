import random
import re

import numpy as np

from newsloom.llm.decontaminate import AGREE, MASKS, MIN_ITEM, MIN_SAME, best_overlap, overlaps, without_overlaps


def tokens(text):
    return [t for t in re.split(r"[^\w]|_", (text or "").lower()) if t]


def plain_overlap(doc, item):
    """The most agreeing tokens over all alignments that have a hit, of any stretch that agrees enough."""
    best = 0
    for shift in range(-len(item), len(doc)):
        same = [0 <= i + shift < len(doc) and doc[i + shift] == t for i, t in enumerate(item)]
        hit = any(
            i + shift >= 0 and i + len(m) <= len(item) and i + shift + len(m) <= len(doc)
            and all(same[i + p] for p, one in enumerate(m) if one == "1")
            for m in MASKS for i in range(len(item))
        )
        if not hit:
            continue
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        for a in range(low, high):
            for b in range(a + 1, high + 1):
                n = sum(same[a:b])
                if n >= min(MIN_SAME, AGREE * len(item)) and n >= AGREE * (b - a):
                    best = max(best, n)
    return best


def made(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "É"]
    items = [" ".join(r.choices(vocabulary, k=r.randrange(3, 40))) for _ in range(12)]
    items += [items[0], None, "", "the of"]
    docs = []
    for n in range(60):
        words = r.choices(vocabulary, k=r.randrange(0, 80))
        if n % 2:
            part = items[r.randrange(12)].split(" ")
            part = [r.choice(vocabulary) if r.random() < 0.1 * (n % 3) else w for w in part[r.randrange(0, 5) :]]
            words[10:10] = part
        docs.append((", " if n % 5 else " ").join(words).replace("w1 ", "W1 "))
    return docs + [None, "", docs[1]], items


def test_against_every_alignment(spark):
    docs, items = made(3)
    rows = [(None if i == 7 else i, t, "x", 1) for i, t in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id string, n_same int")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in overlaps(frame, bench).collect()}
    seen = {}
    for i, text in enumerate(items):
        words = tokens(text)
        if len(words) >= MIN_ITEM and tuple(words) not in seen.values():
            seen[i] = tuple(words)
    want = {}
    for i, text, _, _ in rows:
        for j, words in seen.items():
            if n := plain_overlap(tokens(text), list(words)):
                want[i, j] = n
    assert {k: r["n_same"] for k, r in found.items()} == want and len(want) > 15
    for key, r in found.items():
        doc, item = tokens(rows[key[0]][1] if key[0] is not None else docs[7]), list(seen[key[1]])
        span = range(r["n_tokens"])
        assert sum(doc[r["doc_token"] + k] == item[r["item_token"] + k] for k in span) == r["n_same"]
    dirty = {k[0] for k in found}
    kept = without_overlaps(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if r[0] not in dirty), key=repr)
    assert without_overlaps(frame, bench, broadcast_bytes=-1).count() == kept.count()


def test_best_stretch():
    item = np.arange(20, dtype=np.int64)
    doc = np.concatenate([np.full(5, -1), item])
    doc[10] = -1
    assert best_overlap(doc, item, 5) == (0, 20, 19)
    assert best_overlap(doc, item, 500) == (0, 0, 0)
    two = np.where((item == 8) | (item == 9), -1, item)  # two parts of which neither is long enough
    assert best_overlap(two, item[:18], 0) == (0, 18, 16)


def test_planted_passages_and_long_text(spark):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = bench.first()["text"]
    rows = [(1, "word " * 60_000 + item), (2, item.upper()), (3, "nothing here"), (4, "x" * 300_000)]
    found = overlaps(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {r["doc_id"] for r in found.collect()} == {1, 2}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    assert overlaps(docs.limit(0), bench).count() == 0
    assert overlaps(docs, bench.limit(0)).count() == 0
    assert without_overlaps(docs, bench.limit(0)).count() == 1


def test_null_and_repeated_item_ids(spark):
    items = [" ".join(f"{name}{k}" for k in range(14)) for name in "abcd"]
    bench = spark.createDataFrame(list(zip([None, None, 5, 5], items)), "item_id long, text string")
    rows = [(1, "x y " + items[0] + " z"), (2, items[1]), (3, items[2] + " so " + items[3]), (4, "x y z"), (None, items[0] + " " + items[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["item_id"], r["doc_token"], r["n_same"]) for r in overlaps(docs, bench).collect()), key=repr)
    assert found == [
        (1, None, 2, 14), (2, None, 0, 14), (3, 5, 0, 14), (3, 5, 15, 14), (None, None, 0, 14), (None, None, 14, 14)]
    assert [r["doc_id"] for r in without_overlaps(docs, bench).collect()] == [4]
