import random
import re

import pytest

from newsloom.llm import cascade
from newsloom.llm.cascade import METRICS, RULES, View, quality_rules, rule_order


def plain_metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    copies = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), copies, len(inside)


def made(seed):
    r = random.Random(seed)
    words = "a bb the of é😀 x## !! 12 word|\n \t \x0b \x1c STOP!! \n\n".split(" ")
    return " ".join(r.choices(words, k=r.randrange(0, 120)))


TEXTS = [*map(made, range(60)), None, "", " \n\t", "same\nsame\nsame", "x " * 60, " ".join(f"w{i}" for i in range(50)), "w" * 100_000]


def test_metrics_and_verdicts(spark):
    rows = [(None if i == 3 else i // 2, t, "old", "c") for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words string")
    judged = quality_rules(frame, rule_order(frame), metrics=METRICS)
    assert judged.columns == ["doc_id", "text", *METRICS, "kept"]
    got = sorted(map(tuple, judged.collect()), key=repr)
    want = [(i, t, *plain_metrics(t), not any(r.rejects(View(t)) for r in RULES)) for i, t, _, _ in rows]
    assert got == sorted(want, key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_order_is_by_rejections_per_cost(spark):
    frame = spark.createDataFrame([("text",)] * 50, "text string")
    rules = {"never": lambda v: False, "slow": lambda v: sum(range(20_000)) > 0, "quick": lambda v: True}
    order = rule_order(frame, [cascade.Rule(name, rejects) for name, rejects in rules.items()])
    assert [r.name for r in order] == ["quick", "slow", "never"]


def test_stops_at_the_first_rejection(spark):
    def fails(v):
        raise AssertionError("not reached")

    frame = spark.createDataFrame([("text",)], "text string")
    rules = [cascade.Rule("rejects", lambda v: True), cascade.Rule("fails", fails)]
    assert [r["kept"] for r in quality_rules(frame, rules).collect()] == [False]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_labelled_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    rows = quality_rules(docs, RULES, metrics=["n_words"]).join(labels, "doc_id").collect()
    assert not [r["doc_id"] for r in rows if r["quality"] == 0 and r["kept"]]
    assert not [r["doc_id"] for r in rows if r["quality"] == 1 and not r["kept"] and r["n_words"] >= 50]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rule_order(empty) == list(RULES)
    assert quality_rules(empty, RULES).count() == 0
