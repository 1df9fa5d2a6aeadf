import random

import corpus_pipeline
import pytest
from newsloom.llm.simhash import simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents of every kind, a benchmark and labels, as a small scale."""
    r = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "lu") for b in ("ra", "se", "ti") for c in ("n", "m", "", "s", "l")]

    def prose(n):
        return "\n".join(" ".join(r.choices(words, k=9)) + "." for _ in range(n // 9 + 1))

    items = [" ".join(r.choices(words, k=20)) for _ in range(3)]
    base = prose(200)
    texts = [prose(r.randrange(60, 300)) for _ in range(60)]
    texts += [base, base, base.replace(words[0], words[0], 1) + " end", prose(90) + "\n" + items[1] + "\n" + prose(90)]
    texts += [None, "", "too short", "spam ## " * 50, "again and again " * 40, prose(5000)]
    texts = [t if not t or i % 3 else t + "\nsubscribe to our letter" for i, t in enumerate(texts)]
    rows = [(i, t, "en", None if i % 7 == 0 else "site", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (None, prose(100), None, None, None)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages(spark, sf_dir, tmp_path):
    folder, rows, items = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [rows]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
            kept.append([tuple(row) for row in docs.collect()])
    rules, lines, near, clean = kept[1:]
    rejected = {r[0] for r in rows} - {r[0] for r in rules}
    assert rejected == {64, 65, 66, 67, 68} and len(rules) == len(rows) - 5
    assert len(lines) == len(rules) and {r[0]: r[1] for r in lines} == {
        i: t.replace("\nsubscribe to our letter", "") if s == "site" else t for i, t, _, s, _ in rules}
    groups = {}
    for row in lines:
        for f in groups:
            if (f ^ simhash(row[1].encode())).bit_count() <= 3:
                groups[f].append(row[0])
                break
        else:
            groups[simhash(row[1].encode())] = [row[0]]
    assert sorted((r[0] for r in near), key=repr) == sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)
    assert [r[0] for r in near].count(1) == 1 and 61 not in {r[0] for r in near}
    assert {r[0] for r in near} - {r[0] for r in clean} == {63} and len(near) == len(clean) + 1
    packed = docs.collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in clean}
    assert sum(r["length"] for r in packed) == sum({r["doc_id"]: r["doc_tokens"] for r in packed}.values())


def test_run(spark, sf_dir):
    folder, _, _ = sf_dir
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 60 and "ids" in found.columns
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_rules" and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf_dir, tmp_path):
    folder, _, _ = sf_dir
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
