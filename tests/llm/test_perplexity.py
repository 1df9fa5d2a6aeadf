import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsloom.llm import perplexity as P


def plain_symbols(text):
    return [26] * 3 + [int(P.symbols()[ord(c)]) for c in text or ""] + [26]


def plain_model(texts):
    """The textbook definition with dictionaries: a function of (context, symbol), contexts as tuples."""
    counts = {4: Counter()}
    for text in texts:
        s = plain_symbols(text)
        counts[4].update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
    for n in (3, 2, 1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    total, kinds, taken = defaultdict(int), {}, {}
    for n in counts:
        taken[n] = P.discounts([sum(c == k for c in counts[n].values()) for k in (1, 2, 3, 4)])
        for gram, c in counts[n].items():
            total[gram[:-1], n] += c
            kinds.setdefault((gram[:-1], n), []).append(min(c, 3))

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / P.SIZE
        below = p(gram[1:])
        if (gram[:-1], n) not in total:
            return below
        d = taken[n]
        c = counts[n][gram]
        kept = c - d[min(c, 3) - 1] if c else 0
        return (kept + sum(d[k - 1] for k in kinds[gram[:-1], n]) * below) / total[gram[:-1], n]

    return p


def made(n, seed):
    r = random.Random(seed)
    words = "the of and Ünd été niño 12 a.b x! # $% 日本 \n".split(" ")
    return [" ".join(r.choices(words, k=r.randrange(0, 30))) for _ in range(n)]


def test_model_against_definition(spark):
    texts = [*made(40, 1), None, "", "\0\t\x0b é"]
    counts = P.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    log_p = P.probabilities(counts)
    p = plain_model(texts)
    r = random.Random(2)
    grams = [tuple(s[i - 3 : i + 1]) for t in made(5, 9) for s in [plain_symbols(t)] for i in range(3, len(s))]
    grams += [tuple(r.randrange(P.SIZE) for _ in range(4)) for _ in range(300)]
    for gram in grams:
        code = sum(x * P.SIZE ** (3 - i) for i, x in enumerate(gram))
        assert log_p[code] == pytest.approx(math.log(p(gram)), rel=1e-4)
    sums = np.exp(log_p.astype(float)).reshape(-1, P.SIZE).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)
    found = P.scored(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), ["i"], log_p).collect()
    for row in found:
        s = plain_symbols(texts[row["i"]])
        assert row["n_symbols"] == len(s) - 3
        want = -sum(math.log(p(tuple(s[k - 3 : k + 1]))) for k in range(3, len(s)))
        assert row["nats"] == pytest.approx(want, rel=1e-4)


def test_held_out(spark):
    """Trained on half of the labelled documents of the test table, judged on the other half."""
    from newsloom.llm.queries import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    found = P.classify(docs, labels.filter("quality = 1 and doc_id % 2 = 0").select("doc_id"))
    rows = found.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_odd_tables(spark):
    schema = "doc_id long, lang string, text string, kept int, score string"
    rows = [(1, "en", "the cat", 0, ""), (1, "en", "the cat", 0, ""), (None, None, None, 0, ""), (2, "xx", "", 0, ""), (3, "en", "z" * 500_000, 0, "")]
    docs = spark.createDataFrame(rows, schema)
    found = P.classify(docs, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"))
    assert found.count() == 5 and all(r["kept"] for r in found.collect() if r["doc_id"] == 1)
    nobody = spark.createDataFrame([], "doc_id long")
    found = P.classify(docs, nobody).collect()
    assert len(found) == 5 and all(r["kept"] and r["threshold"] is None for r in found)
    assert {round(r["perplexity"], 3) for r in found} == {float(P.SIZE)}
    assert P.classify(spark.createDataFrame([], schema), nobody).count() == 0


def cut_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_word_model(texts, order):
    """The textbook definition over words, below them the symbols of the distinct words: nats and symbols of a text."""
    grams = {order: Counter()}
    for text in texts:
        s = ["<s>"] * (order - 1) + cut_words(text) + [""]
        grams[order].update(tuple(s[i - order + 1 : i + 1]) for i in range(order - 1, len(s)))
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(gram[1:] for gram in grams[n + 1])
    spelling = plain_model({w for text in texts for w in [*cut_words(text), ""]})
    total, kinds, taken = defaultdict(int), defaultdict(list), {}
    for n in grams:
        taken[n] = P.discounts([sum(c == k for c in grams[n].values()) for k in (1, 2, 3, 4)])
        for gram, c in grams[n].items():
            total[gram[:-1]] += c
            kinds[gram[:-1]].append(min(c, 3))

    def spelled(word):
        s = plain_symbols(word)
        return math.prod(spelling(tuple(s[i - 3 : i + 1])) if texts else 1 / P.SIZE for i in range(3, len(s)))

    def p(gram):
        n = len(gram)
        below = p(gram[1:]) if n > 1 else spelled(gram[0])
        if gram[:-1] not in total:
            return below
        c = grams[n][gram]
        kept = c - taken[n][min(c, 3) - 1] if c else 0
        return (kept + sum(taken[n][k - 1] for k in kinds[gram[:-1]]) * below) / total[gram[:-1]]

    def nats(text):
        s = ["<s>"] * (order - 1) + cut_words(text) + [""]
        return -sum(math.log(p(tuple(s[i - order + 1 : i + 1]))) for i in range(order - 1, len(s)))

    return nats


@pytest.mark.parametrize("order, most, bits", [(1, 50, 1 << 29), (2, 0, 1 << 29), (3, 100, 1 << 16)])
def test_words_against_definition(spark, order, most, bits):
    texts = [*made(60, 3), None, "", " \n ", "the cat sat", "the cat sat", "КОТ спит 日本 語", "кот спит", "q" * 100, "\xa0 a\x1cb"]
    rows = [(i, None if i % 5 == 0 else "ab"[i % 2], t) for i, t in enumerate(texts)]
    trust = {i for i in range(len(rows)) if i % 3 or i > 60} - {66, 67}
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string").repartition(3)
    half = {r[0]: r[1] for r in docs.selectExpr("doc_id", "xxhash64(coalesce(text, '')) & 1").collect()}
    found = P.classify(docs, spark.createDataFrame([(i,) for i in trust], "doc_id int"), order=order, most=most, bits=bits).collect()
    model = [plain_word_model([t for i, _, t in rows if i in trust and half[i] == h], order) for h in (0, 1)]
    nats = {i: model[1 - half[i]](t) for i, _, t in rows}
    size = {i: sum(len(w) + 1 for w in cut_words(t)) + 1 for i, _, t in rows}
    lang = {i: lang for i, lang, _ in rows}
    score, limit = {}, {}
    for of in set(lang.values()):
        own = [i for i in trust if lang[i] == of]
        mean = sum(nats[i] for i in own) / sum(size[i] for i in own)
        score |= {i: (nats[i] + P.PRIOR * mean) / (size[i] + P.PRIOR) for i in lang if lang[i] == of}
        limit[of] = math.ceil(sorted(score[i] for i in own)[math.ceil(P.QUANTILE * len(own)) - 1] * 1000) / 1000
    assert len(found) == len(rows)
    for r in found:
        i = r["doc_id"]
        assert r["n_symbols"] == size[i]
        assert math.log(r["perplexity"]) == pytest.approx(nats[i] / size[i], rel=1e-5)
        assert math.log(r["smoothed"]) == pytest.approx(score[i], rel=1e-5)
        assert math.log(r["threshold"]) == pytest.approx(limit[lang[i]], abs=0.0011)
        assert r["kept"] == (score[i] <= limit[lang[i]]) or abs(score[i] - limit[lang[i]]) < 0.0011


def test_order_of_words_and_letters_beyond_ascii_count(spark):
    """Symbol classes take the second text of each pair for as good as the first, or for better."""
    good = ["the cat sat on the mat", "кот сидит на ковре", "ALPHA BETA GAMMA DELTA"]
    bad = ["mat the on sat cat the", "тко дитси ан верко", "GATED ALPMA HAMMA BETAL"]
    rows = [(i, "xx", f"{good[i % 3]} {good[i // 3 % 3]} x{i}") for i in range(40)]
    rows += [(100 + i, "xx", t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = {r["doc_id"]: r for r in P.classify(docs, docs.filter("doc_id < 100").select("doc_id")).collect()}
    for i in range(3):
        assert found[103 + i]["perplexity"] > 2 * found[100 + i]["perplexity"]
        assert found[100 + i]["kept"] and not found[103 + i]["kept"]


def test_what_a_step_has_used_up_is_deleted(spark):
    """All n-grams were on disk together: as counts, as shuffles, joined by context, and as asked for by the texts."""
    from pathlib import Path

    from newsloom.session import shared_folder

    def stored():
        folders = {f.parent for f in Path(shared_folder(spark).removeprefix("file:")).rglob("*.parquet")}
        return {f: spark.read.parquet(str(f)).columns for f in folders - before}

    before = set()
    before = set(stored())
    rows = [(i, "xx", t) for i, t in enumerate(made(40, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trusted = docs.filter("doc_id % 3 > 0").select("doc_id")
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(cleanup, None)
    found = P.classify(docs, trusted, most=20, waves=2)
    assert spark.conf.get(cleanup, None) == setting
    tables = stored()
    assert sum("nats" in names for names in tables.values()) == 2  # a half each
    assert not [names for names in tables.values() if {"w1", "weight", "known", "word"} & set(names)]
    assert found.count() == 40
