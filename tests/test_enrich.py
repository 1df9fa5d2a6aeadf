import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.functions.arrays import argmax_index, dominant_topic
from newsloom.operators import content, entities, models, sentiment, topics

TEXTS = [
    ("1", "A good day. Not a bad one!"), ("2", "never was it so good"), ("3", "not x y z good"),
    ("4", None), ("5", ""), ("6", "   "), ("7", "nothing known"), ("8", "It isn't GOOD, (bad) bad"),
]
LEXICON = [("good", 1.9), ("bad", -2.5)]


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(TEXTS, "id string, summary string").withColumns({
        "source": F.lit("articles"), "title": F.lit("t"), "news_site": F.lit("S"), "url": F.lit("https://s.org/1"),
    })


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, valence double")


def compound(total):
    return total / math.sqrt(total * total + 15)


def test_sentiment(documents, lexicon, limits):
    scores = dict(rows(sentiment.sentiment_scores(documents, lexicon, limits=limits).select("id", "sentiment_score")))
    assert scores == pytest.approx({
        "1": compound(1.9 + 2.5 * 0.74 + 0.292), "3": compound(1.9), "2": compound(1.9 + 0.293),
        "8": compound(-(1.9 + 0.733) * 0.74 + 2.5 * 0.74 + 2.5 * 0.74),
    })
    assert all(abs(score) <= 1 for score in scores.values())


GAZETTEER = [
    ("Ana Lima", "PERSON"), ("Ana", "PERSON"), ("Lima", "GPE"), ("Space Agency of Peru", "ORG"),
    ("U.S.", "GPE"), ("Peru", "GPE"), ("Peru", "ORG"),
]


def test_entities(spark, limits):
    documents = spark.createDataFrame([
        ("s", "1", "Ana Lima of the Space Agency of Peru left Lima; Ana Lima, again, for the U.S."),
        ("s", "2", "ana lima"), ("s", "3", None), ("s", "4", "Analima"), ("s", "5", "(Lima)"), ("s", "6", ""),
    ], "source string, id string, summary string")
    gazetteer = spark.createDataFrame(GAZETTEER, "phrase string, label string")
    found = entities.entities(documents, gazetteer, limits=limits).select("id", *entities.LABELS.values())
    assert rows(found) == [
        ("1", ["Ana", "Ana Lima"], ["Peru", "Space Agency of Peru"], ["Lima", "Peru", "U.S."]),
        ("5", [], [], ["Lima"]),
    ]


@pytest.mark.parametrize("span", [2, 8])
def test_entities_equal_brute_force(spark, limits, span):
    texts = [("s", str(i), " ".join("abcd"[(i * 7 + j * j) % 4] for j in range(i))) for i in range(1, 25)]
    phrases = ["a", "a b", "b c d", "d d", "c a b a d", "zz"]
    frame = spark.createDataFrame(texts, "source string, id string, summary string")
    gazetteer = spark.createDataFrame([(p, "ORG") for p in phrases], "phrase string, label string")
    found = dict(rows(entities.entities(frame, gazetteer, limits=limits, span=span).select("id", "organizations")))
    expected = {n: sorted(p for p in phrases if f" {p} " in f" {t} ") for _, n, t in texts}
    assert found == {n: names for n, names in expected.items() if names}


def test_a_long_phrase_and_a_long_run_of_punctuation(spark):
    phrase = " ".join(f"w{i}" for i in range(200))
    texts = [("s", "1", f"a {phrase} b"), ("s", "2", phrase[:-1]), ("s", "3", "x" + "-" * 1_000_000 + "y w0")]
    frame = spark.createDataFrame(texts, "source string, id string, summary string")
    gazetteer = spark.createDataFrame([(phrase, "ORG"), ("w0", "GPE")], "phrase string, label string")
    found = entities.entities(frame, gazetteer).select("id", "organizations", "locations")
    assert rows(found) == [("1", [phrase], ["w0"]), ("2", [], ["w0"]), ("3", [], ["w0"])]


def test_emoticons_and_repeated_tokens(spark):
    lexicon = spark.createDataFrame([(":)", 2.0), ("good", 1.0), ("Good", 3.0)], "token string, valence double")
    frame = spark.createDataFrame([("s", "1", "see you :)"), ("s", "2", "(good)!")], "source string, id string, summary string")
    found = dict(rows(sentiment.sentiment_scores(frame, lexicon).select("id", "sentiment_score")))
    assert found == {"1": pytest.approx(2 / 19**0.5), "2": pytest.approx(compound(2.292))}


@pytest.mark.parametrize("text, score", [
    ("VADER is smart, handsome, and funny.", 0.8316), ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545), ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is VERY SMART, uber handsome, and FRIGGIN FUNNY!!!", 0.9469),
    ("VADER is not smart, handsome, nor funny.", -0.7424), ("The book was good.", 0.4404),
    ("At least it isn't a horrible book.", 0.431), ("Today SUX!", -0.5461),
    ("The plot was good, but the characters are uncompelling and the dialog is not great.", -0.7042),
])
def test_published_examples(spark, text, score):
    valences = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "horrible": -2.5, "great": 3.1, "sux": -1.5, "uncompelling": -0.9}
    lexicon = spark.createDataFrame(list(valences.items()), "token string, valence double")
    frame = spark.createDataFrame([("s", "1", text)], "source string, id string, summary string")
    assert sentiment.sentiment_scores(frame, lexicon).first()["sentiment_score"] == pytest.approx(score, abs=6e-5)


def test_an_empty_gazetteer_or_lexicon_finds_nothing(spark, documents, lexicon, limits):
    gazetteer = spark.createDataFrame([], "phrase string, label string")
    assert entities.entities(documents, gazetteer, limits=limits).count() == 0
    assert sentiment.sentiment_scores(documents, lexicon.limit(0), limits=limits).count() == 0


def test_enriched_keeps_every_document(spark, documents, lexicon, limits):
    gazetteer = spark.createDataFrame([("It", "ORG")], "phrase string, label string")
    table = content.enriched(documents, *content.table_features(lexicon, gazetteer, limits))
    by_id = {row["id"]: row for row in table.collect()}
    assert len(by_id) == len(TEXTS)
    assert by_id["4"]["sentiment_score"] == 0.0 and by_id["4"]["persons"] == []
    assert by_id["4"]["clean_summary"] is None and by_id["8"]["organizations"] == ["It"]


@pytest.mark.parametrize("values, index", [([1.0, 3.0, 3.0], 1), ([2.0], 0), ([], None), (None, None)])
def test_argmax(spark, values, index):
    frame = spark.createDataFrame([(values,)], "a array<double>")
    assert frame.select(argmax_index("a")).first()[0] == index


def test_dominant_topic_of_nothing_is_null(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), ([0.2, 0.8],)], "a array<double>")
    assert [r[0] for r in frame.select(dominant_topic("a")).collect()] == [None, 1]


def test_topics(spark):
    texts = [("s", str(i), "rocket fuel engine" if i % 2 else "market price bank") for i in range(40)]
    texts.append(("s", "empty", "the of"))
    documents = spark.createDataFrame(texts, "source string, id string, summary string")
    model = topics.fit_topics(documents, topics=2)
    assigned = {row["id"]: row for row in topics.assign_topics(model, documents).collect()}
    assert len(assigned) == 41 and assigned["empty"]["topic"] is None
    for name, row in assigned.items():
        assert sum(row["topic_distribution"]) == pytest.approx(0 if name == "empty" else 1)
    assert model.top_terms("s", 3).count() == 2
    again = topics.assign_topics(topics.fit_topics(documents, topics=2), documents)
    assert {r["id"]: r["topic"] for r in again.collect()} == {n: r["topic"] for n, r in assigned.items()}


def test_topics_without_any_term(spark):
    documents = spark.createDataFrame([("s", "1", "the"), ("s", "2", None)], "source string, id string, summary string")
    model = topics.fit_topics(documents)
    assert rows(topics.assign_topics(model, documents).select("id", "topic")) == [("1", None), ("2", None)]


def test_models_take_the_place_of_tables(documents):
    def load_scorer():
        return lambda texts: texts.str.len() / 100.0

    def load_tagger():
        return lambda texts: [[(word, "PERSON") for word in text.split() if word == "good"] * 2 for text in texts]

    table = content.enriched(
        documents, lambda texts: models.model_scores(texts, load_scorer),
        lambda texts: models.model_entities(texts, load_tagger),
    )
    found = {row["id"]: (row["sentiment_score"], row["persons"]) for row in table.collect()}
    assert found["2"] == (pytest.approx(len(TEXTS[1][1]) / 100), ["good"]) and found["4"] == found["5"] == found["6"] == (0.0, [])
    assert len(found) == len(TEXTS)
