import pytest
from conftest import rows
from pyspark.ml.feature import IDF, CountVectorizerModel, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from newsloom.functions import words
from newsloom.functions.stopwords import SUMMARY_STOP_WORDS, TITLE_STOP_WORDS
from newsloom.operators import terms


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression("t")).first()[0]


@pytest.mark.parametrize("text, cleaned", [
    ("Don't  STOP 24/7!\tNow", "dont  stop \tnow"), ("", ""), (None, None), ("Ünï", "n"),
])
def test_clean_summary(spark, text, cleaned):
    assert value(spark, words.clean_summary, text) == cleaned


@pytest.mark.parametrize("text, cleaned", [
    ("Falcon-9\tlaunch\nNEWS 2", "falcon9launchnews 2"), ("", ""), (None, None),
])
def test_clean_title(spark, text, cleaned):
    assert value(spark, words.clean_title, text) == cleaned


@pytest.mark.parametrize("text, found", [
    (" a  b ", ["a", "b"]), ("", []), (None, []), (" \t\n", []), ("x\ny\tz", ["x", "y", "z"]),
])
def test_tokens(spark, text, found):
    assert value(spark, words.tokens, text) == found


def test_spoken_words(spark):
    text = "\"Don't stop\" -- (U.S. crew): now!"
    assert value(spark, words.spoken_words, text) == ["Don't", "stop", "U.S", "crew", "now"]
    assert value(spark, words.spoken_words, None) == []


@pytest.mark.parametrize("url, domain", [
    ("https://a.org/x/y", "https://a.org"), ("http://h.com:80?x=1", "http://h.com:80?x=1"),
    ("ftp://a.org/x", ""), ("", ""), (None, None),
])
def test_domain(spark, url, domain):
    assert value(spark, words.domain_of, url) == domain


def test_stop_word_lists(spark):
    assert TITLE_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert len(SUMMARY_STOP_WORDS) == len(set(SUMMARY_STOP_WORDS)) == 179


def test_stop_words_are_used_as_given(spark):
    kept = words.without(F.array(F.lit("the"), F.lit("dont"), F.lit("x")), ["the", "don't"])
    assert spark.range(1).select(kept).first()[0] == ["dont", "x"]


TEXTS = [("s", "1", "moon rocket moon"), ("s", "2", "rocket fuel"), ("s", "3", "the rocket"), ("s", "4", None)]


@pytest.fixture
def documents(spark):
    return spark.createDataFrame(TEXTS, "source string, id string, summary string")


def test_term_counts_and_vocabulary(documents):
    assert rows(terms.term_counts(documents).select("id", "term", "tf")) == [
        ("1", "moon", 2), ("1", "rocket", 1), ("2", "fuel", 1), ("2", "rocket", 1), ("3", "rocket", 1),
    ]
    assert [r["term"] for r in terms.vocabulary(documents, 2).collect()] == ["rocket", "moon"]
    assert rows(terms.document_frequency(documents)) == [("fuel", 1), ("moon", 1), ("rocket", 3)]


def test_tfidf_equals_spark_ml(documents, limits):
    vocabulary = [row["term"] for row in terms.vocabulary(documents).collect()]
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="tokens", outputCol="counts")
    counted = counts.transform(terms.summary_tokens(documents))
    vectors = IDF(inputCol="counts", outputCol="features").fit(counted).transform(counted)
    ml = {
        (row["id"], term): weight
        for row in vectors.select("id", vector_to_array("features").alias("w")).collect()
        for term, weight in zip(vocabulary, row["w"]) if weight
    }
    ours = {
        (row["id"], row["term"]): row["tfidf"]
        for row in terms.tfidf(documents, limits=limits).collect() if row["tfidf"]
    }
    assert ours == pytest.approx(ml)


def test_term_in_every_document_weighs_nothing(spark):
    both = spark.createDataFrame([("s", "1", "a b"), ("s", "2", "a")], "source string, id string, summary string")
    weights = {r["term"]: r["tfidf"] for r in terms.tfidf(both, stop_words=[]).filter("id = '1'").collect()}
    assert weights["a"] == 0.0 and weights["b"] > 0


def test_tfidf_of_a_vocabulary(documents, limits):
    kept = terms.tfidf(documents, terms.vocabulary(documents, 1), limits=limits)
    assert {row["term"] for row in kept.collect()} == {"rocket"}


def test_keywords_break_ties_by_term(documents):
    best = terms.keywords(terms.tfidf(documents), 1)
    assert rows(best.select("id", "term", "rank")) == [("1", "moon", 1), ("2", "fuel", 1), ("3", "rocket", 1)]
