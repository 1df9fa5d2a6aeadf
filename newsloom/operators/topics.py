"""Topic model of one feed: vocabulary, TF-IDF vectors and LDA of Spark ML."""

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.arrays import dominant_topic
from newsloom.functions.stopwords import SUMMARY_STOP_WORDS
from newsloom.functions.words import clean_summary, tokens
from newsloom.operators.terms import VOCABULARY_SIZE, vocabulary
from newsloom.sources.schemas import DOCUMENT_KEY

# Number of topics and of iterations.
TOPICS = 5
ITERATIONS = 10
SEED = 42
# Share of the documents that an iteration of the online optimizer sees: Spark's default, stated.
SUBSAMPLING = 0.05


# A topic less alike to each stored one than this is a topic of its own.
ALIKE = 0.3


@dataclass
class TopicModel:
    """A fitted model. ``numbers`` are the lasting numbers of its topics, in the model's order."""

    counts: CountVectorizerModel | None
    idf: IDFModel | None
    lda: LDAModel | None
    numbers: Sequence[int] | None = None

    def features(self, documents: DataFrame, key: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
        """``key`` and the TF-IDF vector of each document, the input of the model, row by row."""
        return self.idf.transform(self.counts.transform(_tokens(documents, key)))

    def top_terms(self, source: str, size: int = 10) -> DataFrame:
        """One row per topic: source, topic and its ``size`` heaviest terms."""
        words = F.array(*[F.lit(word) for word in self.counts.vocabulary])
        described = self.lda.describeTopics(size)
        return described.select(
            F.lit(source).alias("source"),
            self.number("topic").alias("topic"),
            F.transform("termIndices", lambda i: F.get(words, i)).alias("top_terms"),
        )

    def number(self, place: str) -> Column:
        """The lasting number of the topic that has a place in the model."""
        if self.numbers is None:
            return F.col(place).cast("long")
        return F.get(F.array(*[F.lit(n).cast("long") for n in self.numbers]), F.col(place).cast("int"))

    def weights(self, source: str) -> DataFrame:
        """(source, topic, term, weight): the share of each vocabulary term in each topic."""
        words = F.array(*[F.lit(word) for word in self.counts.vocabulary])
        described = self.lda.describeTopics(len(self.counts.vocabulary))
        listed = described.select(
            self.number("topic").alias("topic"), F.explode(F.arrays_zip("termIndices", "termWeights")).alias("at")
        )
        return listed.select(
            F.lit(source).alias("source"), "topic", F.get(words, F.col("at.termIndices")).alias("term"),
            F.col("at.termWeights").alias("weight"),
        )


def _tokens(documents: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """The tokens of summaries, stop words included: the vocabulary has none."""
    return documents.select(*key, tokens(clean_summary("summary")).alias("tokens"))


def fit_topics(
    documents: DataFrame, stop_words: Iterable[str] = SUMMARY_STOP_WORDS, topics: int = TOPICS,
    iterations: int = ITERATIONS, size: int = VOCABULARY_SIZE, seed: int = SEED, subsampling: float = SUBSAMPLING,
) -> TopicModel:
    """Fit on the summaries of documents.

    Only the vocabulary, at most ``size`` terms by construction, and the model, topics by terms, are on the
    driver. The count vectors are kept for the iterations, so the texts are read twice, and freed afterwards.
    """
    words = [row["term"] for row in vocabulary(documents, size, stop_words).collect()]
    if not words:
        return TopicModel(None, None, None)
    counts = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="counts")
    vectors = counts.transform(_tokens(documents)).select("counts")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf = IDF(inputCol="counts", outputCol="features").fit(vectors)
        lda = LDA(
            k=topics, maxIter=iterations, seed=seed, subsamplingRate=subsampling, featuresCol="features",
            topicDistributionCol="distribution",
        ).fit(idf.transform(vectors))
    finally:
        vectors.unpersist()
    return TopicModel(counts, idf, lda)


def likeness(new: DataFrame, stored: DataFrame) -> DataFrame:
    """(topic, stored_topic, likeness): the cosine of the term weights of each new and each stored topic with a term in common."""
    def normed(weights: DataFrame) -> DataFrame:
        size = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("topic")))
        return weights.select("topic", "term", (F.col("weight") / size).alias("weight"))

    pairs = normed(new).join(normed(stored).withColumnsRenamed({"topic": "stored_topic", "weight": "w"}), "term")
    return pairs.groupBy("topic", "stored_topic").agg(F.sum(F.col("weight") * F.col("w")).alias("likeness"))


def assignment(gains: np.ndarray) -> list[int]:
    """For each row its column, no column twice, so that the sum of gains is largest: the Hungarian method.

    There are as many columns as rows at least. Rows enter one after the other; each is matched along the cheapest
    alternating path, with potentials that keep all reduced costs from being negative.
    """
    n, m = gains.shape
    cost = gains.max(initial=0.0) - gains
    row_potential, column_potential = np.zeros(n), np.zeros(m)
    row_of = np.full(m, -1)
    for row in range(n):
        distance, before, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        at, column = row, -1
        reached = 0.0
        while True:
            reduced = reached + cost[at] - row_potential[at] - column_potential
            nearer = ~done & (reduced < distance)
            distance[nearer], before[nearer] = reduced[nearer], column
            column = int(np.argmin(np.where(done, np.inf, distance)))
            reached = distance[column]
            done[column] = True
            if row_of[column] < 0:
                break
            at = row_of[column]
        settled = done & (row_of >= 0)
        row_potential[row] += reached
        row_potential[row_of[settled]] += reached - distance[settled]
        column_potential[done] -= reached - distance[done]
        while column >= 0:
            previous = before[column]
            row_of[column] = row if previous < 0 else row_of[previous]
            column = previous
    places = np.full(n, -1)
    places[row_of[row_of >= 0]] = np.flatnonzero(row_of >= 0)
    return places.tolist()


def lasting_numbers(new: DataFrame, stored: DataFrame, topics: int, alike: float = ALIKE) -> list[int]:
    """The numbers of a refit's topics 0, 1, ...: those of the stored topics they continue, or new ones.

    The topics are matched so that the sum of their likeness is largest; a match below ``alike`` is none. Only the
    likeness of topics, a few numbers, is brought to the driver, and one row for each stored topic.
    """
    known = sorted(row["topic"] for row in stored.select("topic").distinct().collect())
    gains = np.zeros((topics, len(known) + topics))  # the last columns stand for new topics
    place = {number: i for i, number in enumerate(known)}
    for row in likeness(new, stored).collect():
        if row["likeness"] >= alike:
            gains[row["topic"], place[row["stored_topic"]]] = row["likeness"]
    fresh = itertools.count(max(known, default=-1) + 1)
    found = assignment(gains)
    return [known[c] if c < len(known) and gains[t, c] > 0 else next(fresh) for t, c in enumerate(found)]


def continued(model: TopicModel, stored: DataFrame, source: str) -> TopicModel:
    """The model with the numbers of the stored topics (topic, term, weight) that its topics continue."""
    if model.lda is None:
        return model
    numbers = lasting_numbers(model.weights(source), stored, model.lda.getK())
    return replace(model, numbers=numbers)


def assign_topics(
    model: TopicModel, documents: DataFrame, key: Sequence[str] = DOCUMENT_KEY
) -> DataFrame:
    """``topic_distribution`` and dominant ``topic`` per document; topic null without vocabulary terms.

    The distribution is in the model's order, the topic has its lasting number. Row by row, no shuffle.
    """
    if model.lda is None:
        return documents.select(
            *key,
            F.array().cast("array<double>").alias("topic_distribution"),
            F.lit(None).cast("long").alias("topic"),
        )
    return model.lda.transform(model.features(documents, key)).select(
        *key, vector_to_array("distribution").alias("topic_distribution")
    ).withColumn("topic", dominant_topic("topic_distribution")).withColumn("topic", model.number("topic"))
