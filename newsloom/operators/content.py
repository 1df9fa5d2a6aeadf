"""The content-analysis table: text features, sentiment, entities and topics of each document."""

from collections.abc import Callable, Iterable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.stopwords import SUMMARY_STOP_WORDS
from newsloom.functions.words import clean_summary, domain_of
from newsloom.operators.entities import LABELS, entities
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits
from newsloom.operators.sentiment import sentiment_scores
from newsloom.operators.topics import TopicModel, assign_topics, fit_topics
from newsloom.sources.schemas import ANALYSIS, DOCUMENT_KEY

TEXT_COLUMNS = ("source", "id", "title", "summary", "news_site", "url")

# From documents to their scores or entity lists, keyed by source and id.
Feature = Callable[[DataFrame], DataFrame]


def table_features(
    lexicon: DataFrame, gazetteer: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> tuple[Feature, Feature]:
    """Sentiment by a lexicon table and entities by a gazetteer table."""
    return (
        partial(sentiment_scores, lexicon=lexicon, limits=limits),
        partial(entities, gazetteer=gazetteer, limits=limits),
    )


def enriched(documents: DataFrame, score: Feature, tag: Feature, keep: Sequence[str] = ()) -> DataFrame:
    """Documents with clean summary, domain, sentiment and entities: everything but the topics. Columns ``keep`` stay.

    The features come partitioned by document key or are small, so the texts are shuffled at most once.
    Without a match the score is 0 and the entity lists are empty.
    """
    key = list(DOCUMENT_KEY)
    texts = documents.select(*TEXT_COLUMNS)
    cleaned = documents.select(*TEXT_COLUMNS, *keep).withColumn("clean_summary", clean_summary("summary"))
    empty = F.array().cast("array<string>")
    return (
        cleaned.withColumn("domain_url", domain_of("url")).drop("url")
        .join(score(texts), key, "left")
        .join(tag(texts), key, "left")
        .withColumns({
            "sentiment_score": F.coalesce("sentiment_score", F.lit(0.0)),
            **{name: F.coalesce(name, empty) for name in LABELS.values()},
        })
    )


def content_analysis(
    documents: DataFrame, source: str, score: Feature, tag: Feature,
    stop_words: Iterable[str] = SUMMARY_STOP_WORDS, model: TopicModel | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The analysis of one feed's documents and the top terms of its topics (none without any term).

    ``model`` is fitted here unless it is given. Topics are told in the pass that reads the texts.
    """
    own = documents.filter(F.col("source") == source)
    if model is None:
        model = fit_topics(own, stop_words)
    topical = assign_topics(model, own, TEXT_COLUMNS)
    table = enriched(topical, score, tag, ("topic_distribution", "topic"))
    return table.select(ANALYSIS.fieldNames()), model.lda and model.top_terms(source)
