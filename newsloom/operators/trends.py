"""Monthly word trends of titles and the activity of news sites."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.stopwords import TITLE_STOP_WORDS
from newsloom.functions.words import clean_title, domain_of, tokens


def word_rows(
    titled: DataFrame, *columns: str, stop_words: Iterable[str] = TITLE_STOP_WORDS
) -> DataFrame:
    """``columns`` and ``word``: one row per title word that is no stop word."""
    rows = titled.select(*columns, F.explode(tokens(clean_title("title"))).alias("word"))
    return rows.filter(~F.col("word").isin(list(stop_words)))


def word_trends(documents: DataFrame, stop_words: Iterable[str] = TITLE_STOP_WORDS) -> DataFrame:
    """How often each word stands in the titles of a source and month.

    Documents are (source, id, title, published_at). A document without any word has no row. The words are
    counted per task before the shuffle, so a frequent word costs one row per task and month.
    """
    dated = documents.select(
        "source", F.year("published_at").alias("year"), F.month("published_at").alias("month"), "id", "title"
    )
    words = word_rows(dated, "source", "year", "month", "id", stop_words=stop_words)
    return words.groupBy("source", "year", "month", "word").agg(F.count("id").alias("count"))


def source_activity(documents: DataFrame) -> DataFrame:
    """Number of documents per source, news site and domain."""
    return documents.groupBy("source", "news_site", domain_of("url").alias("domain_url")).agg(
        F.count("id").alias("count")
    )


def changed(counts, added: DataFrame, retired: DataFrame) -> DataFrame:
    """What ``counts`` (``word_trends`` or ``source_activity``) gains by documents added and loses by documents retired.

    Counts are sums over documents, so the signed counts of every batch add up to those of a recount.
    """
    lost = counts(retired).withColumn("count", -F.col("count"))
    return totals(counts(added).unionByName(lost), empty=F.col("count") != 0)


def totals(signed: DataFrame, empty=None) -> DataFrame:
    """Signed counts added up, without those that come to nothing (or to nothing positive)."""
    names = [name for name in signed.columns if name != "count"]
    summed = signed.groupBy(names).agg(F.sum("count").alias("count")).select(signed.columns)
    return summed.filter(F.col("count") > 0 if empty is None else empty)
