"""Term counts, vocabulary, TF-IDF and keywords of summaries.

Documents have a key, by default source and id, and a ``summary``. Terms are the tokens of the clean summary that
are no stop words.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.functions.stopwords import SUMMARY_STOP_WORDS
from newsloom.functions.words import clean_summary, tokens, without
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, frequency_join, lookup_join
from newsloom.session import cut_lineage
from newsloom.sources.schemas import DOCUMENT_KEY

# Fixed value: the size of the vocabulary.
VOCABULARY_SIZE = 1000


def summary_tokens(
    documents: DataFrame, stop_words: Iterable[str] = SUMMARY_STOP_WORDS, summary: str = "summary"
) -> DataFrame:
    """Add ``clean_summary`` and its ``tokens`` without stop words."""
    return documents.withColumn("clean_summary", clean_summary(summary)).withColumn(
        "tokens", without(tokens("clean_summary"), stop_words)
    )


def term_rows(
    documents: DataFrame, key: Sequence[str] = (), stop_words: Iterable[str] = SUMMARY_STOP_WORDS,
    distinct: bool = False,
) -> DataFrame:
    """One row per document and term occurrence, or per term of a document if ``distinct``.

    The text is cut inside the explode: exploding a token column computed before it would make Spark add a
    filter on its size, which cuts the text a second time.
    """
    words = tokens(clean_summary("summary"))
    words = F.array_distinct(words) if distinct else words
    rows = documents.select(*key, F.explode(words).alias("term"))
    stop_words = list(stop_words)
    return rows.filter(~F.col("term").isin(stop_words)) if stop_words else rows


def term_counts(
    documents: DataFrame, key: Sequence[str] = DOCUMENT_KEY, stop_words: Iterable[str] = SUMMARY_STOP_WORDS
) -> DataFrame:
    """One row per document and term with the number of its occurrences, ``tf``."""
    return term_rows(documents, key, stop_words).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    documents: DataFrame, size: int = VOCABULARY_SIZE, stop_words: Iterable[str] = SUMMARY_STOP_WORDS
) -> DataFrame:
    """The ``size`` most frequent terms of all documents, equal counts in term order."""
    counts = term_rows(documents, (), stop_words).groupBy("term").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "term").limit(size)


def document_frequency(
    documents: DataFrame, stop_words: Iterable[str] = SUMMARY_STOP_WORDS
) -> DataFrame:
    """The number of documents each term occurs in, ``df``.

    A document counts a term once because its tokens are made distinct in its own row, so only
    pre-aggregated terms are shuffled.
    """
    rows = term_rows(documents, (), stop_words, distinct=True)
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_weight(documents: int, df) -> Column:
    """ln((m + 1) / (df + 1)) for m documents: 0 for a term all of them have."""
    return F.log(F.lit(documents + 1).cast("double") / (df + F.lit(1)))


def tfidf(
    documents: DataFrame, terms: DataFrame | None = None, key: Sequence[str] = DOCUMENT_KEY,
    stop_words: Iterable[str] = SUMMARY_STOP_WORDS, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per document and term with ``tf``, ``df`` and ``tfidf``, of ``terms`` only if given.

    The frequencies of all terms may be large and a few terms are in most documents, hence the
    size-checked, skew-proof join. A term has at most ``df`` rows to meet, so beyond the limit the most frequent terms are broadcast and
    only the rows of rare ones are shuffled.
    """
    total = documents.count()
    frequencies = document_frequency(documents, stop_words)
    if terms is not None:
        frequencies = lookup_join(frequencies, terms.select("term"), ["term"], "left_semi", limits=limits)
    counts = term_counts(documents, key, stop_words)
    weighted = frequency_join(counts, cut_lineage(frequencies), ["term"], "df", limits).select(*counts.columns, "df")
    return weighted.withColumn("tfidf", F.col("tf") * idf_weight(total, F.col("df")))


def keywords(weighted: DataFrame, size: int = 5, key: Sequence[str] = DOCUMENT_KEY) -> DataFrame:
    """The ``size`` terms of highest TF-IDF per document, with their ``rank``; ties in term order.

    The window sees one document's distinct terms; Spark keeps only the best ranks before the shuffle.
    """
    best = Window.partitionBy(*key).orderBy(F.desc("tfidf"), "term")
    return weighted.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)
