"""Gazetteer entities of raw text."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.arrays import distinct_when
from newsloom.functions.words import spoken_words
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.session import cut_lineage
from newsloom.sources.schemas import DOCUMENT_KEY

# Words of a phrase that are looked up together; a longer phrase is found by its first ones and then compared whole.
SPAN = 8
# The entity labels and the column each one fills.
LABELS = {"PERSON": "persons", "ORG": "organizations", "GPE": "locations"}


def starts(words: DataFrame, key: Sequence[str], count: int) -> DataFrame:
    """``key`` and each word of the list ``words`` with the ``count - 1`` words after it, as word0, word1, ...

    The followers are picked out of the list after the explode, so a join by word0 that follows has them picked for the
    words it keeps only. The slice is the whole list: of a bare column Spark would infer a filter, and cut the text twice.
    """
    whole = F.slice("words", F.lit(1), F.lit((1 << 31) - 1))
    placed = words.select(*key, "words", F.posexplode(whole).alias("place", "word0"))
    return placed.select(*key, "word0", *[F.get("words", F.col("place") + step).alias(f"word{step}") for step in range(1, count)])


def phrases_from(count: int) -> Column:
    """The phrases of 1 to ``count`` words that start at word0, null where the text ends before."""
    columns = [F.col(f"word{step}") for step in range(count)]
    grown = [F.when(columns[size - 1].isNotNull(), F.concat_ws(" ", *columns[:size])) for size in range(2, count + 1)]
    return F.array(columns[0], *grown)


def entities(
    documents: DataFrame, gazetteer: DataFrame, text: str = "summary",
    key: Sequence[str] = DOCUMENT_KEY, limits: Limits = DEFAULT_LIMITS, span: int = SPAN,
) -> DataFrame:
    """Sorted distinct ``persons``, ``organizations`` and ``locations`` per document that has any.

    ``gazetteer`` holds (phrase, label); phrases match words in their own case, punctuation at word ends
    aside. Words that start no phrase are dropped first, so only few phrases are built and looked up. A word
    meets ``span`` followers at most, however long a phrase of the gazetteer is. What a document repeats is met once:
    the distinct spoken phrases of documents take on the entries, not their occurrences.
    """
    named = gazetteer.select("phrase", "label", spoken_words("phrase").alias("words"))
    longest = named.agg(F.max(F.size("words")).alias("longest")).first()["longest"] or 1
    together = min(longest, span)
    heads = cut_lineage(named.select(F.get("words", F.lit(0)).alias("word0")).distinct())
    known = named.groupBy(F.array_join(F.slice("words", 1, span), " ").alias("spoken")).agg(
        F.collect_set(F.struct("phrase", "label", F.array_join("words", " ").alias("whole"))).alias("entries")
    )
    known = cut_lineage(known)
    spoken = starts(documents.select(*key, spoken_words(text).alias("words")), key, together)
    opened = lookup_join(spoken, heads, ["word0"], "left_semi", limits=limits)
    phrases = opened.select(*key, F.explode(phrases_from(together)).alias("spoken"))
    distinct = lookup_join(phrases, known.select("spoken"), ["spoken"], "left_semi", limits=limits).distinct()
    met = lookup_join(distinct, known, ["spoken"], limits=limits).select(*key, "spoken", F.inline("entries"))
    found = met.filter(F.col("whole") == F.col("spoken")).select(*key, "phrase", "label")
    if longest > span:
        begun = met.filter(F.col("whole") != F.col("spoken")).select(*key, "phrase", "label", "whole").distinct()
        said = documents.select(*key, F.concat(F.lit(" "), F.array_join(spoken_words(text), " "), F.lit(" ")).alias("said"))
        rest = begun.join(said, list(key)).filter(F.contains("said", F.concat(F.lit(" "), "whole", F.lit(" "))))
        found = found.unionByName(rest.select(*key, "phrase", "label"))
    return found.groupBy(*key).agg(*[
        distinct_when(F.col("label") == label, F.col("phrase")).alias(name)
        for label, name in LABELS.items()
    ])
