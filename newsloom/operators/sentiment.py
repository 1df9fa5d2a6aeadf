"""Lexicon sentiment of raw text, after the published rules of Hutto and Gilbert (2014)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.words import bare_token, tokens
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.session import cut_lineage
from newsloom.sources.schemas import DOCUMENT_KEY

# Fixed values of the published method: scale of a negated valence, normalisation, span and words of negation, what a
# word of degree adds and how much of it from one, two and three words away, what capitals add, and how often what
# "never so" says, what stands on either side of "but", and exclamation and question marks count.
NEGATED = -0.74
ALPHA = 15.0
NEGATION_SPAN = 3
DEGREE = 0.293
FADES = (1.0, 0.95, 0.9)
CAPITALS = 0.733
NEVER_SO = 1.25
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
BOOSTERS = """
absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely
especially exceptional exceptionally extreme extremely fabulously flipping flippin frackin fracking fricking frickin
frigging friggin fully greatly hella highly hugely incredible incredibly intensely major majorly more most particularly
purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably
unusually utter utterly very
""".split()
DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce scarcely
slight slightly somewhat sorta sortof sort-of
""".split()
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont
hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt
needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't
shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite
""".split()


def is_negation(word: Column) -> Column:
    return F.coalesce(word.isin(NEGATIONS) | word.contains("n't"), F.lit(False))


def with_preceding(words: DataFrame, *columns: str, span: int = NEGATION_SPAN) -> DataFrame:
    """``columns`` and each word of the list ``words``: place, token, before1, before2, ..., the ``span`` words before it.

    They are in lower case, from the list ``lowered``, and as they are written in ``spoken`` and ``spoken_before1, ...``.
    These are picked out of the lists after the explode, so a join by token that follows has them picked for the
    words it keeps only. The slice is the whole list: of a bare column Spark would infer a filter, and cut the text twice.
    """
    whole = F.slice("lowered", F.lit(1), F.lit((1 << 31) - 1))
    placed = words.select(*columns, "words", "lowered", F.posexplode(whole).alias("place", "token"))
    before = range(1, span + 1)
    return placed.select(
        *columns, "place", "token", *[F.get("lowered", F.col("place") - step).alias(f"before{step}") for step in before],
        F.get("words", F.col("place")).alias("spoken"),
        *[F.get("words", F.col("place") - step).alias(f"spoken_before{step}") for step in before],
    )


def compound(total: Column) -> Column:
    """The valence sum scaled into [-1, 1]."""
    return total / F.sqrt(total * total + F.lit(ALPHA))


def is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def emphasis(text: Column) -> Column:
    """What exclamation and question marks of a text add to the size of its sum."""
    exclaimed, asked = (F.length(text) - F.length(F.replace(text, F.lit(sign))) for sign in "!?")
    questions = F.when(asked <= 1, 0.0).when(asked <= QUESTIONS, asked * F.lit(QUESTION)).otherwise(MANY_QUESTIONS)
    return F.least(exclaimed, F.lit(EXCLAMATIONS)) * F.lit(EXCLAMATION) + questions


def weighted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``valence`` as the words before ``token`` change it, from the nearest to the third.

    Words of the lexicon say nothing about others. Each step is a column of its own, as the next refers to it often.
    """
    before = {step: F.col(f"before{step}") for step in range(1, NEGATION_SPAN + 1)}
    value = F.col("valence")
    louder = F.when(value > 0, CAPITALS).otherwise(-CAPITALS)
    rows = rows.withColumn("valence", value + F.when(F.col("loud_spoken"), louder).otherwise(0.0))
    so = {step: F.coalesce(before[step].isin("so", "this"), F.lit(False)) for step in (1, 2)}
    doubt = {step: F.coalesce(before[step] == "doubt", F.lit(False)) for step in (1, 2)}
    for step, fade in enumerate(FADES, 1):
        word = before[step]
        degree = F.when(word.isin(BOOSTERS), DEGREE).when(word.isin(DAMPENERS), -DEGREE)
        added = degree * F.when(value < 0, -1.0).otherwise(1.0)
        added = added + F.when(F.col(f"loud_before{step}"), louder).otherwise(0.0)
        nearer_so = so[1] if step == 2 else so[1] | so[2]
        nearer_doubt = doubt[1] if step == 2 else doubt[1] | doubt[2]
        scale = F.when(is_negation(word), NEGATED).otherwise(1.0)
        if step > 1:
            scale = F.when((word == "never") & nearer_so, NEVER_SO).when((word == "without") & nearer_doubt, 1.0).otherwise(scale)
        counts = word.isNotNull() & F.col(f"known_before{step}").isNull()
        moved = (value + F.coalesce(added * fade, F.lit(0.0))) * scale
        rows = rows.withColumn("valence", F.when(counts, moved).otherwise(value))
    least = (before[1] == "least") & F.col("known_before1").isNull()
    least = least & ~F.coalesce(before[2].isin("at", "very"), F.lit(False))
    return rows.withColumn("valence", F.when(least, value * NEGATED).otherwise(value))


def sentiment_scores(
    documents: DataFrame, lexicon: DataFrame, text: str = "summary",
    key: Sequence[str] = DOCUMENT_KEY, limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``sentiment_score`` per document with at least one word of the lexicon (token, valence).

    The lexicon is broadcast if it is small enough, so the words become one partial sum per document
    before anything is shuffled. Documents not returned have a score of 0. A token that the lexicon has twice
    counts with its mean valence.
    """
    lexicon = cut_lineage(lexicon.groupBy(F.lower("token").alias("token")).agg(F.avg("valence").alias("valence")))
    # Stored without the words of degree, so that words need not be compared with these one by one.
    valued = cut_lineage(lexicon.filter(~F.col("token").isin(BOOSTERS + DAMPENERS)))
    said = documents.select(*key, F.col(text).alias("said"), F.transform(tokens(text), bare_token).alias("words"))
    said = said.withColumn("lowered", F.transform("words", lambda word: F.lower(word)))
    mixed = F.exists("words", is_upper) & F.exists("words", lambda word: ~is_upper(word))
    said = said.select(
        *key, "words", "lowered", mixed.alias("mixed"), emphasis(F.col("said")).alias("emphasis"),
        F.array_position("lowered", "but").alias("but"),
    )
    spoken = with_preceding(said, *key, "mixed", "emphasis", "but")
    befores = [f"before{step}" for step in range(1, NEGATION_SPAN + 1)]
    rows = lookup_join(spoken, valued, ["token"], limits=limits)
    loud = {"loud_spoken": "spoken", **{f"loud_{name}": f"spoken_{name}" for name in befores}}
    rows = rows.withColumns({name: F.col("mixed") & is_upper(F.col(word)) for name, word in loud.items()}).drop(*loud.values())
    for name in befores:
        known = lexicon.select(F.col("token").alias(name), F.lit(True).alias(f"known_{name}"))
        rows = lookup_join(rows, known, [name], "left", limits=limits)
    number = F.col("place") + 1
    rows = weighted(rows).withColumn(
        "valence",
        F.col("valence") * F.when(F.col("but") == 0, 1.0).when(number < F.col("but"), BEFORE_BUT)
        .when(number > F.col("but"), AFTER_BUT).otherwise(1.0),
    )
    total = F.col("total") + F.signum("total") * F.col("emphasis")
    return (
        rows.groupBy(*key)
        .agg(F.sum("valence").alias("total"), F.max("emphasis").alias("emphasis"))
        .select(*key, compound(total).alias("sentiment_score"))
    )
