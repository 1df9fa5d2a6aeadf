"""Cleaning, tokens, stop words and URLs."""

import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters dropped from lower-cased summaries and from titles, that is all but ASCII
# letters and whitespace, and all but ASCII letters, digits and blanks; the token separator; the domain pattern.
# A class of more than two ranges is several times slower to match, hence the named one.
SUMMARY_DROPS = r"[^a-z\s]"
TITLE_DROPS = r"[^\p{Alnum} ]"
SEPARATOR = r"\s+"
DOMAIN = r"(https?://[^/]+)"
# Punctuation, and punctuation at either end of a word, which is dropped before the word is looked up.
# The second branch starts only where a run of punctuation starts, so a long run inside a word is tried once.
PUNCTUATION = string.punctuation
EDGE_PUNCTUATION = r"(?<!\S)\p{Punct}++|(?<!\p{Punct})\p{Punct}++(?!\S)"


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_summary(text) -> Column:
    """Lower-case letters and whitespace; digits and punctuation go."""
    return F.regexp_replace(F.lower(_column(text)), SUMMARY_DROPS, "")


def clean_title(text) -> Column:
    """Lower-case letters, digits and blanks; tabs and newlines go, which joins the words around them."""
    return F.lower(F.regexp_replace(_column(text), TITLE_DROPS, ""))


def tokens(text) -> Column:
    """Whitespace-separated tokens, never empty; null text has none."""
    return F.array_remove(F.split(F.coalesce(_column(text), F.lit("")), SEPARATOR), "")


def without(words, stop_words: Iterable[str]) -> Column:
    """The words that are not stop words, in order. Both are expected in lower case."""
    stop_words = list(stop_words)
    return F.filter(_column(words), lambda word: ~word.isin(stop_words))


def spoken_words(text) -> Column:
    """The words of raw text in their own case, without the punctuation at their ends."""
    return tokens(F.regexp_replace(_column(text), EDGE_PUNCTUATION, ""))


def bare_token(token) -> Column:
    """A token without the punctuation at its ends, but whole if at most two signs would be left: ``:)`` is a word."""
    token = _column(token)
    bare = F.btrim(token, F.lit(PUNCTUATION))
    return F.when(F.length(bare) > 2, bare).otherwise(token)


def domain_of(url) -> Column:
    """Scheme, host and port; '' without an http(s) scheme, null for null."""
    return F.regexp_extract(_column(url), DOMAIN, 1)
