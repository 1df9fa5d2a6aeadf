"""A model of the user's choice in place of the lexicon or the gazetteer.

``load`` is called once per task and returns a function over a pandas Series of texts that are neither null nor
blank. Batches of texts go to it through Arrow, so texts are never gathered and the model is not shipped.
"""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newsloom.operators.entities import LABELS
from newsloom.sources.schemas import DOCUMENT_KEY


def _keyed(documents: DataFrame, key: Sequence[str], *fields: T.StructField) -> T.StructType:
    return T.StructType([documents.schema[name] for name in key] + list(fields))


def _spoken(texts: pd.Series) -> pd.Series:
    return texts.notna() & (texts.fillna("").str.strip() != "")


def model_scores(
    documents: DataFrame, load: Callable, text: str = "summary", key: Sequence[str] = DOCUMENT_KEY
) -> DataFrame:
    """``sentiment_score`` per document with any text; the function gives a score per text."""
    key = list(key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = load()
        for batch in batches:
            batch = batch[_spoken(batch[text])]
            if batch.empty:
                continue
            yield batch[key].assign(sentiment_score=list(score(batch[text])))

    schema = _keyed(documents, key, T.StructField("sentiment_score", T.DoubleType()))
    return documents.select(*key, text).mapInPandas(run, schema)


def model_entities(
    documents: DataFrame, load: Callable, text: str = "summary", key: Sequence[str] = DOCUMENT_KEY
) -> DataFrame:
    """The entity lists per document with any text; the function gives (phrase, label) pairs per text."""
    key = list(key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tag = load()
        for batch in batches:
            batch = batch[_spoken(batch[text])]
            if batch.empty:
                continue
            found = list(tag(batch[text]))
            yield batch[key].assign(**{
                name: [sorted({phrase for phrase, own in pairs if own == label}) for pairs in found]
                for label, name in LABELS.items()
            })

    names = [T.StructField(name, T.ArrayType(T.StringType())) for name in LABELS.values()]
    return documents.select(*key, text).mapInPandas(run, _keyed(documents, key, *names))
