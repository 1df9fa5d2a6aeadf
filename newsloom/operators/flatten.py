"""One row per combination of authors, launches and events."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.sources.schemas import FLAT_FIELDS

NESTED = ("authors", "launches", "events")


def explode_all(rows: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Replace each array by its elements, outer: a null or empty array keeps the row.

    Several arrays multiply: a row becomes max(1, n1) * max(1, n2) * ... rows.
    """
    for name in arrays:
        others = [column for column in rows.columns if column != name]
        rows = rows.select(*others, F.explode_outer(name).alias(name))
    return rows


def flatten_documents(documents: DataFrame) -> DataFrame:
    """The flat bronze view: nested fields as columns, one row per author, launch and event combination.

    Works for feeds without launches and events too, whose arrays are null or not there.
    """
    present = [name for name in NESTED if name in documents.columns]
    plain = [name for name in documents.columns if name not in NESTED]
    nested = [
        F.col(path).alias(flat) for path, flat in FLAT_FIELDS.items() if path.split(".")[0] in present
    ]
    return explode_all(documents, present).select(*plain, *nested)
