"""Array expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_index(values) -> Column:
    """0-based index of the largest element, the first one on ties; null for an empty or null array."""
    values = F.col(values) if isinstance(values, str) else values
    return F.array_position(values, F.array_max(values)) - F.lit(1)


def dominant_topic(distribution) -> Column:
    """``argmax_index``, but null for an all-zero distribution (a document without vocabulary terms)."""
    distribution = F.col(distribution) if isinstance(distribution, str) else distribution
    return F.when(F.array_max(distribution) > 0, argmax_index(distribution))


def distinct_when(condition: Column, value: Column) -> Column:
    """Aggregate: the distinct values of the rows that meet ``condition``, sorted."""
    return F.sort_array(F.collect_set(F.when(condition, value)))
