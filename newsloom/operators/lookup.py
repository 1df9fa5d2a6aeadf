"""Joining rows of any number and skew to a table with one row per key."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import cut_lineage


@dataclass(frozen=True)
class Limits:
    """What may be broadcast: a whole table up to ``table_bytes``, else the rows of heavy keys.

    A key is heavy with more than 1 / ``heavy_keys`` of the rows, so there are fewer than ``heavy_keys`` of
    them, and without them no key is large enough to fill a task of the shuffle join.
    """

    table_bytes: int = 64 << 20
    heavy_keys: int = 10_000


DEFAULT_LIMITS = Limits()
# Buckets of key hashes that are counted for each heavy key there may be.
BUCKETS = 8


def fits(table: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Whether the measured text size of ``table`` is within the limit."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return (table.agg(size.alias("size")).first()["size"] or 0) <= limits.table_bytes


def _matches(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool):
    pairs = [(left[name], right[f"__{name}"]) for name in on]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda x, y: x & y, tests)


def _prefixed(table: DataFrame, on: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({name: f"__{name}" for name in on})


def heavy_keys(facts: DataFrame, on: Sequence[str], limits: Limits = DEFAULT_LIMITS) -> tuple[DataFrame, bool]:
    """The keys ``on`` with more than 1 / ``limits.heavy_keys`` of the rows, stored, and whether there are any.

    A heavy key makes the bucket of its hash heavy. So buckets are counted first, a few for each heavy key there may be, and keys only
    in those that are heavy, mostly none: the keys of all rows are not shuffled. The names of heavy buckets are fewer than
    ``limits.heavy_keys``.
    """
    on = list(on)
    bucket = F.pmod(F.xxhash64(*on), F.lit(BUCKETS * limits.heavy_keys)).alias("__bucket")
    sizes = facts.select(bucket).groupBy("__bucket").count()
    total = facts.count()
    crowded = sizes.filter(F.col("count") * limits.heavy_keys > total).select("__bucket").collect()
    if not crowded:
        return cut_lineage(facts.select(on).limit(0)), False
    crowded = F.broadcast(facts.sparkSession.createDataFrame(crowded, "__bucket long"))
    candidates = facts.select(*on, bucket).join(crowded, "__bucket", "left_semi")
    counted = candidates.groupBy(on).count().filter(F.col("count") * limits.heavy_keys > total)
    heavy = cut_lineage(counted.select(on))
    return heavy, not heavy.isEmpty()


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    limits: Limits = DEFAULT_LIMITS,
    stored: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``table``, which has at most one row per key ``on``.

    A table of checked size is broadcast, so the facts are not shuffled at all. Beyond that the rows of
    heavy keys meet their few table rows by broadcast and only the others are shuffled: the result is the
    same, and no key, null included, can fill one task. Without heavy keys it is a plain join. The facts are computed once and stored for that, and of
    the keys only the heavy ones are. ``table`` is read more than once, so pass an expensive one through
    ``cut_lineage`` first. With ``stored`` the facts are the scan of a table: they are read again instead of stored again, the keys
    for the count and the columns that are asked for.
    """
    on = list(on)

    def join(rows: DataFrame, lookup: DataFrame, broadcast: bool, kind: str = how, nulls: bool = null_safe):
        lookup = _prefixed(lookup, on)
        joined = rows.join(
            F.broadcast(lookup) if broadcast else lookup, _matches(rows, lookup, on, nulls), kind
        )
        return joined.drop(*(f"__{name}" for name in on))

    if fits(table, limits):
        return join(facts, table, broadcast=True)

    facts = facts if stored else cut_lineage(facts)
    heavy, any_heavy = heavy_keys(facts, on, limits)
    if not any_heavy:
        return join(facts, table, broadcast=False)
    hot_facts = join(facts, heavy, True, "left_semi", True)
    cold_facts = join(facts, heavy, True, "left_anti", True)
    hot_table = join(table, heavy, True, "left_semi", True)
    return join(hot_facts, hot_table, broadcast=True).unionByName(join(cold_facts, table, broadcast=False))


def least_frequent(table: DataFrame, frequency: str, limits: Limits = DEFAULT_LIMITS) -> int | None:
    """The least ``frequency`` down to which the rows of ``table`` may be broadcast; None if not even the most frequent.

    These are the most frequent keys up to ``table_bytes`` together, and all heavy ones. Sizes and numbers of keys are
    summed by frequency first, of which there are few: the square root of twice the sum of frequencies at most.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    steps = cut_lineage(table.groupBy(frequency).agg(size.alias("size"), F.count(F.lit(1)).alias("keys")))
    total = steps.agg(F.sum(F.col(frequency) * F.col("keys")).alias("total")).first()["total"] or 0
    down = Window.orderBy(F.desc(frequency)).rowsBetween(Window.unboundedPreceding, 0)
    may = (F.sum("size").over(down) <= limits.table_bytes) | (F.col(frequency) * limits.heavy_keys > total)
    return steps.withColumn("may", may).filter("may").agg(F.min(frequency).alias("least")).first()["least"]


def frequency_join(
    facts: DataFrame, table: DataFrame, on: Sequence[str], frequency: str, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """``lookup_join``, inner, to a table of keys and how many facts each has at most (and nothing else).

    Beyond the limit the most frequent keys are broadcast as far as it goes, so the facts of the rare ones only, few
    as a rule, are shuffled. The facts are computed once and stored with what they have met; their keys need not be counted.
    """
    on = list(on)
    if fits(table, limits):
        return lookup_join(facts, table, on, limits=limits)
    least = least_frequent(table, frequency, limits)
    if least is None:
        return facts.join(table, on)
    frequent, rare = table.filter(F.col(frequency) >= least), table.filter(F.col(frequency) < least)
    met = cut_lineage(facts.join(F.broadcast(frequent), on, "left"))
    missed = met.filter(F.col(frequency).isNull()).drop(frequency).join(rare, on)
    return met.filter(F.col(frequency).isNotNull()).unionByName(missed)
