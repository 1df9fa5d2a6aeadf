"""Keyed merge of a batch into a table with an active flag."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.session import cut_lineage

ACTIVE = "is_active"


def _rank(rows: DataFrame, key: Sequence[str], version: str) -> Column:
    """The order of versions: equal ones are decided by a hash of the content, a null one comes first.

    When a row was loaded is not its content, so a repeated load decides alike.
    """
    content = [F.col(name) for name in rows.columns if name not in key and name != "ingested_at"]
    return F.struct(F.col(version), F.xxhash64(*content))


def latest_versions(rows: DataFrame, key: Sequence[str], version: str = "updated_at") -> DataFrame:
    """The newest row per key.

    An aggregate, not a window: copies of one key are reduced before the shuffle, so a key with a third
    of all rows costs one row per task.
    """
    key = list(key)
    content = F.struct(*rows.columns)
    newest = rows.groupBy(key).agg(F.max_by(content, _rank(rows, key, version)).alias("newest"))
    return newest.select("newest.*")


def mark_superseded(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """``stage`` with the flag taken down where the key is in ``incoming``, however often it is there."""
    key = list(key)
    arrived = incoming.select(key).distinct().withColumn("__arrived", F.lit(True))
    flagged = lookup_join(stage, arrived, key, how="left", limits=limits)
    still_active = F.when(F.col("__arrived").isNotNull(), F.lit(False)).otherwise(
        F.col(ACTIVE).cast("boolean")
    )
    return flagged.withColumn(ACTIVE, still_active).select(stage.columns)


def new_rows(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The incoming rows whose key the stage does not hold, copies included."""
    key = list(key)
    known = lookup_join(
        stage.select(key), incoming.select(key).distinct(), key, how="left_semi", limits=limits
    )
    return lookup_join(incoming, cut_lineage(known.distinct()), key, how="left_anti", limits=limits)


def unknown_keys(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], version: str = "updated_at",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """The latest incoming version of each key the stage does not hold, active."""
    fresh = latest_versions(new_rows(stage, incoming, key, limits), key, version)
    return fresh.withColumn(ACTIVE, F.lit(True))


def accepted_versions(
    stored: DataFrame, incoming: DataFrame, key: Sequence[str], version: str = "updated_at"
) -> DataFrame:
    """(new, stored, known) of each incoming key that is unknown or strictly newer than all ``stored``: its latest row,
    the newest version stored and whether the key is known; null where it is not.

    ``stored`` is read for its keys and versions only and may hold other keys, which are dropped by the aggregate that
    reduces the incoming rows to the latest: one shuffle for both.
    """
    key = list(key)
    held = stored.select(*key, F.col(version).alias("stored"), F.lit(True).alias("known")).dropna(subset=key)
    arriving = incoming.select(
        *key, F.struct(*incoming.columns).alias("content"), _rank(incoming, key, version).alias("rank")
    )
    compared = (
        arriving.unionByName(held, allowMissingColumns=True)
        .groupBy(key)
        .agg(F.max_by("content", "rank").alias("new"), F.max("stored").alias("stored"),
             F.max("known").alias("known"))
        .filter(F.col("new").isNotNull())
    )
    newer = F.col(f"new.{version}") > F.col("stored")
    first_version = F.col("stored").isNull() & F.col(f"new.{version}").isNotNull()
    return cut_lineage(compared.filter(F.col("known").isNull() | newer | first_version).select("new", "stored", "known"))


def activated(accepted: DataFrame) -> DataFrame:
    """The rows of ``accepted_versions``, active."""
    return accepted.select("new.*").withColumn(ACTIVE, F.lit(True))


def newer_versions(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], version: str = "updated_at",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """The latest incoming version of each key that is unknown or strictly newer than all stored, active.

    The stage is read for its keys and versions only, and only those of incoming keys are compared.
    """
    key = list(key)
    stored = lookup_join(
        stage.select(*key, version), incoming.select(key).distinct(), key, "left_semi", limits=limits,
    )
    return activated(accepted_versions(stored, incoming, key, version))


def merge_flag_only(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], version: str = "updated_at",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Matched rows become inactive, unknown keys are added, everything else stays."""
    added = unknown_keys(stage, incoming, key, version, limits)
    flagged = mark_superseded(stage, incoming, key, limits)
    return flagged.unionByName(added, allowMissingColumns=True)


def merge_history(
    stage: DataFrame, incoming: DataFrame, key: Sequence[str], version: str = "updated_at",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """A strictly newer version expires the stored one and becomes active; unknown keys are added.

    "Newer" compares with the newest stored version, active or not, so stale and repeated versions
    change nothing and a batch may be applied twice.
    """
    added = newer_versions(stage, incoming, key, version, limits)
    return mark_superseded(stage, added, key, limits).unionByName(added, allowMissingColumns=True)
