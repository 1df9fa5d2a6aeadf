"""Rewriting of a feed's bronze: few files for each month, and flags in the rows instead of in ``retired``."""

from pyspark.sql import DataFrame

from newsloom.operators.audit import Audit
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.plans.bronze import index_files, named, read_by
from newsloom.plans.warehouse import Warehouse
from newsloom.session import dropping
from newsloom.sources import tables
from newsloom.sources.schemas import BRONZE, BRONZE_PARTITIONS, MONTH

FILES_PER_MONTH = 4


def months_with_retired(warehouse: Warehouse, source: str, limits: Limits = DEFAULT_LIMITS) -> set[str]:
    """The months in which versions were retired: one join of keys, no other column is read."""
    retired = warehouse.stored("retired", source).distinct()
    key = ["source", "id", "updated_at"]
    named = warehouse.stored("bronze", source).select(*key, MONTH)
    met = lookup_join(named, retired, key, "left_semi", True, limits, stored=True)
    return {row[MONTH] for row in met.select(MONTH).distinct().collect()}


def compact(
    warehouse: Warehouse, source: str, run_id: str, files_per_month: int = FILES_PER_MONTH, limits: Limits = DEFAULT_LIMITS
) -> list[str]:
    """Rewrite the months with retired versions or with more than ``files_per_month`` files; returns them.

    The rows stay as readers see them. ``retired`` is empty for the feed afterwards, and the key index names only files that
    are there. A load that commits meanwhile makes this fail and changes nothing; it can be repeated. The old files stay for
    readers of older versions, until ``vacuum``.
    """
    warehouse = warehouse.at()
    spark = warehouse.spark
    with Audit(spark, warehouse.path("audit"), run_id, f"compact {source}") as audit, dropping(spark):
        change = warehouse.change(read_by(source))
        within = f"source={source}/"
        files: dict[str, list[str]] = {}
        for file in change.of("bronze", within):
            files.setdefault(named(file).partition("/")[0], []).append(file)
        crowded = {month for month, listed in files.items() if len(listed) > files_per_month}
        months = sorted(crowded | months_with_retired(warehouse, source, limits))
        if not months:
            return []
        old = [file for month in months for file in files[month]]
        rows = warehouse.marked(warehouse.files("bronze", old), source, limits).select(BRONZE.fieldNames())
        new = change.append(tables.few_files(rows, MONTH), "bronze", BRONZE_PARTITIONS)
        change.remove("bronze", old)
        change.remove("retired", change.of("retired", within))
        before = change.of("bronze_keys", within)
        if before:
            kept = index_without(warehouse.stored("bronze_keys", source), old)
            change.append(tables.few_files(kept, "source"), "bronze_keys", ["source"])
            change.remove("bronze_keys", before)
        count = warehouse.files("bronze", new).count()
        index_files(warehouse, change, new, count)
        change.commit("compact")
        audit.stage("bronze", count)
    return months


def index_without(index: DataFrame, files: list[str]) -> DataFrame:
    gone = index.sparkSession.createDataFrame([(named(file),) for file in files], "file string")
    return lookup_join(index, gone, ["file"], "left_anti", stored=True)
