"""Parquet tables: scans, partitioned sinks and staged replacement."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Names of a table that waits to be swapped in, and of one that was swapped out.
STAGED, RETIRED = "__new", "__old"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there and holds anything."""
    place, files = _path(spark, path)
    return files.exists(place) and len(files.listStatus(place)) > 0


def scan(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A Parquet table, only ``columns`` of it if given. Files of older schemas are filled with nulls."""
    table = spark.read.option("mergeSchema", True).parquet(path)
    return table.select(*columns) if columns else table


def spread(table: DataFrame) -> DataFrame:
    """A scanned table over all cores: one of fewer splits than cores is dealt out row by row, so no key is hot.

    A table with as many splits is left as it is, which is the case for any that takes long.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in its canonical schema, or no rows if it was never written."""
    recover(spark, path)
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] = ("source",)) -> None:
    """Replace the partitions that ``df`` has rows for; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def clear_partitions(spark: SparkSession, path: str, by: str, keep: Sequence[str]) -> None:
    """Delete the partitions of column ``by`` whose value is not in ``keep``.

    Overwriting partitions cannot clear one that has no rows any more. Values are names of feeds, which stand
    in folder names as they are.
    """
    if not exists(spark, path):
        return
    place, files = _path(spark, path)
    kept = {f"{by}={value}" for value in keep}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith(f"{by}=") and name not in kept:
            files.delete(status.getPath(), True)
    spark.catalog.refreshByPath(path)


def clear_partition(spark: SparkSession, path: str, by: str, value: str) -> None:
    """Delete one partition, if it is there."""
    place, files = _path(spark, f"{path}/{by}={value}")
    if files.exists(place):
        files.delete(place, True)
        spark.catalog.refreshByPath(path)


def few_files(df: DataFrame, *by: str) -> DataFrame:
    """Bring the rows of a partition together for writing; a hot partition is split into even parts."""
    return df.hint("rebalance", *[F.col(name) for name in by])


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_aside(df: DataFrame, path: str) -> None:
    """Append to an unpartitioned table that others append to at the same time.

    Spark's writers share a folder for unfinished files within the table and the first to end removes it, so the files are
    written beside the table and moved in.
    """
    spark = df.sparkSession
    beside = f"{path}__{uuid.uuid4().hex}"
    df.write.parquet(beside)
    source, files = _path(spark, beside)
    target, _ = _path(spark, path)
    files.mkdirs(target)
    for status in files.listStatus(source):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            _rename(files, status.getPath(), _path(spark, f"{path}/{name}")[0])
    files.delete(source, True)


def replace_table(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path`` and swap it in, so that ``df`` may read ``path`` itself.

    A failed write leaves the table as it was. The swap is two renames, not one atomic step; ``recover``
    undoes a half one.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path + STAGED)
    target, files = _path(spark, path)
    staged, _ = _path(spark, path + STAGED)
    retired, _ = _path(spark, path + RETIRED)
    if files.exists(target):
        files.delete(retired, True)
        _rename(files, target, retired)
    _rename(files, staged, target)
    files.delete(retired, True)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the old table if a swap stopped between its two renames."""
    target, files = _path(spark, path)
    retired, _ = _path(spark, path + RETIRED)
    if files.exists(retired) and not files.exists(target):
        _rename(files, retired, target)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)


def by_count(df: DataFrame, count: str = "count", ties: Sequence[str] = ()) -> DataFrame:
    """Largest counts first; ``ties`` fix the order of equal counts."""
    return df.orderBy(F.desc(count), *ties)
