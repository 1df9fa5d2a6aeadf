"""Session defaults and the shared folder that cuts lineage."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "newsloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a folder of
    its own: on a cluster a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="newsloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, into a Parquet table in the shared folder, and go on from there.

    What follows reads only the columns it needs, and a lost executor costs no recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    for step in _steps:
        step.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The paths that the steps now running have stored.
_steps: list[list[str]] = []


@contextmanager
def dropping(spark: SparkSession):
    """Delete what ``cut_lineage`` stores within the block when it ends.

    For steps that write their results elsewhere; frames that read those intermediate tables end with the block.
    """
    stored: list[str] = []
    _steps.append(stored)
    try:
        yield
    finally:
        _steps.remove(stored)
        for path in stored:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete what ``cut_lineage`` stored for each of ``tables``; frames that read them end here."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Within the block the shuffle files of a query are deleted when it ends, not when the driver's collector comes upon them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shared_arrays(spark: SparkSession, *arrays):
    """A broadcast of the bytes of numpy ``arrays``, deleted from all machines at the end of the block."""
    shared = spark.sparkContext.broadcast([a.tobytes() for a in arrays])
    try:
        yield shared
    finally:
        shared.destroy()


def frozen(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder with its partitions and the order of their rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
