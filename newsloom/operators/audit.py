"""Rows of the run audit."""

from collections.abc import Sequence
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.schemas import AUDIT
from newsloom.sources.tables import append

# The states of a stage.
RUNNING, COMPLETED, FAILED = "Running", "Completed", "Failed"


def stage_counts(frames: dict[str, DataFrame], process: str, status: str = COMPLETED) -> DataFrame:
    """One row per stage with the number of rows of its frame."""
    rows = [
        frame.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(process).alias("process_name"), F.lit(stage).alias("stage"),
            F.lit(status).alias("status"), "record_count",
        )
        for stage, frame in frames.items()
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.union(row)
    return table


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whatever action computes it, so no extra job counts them."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


class Audit:
    """Appends the stages of one run to the audit table, failures included.

    The start is written at once, so a run whose driver is killed leaves a "Running" without an end.

    >>> with Audit(spark, path, run_id, "load articles") as audit:
    ...     audit.stage("merge", audit.count(df, write))
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str, process: str):
        self.spark, self.path, self.run_id, self.process = spark, path, run_id, process
        self.rows: list[Sequence] = []

    def stage(self, stage: str, records: int = 0, status: str = COMPLETED) -> None:
        now = datetime.now(timezone.utc)
        self.rows.append((self.run_id, now, self.process, stage, status, records))

    def count(self, df: DataFrame, action) -> int:
        """Run ``action`` on ``df`` and return the number of rows it handled."""
        df, observation = counted(df, f"{self.process} {uuid.uuid4().hex}")
        action(df)
        return observation.get["rows"]

    def _store(self) -> None:
        append(self.spark.createDataFrame(self.rows, AUDIT).coalesce(1), self.path)
        self.rows = []

    def __enter__(self) -> "Audit":
        self.stage("start", status=RUNNING)
        self._store()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.stage("end" if error is None else f"end: {kind.__name__}", 0, FAILED if error else COMPLETED)
        self._store()
