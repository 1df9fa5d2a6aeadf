"""What a stream did, batch by batch, in the audit table."""

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from newsloom.operators.audit import COMPLETED, FAILED
from newsloom.sources.schemas import AUDIT
from newsloom.sources.tables import append_aside


class StreamProgress(StreamingQueryListener):
    """Writes the pages read by each batch of one query to the audit, and how the query ended.

    The load itself writes what became of the pages under the same run id, so a batch can be followed from its files to its
    merged and rejected rows. The listener leaves with its query.
    """

    def __init__(self, spark: SparkSession, path: str, source: str):
        self.spark, self.path, self.source = spark, path, source
        self.query, self.batch = None, 0  # the load says which batch it is at

    def _write(self, batch: int, stage: str, status: str, count: int) -> None:
        row = (f"{self.source} batch {batch}", datetime.now(timezone.utc), f"stream {self.source}", stage, status, count)
        append_aside(self.spark.createDataFrame([row], AUDIT).coalesce(1), self.path)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.query = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.id == self.query and progress.numInputRows:
            self._write(progress.batchId, "pages", COMPLETED, progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id != self.query:
            return
        if event.exception:
            self._write(self.batch, "end", FAILED, 0)
        self.spark.streams.removeListener(self)

    @property
    def name(self) -> str:
        """The name by which the query is told from others of the session."""
        return f"load {self.source} into {self.path}"
