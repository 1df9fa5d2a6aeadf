"""Where the tables of a warehouse folder are, and which of their files count."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.operators.trends import totals
from newsloom.sources import schemas
from newsloom.sources.snapshots import Change, Snapshot, Snapshots
from newsloom.sources.tables import scan_or_empty

SCHEMAS = {
    "bronze": schemas.BRONZE,
    "bronze_keys": schemas.BRONZE_KEYS,
    "retired": schemas.RETIRED,
    "rejects": schemas.REJECTS,
    "rescued": schemas.RESCUED,
    "ledger": schemas.LEDGER,
    "analysis": schemas.ANALYSIS,
    "trends": schemas.TRENDS,
    "sources": schemas.ACTIVITY,
    "topic_terms": schemas.TOPIC_TERMS,
    "topic_weights": schemas.TOPIC_WEIGHTS,
    "dim_news_source": schemas.DIM_NEWS_SOURCE,
    "dim_topic": schemas.DIM_TOPIC,
    "audit": schemas.AUDIT,
}
# Tables of signed counts, whose rows are summed up for readers.
COUNTED = ("trends", "sources")


@dataclass(frozen=True)
class Warehouse:
    """The tables as of ``version``, or of the latest version at each read."""

    spark: SparkSession
    root: str
    version: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def snapshots(self) -> Snapshots:
        return Snapshots(self.spark, self.root)

    def snapshot(self) -> Snapshot:
        return self.snapshots().read(self.version)

    def at(self, version: int | None = None) -> "Warehouse":
        """The same tables, held at a version: the latest one unless told otherwise."""
        return replace(self, version=self.snapshots().latest() if version is None else version)

    def change(self, reads: Sequence[str] = ()) -> Change:
        return Change(self.snapshots(), self.snapshot(), reads)

    def files(self, name: str, files: Iterable[str]) -> DataFrame:
        """The rows of some files of a table, with its partition columns."""
        paths = [f"{self.root.rstrip('/')}/{file}" for file in files]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).option("basePath", self.path(name)).parquet(*paths)

    def stored(self, name: str, source: str | None = None) -> DataFrame:
        """A table in its canonical schema as it is stored; a table never written has no rows."""
        snapshot = self.snapshot()
        if name in snapshot.files:
            return self.files(name, snapshot.of(name, f"source={source}/" if source else ""))
        rows = scan_or_empty(self.spark, self.path(name), SCHEMAS[name])
        return rows if source is None else rows.filter(F.col("source") == source)

    def table(self, name: str, source: str | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
        """A table as readers see it, of one feed if asked for.

        Bronze versions that were retired are not active, and signed counts are summed up.
        """
        held = self if self.version is not None else self.at()
        rows = held.stored(name, source)
        if name in COUNTED:
            return totals(rows)
        return held.marked(rows, source, limits) if name == "bronze" else rows

    def marked(self, rows: DataFrame, source: str | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
        """Stored bronze rows with the flag taken down from versions that were retired.

        The rows are a scan, so whatever the size of the join, only heavy keys are stored for it.
        """
        retired = self.stored("retired", source).distinct().withColumn("__retired", F.lit(True))
        marked = lookup_join(rows, retired, ["source", "id", "updated_at"], "left", True, limits, stored=True)
        active = F.col("is_active") & F.col("__retired").isNull()
        return marked.withColumn("is_active", active).select(rows.columns)
