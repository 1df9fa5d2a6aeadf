"""Page files picked up as they land, merged batch by batch into bronze."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators.audit import Audit
from newsloom.plans.bronze import load_stored_pages
from newsloom.plans.warehouse import Warehouse
from newsloom.session import cut_lineage, dropping
from newsloom.sources import feeds
from newsloom.streaming.progress import StreamProgress


def stream_feed(
    warehouse: Warehouse, source: str, landing: str, checkpoint: str, policy: str = "history",
    files_per_batch: int = 10_000, multi_line: bool = False,
) -> StreamingQuery:
    """Merge the page files under ``landing`` that no earlier run has seen, then stop.

    Spark remembers the files it has read in ``checkpoint``, so old pages are not read again. A batch that
    failed is repeated, which changes nothing already stored; only the history policy is taken, as that holds for no other.
    The audit gets the files and pages of each batch, what the load made of them, and a failed end.
    """

    if policy != "history":
        raise ValueError("a repeated batch of another policy would retire its own documents")

    progress = StreamProgress(warehouse.spark, warehouse.path("audit"), source)
    warehouse.spark.streams.addListener(progress)

    def load(texts: DataFrame, batch: int) -> None:
        progress.batch = batch
        spark, run_id = texts.sparkSession, f"{source} batch {batch}"
        with dropping(spark):
            pages = cut_lineage(feeds.parsed_pages(texts))
            with Audit(spark, warehouse.path("audit"), run_id, f"stream {source}") as audit:
                audit.stage("files", pages.select("file").distinct().count())
            load_stored_pages(Warehouse(spark, warehouse.root), source, pages, run_id, policy)

    pages = (
        warehouse.spark.readStream.option("wholetext", multi_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(landing)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    return (
        pages.writeStream.foreachBatch(load)
        .queryName(progress.name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
