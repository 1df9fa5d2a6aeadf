"""Landed pages of one feed into the bronze table of document versions."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import keys, merge
from newsloom.operators.audit import Audit
from newsloom.operators.flatten import flatten_documents
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.plans.warehouse import Warehouse
from newsloom.session import cut_lineage, dropping
from newsloom.sources import feeds, tables
from newsloom.sources.schemas import BRONZE, BRONZE_KEYS, BRONZE_PARTITIONS, DOCUMENT_KEY, LEDGER, MONTH, REJECTS, RESCUED
from newsloom.sources.snapshots import Change

POLICIES = ("history", "flag_only")
# A batch of more keys asks all files: it would open most of them anyway.
INDEXED_KEYS = 100_000
# What a row of a batch counts for when it is asked whether its keys can be broadcast.
KEY_BYTES = 64


def with_month(documents: DataFrame) -> DataFrame:
    month = F.date_format(F.col("published_at"), "yyyy-MM")
    return documents.withColumn(MONTH, F.coalesce(month, F.lit("unknown")))


def active_documents(warehouse: Warehouse, source: str) -> DataFrame:
    """The current version of each document of a feed."""
    return warehouse.table("bronze", source).filter("is_active")


def flat_documents(warehouse: Warehouse, source: str) -> DataFrame:
    """All versions of a feed, one row per author, launch and event combination."""
    return flatten_documents(warehouse.table("bronze", source).drop(MONTH))


def named(file: str) -> str:
    """What the key index calls a bronze file: its month and name, as one write gives one name in several months."""
    *_, month, name = file.split("/")
    return f"{month.partition('=')[2]}/{name}"


def files_with(
    warehouse: Warehouse, source: str, ids: DataFrame, files: Sequence[str] | None = None, most: int = INDEXED_KEYS
) -> list[str]:
    """Those of ``files``, a feed's bronze files, that may hold one of ``ids``, by the index; all for more than ``most`` ids.

    A file that the index does not know, as it was written before there was one, may hold any.
    """
    if files is None:
        files = warehouse.snapshot().of("bronze", f"source={source}/")
    if len(files) < 2 or ids.limit(most + 1).count() > most:
        return files
    index = warehouse.stored("bronze_keys", source)
    found = keys.holding(index, ids, "id", "file").select("file", F.lit(True).alias("may"))
    told = index.select("file").distinct().join(F.broadcast(found), "file", "left")
    may = {row["file"]: row["may"] for row in told.collect()}  # a row for each file
    return [file for file in files if may.get(named(file), True)]


def stored_versions(
    warehouse: Warehouse, source: str, arrived: DataFrame, limits: Limits = DEFAULT_LIMITS, files: Sequence[str] | None = None
) -> DataFrame:
    """Key, version and stored flag of the stored versions of ``arrived`` keys, read from the files that may hold them."""
    rows = warehouse.files("bronze", files_with(warehouse, source, arrived.select("id"), files))
    named = rows.select(*DOCUMENT_KEY, "updated_at", "is_active")
    return lookup_join(named, arrived, list(DOCUMENT_KEY), "left_semi", limits=limits, stored=True)


def index_files(warehouse: Warehouse, change: Change, files: Sequence[str], count: int) -> None:
    """Note the keys of new bronze files, which hold ``count`` versions together."""
    if files:
        name = F.concat_ws("/", MONTH, F.col("_metadata.file_name"))
        rows = warehouse.files("bronze", files).select("source", "id", name.alias("file"))
        index = keys.key_index(rows, "id", ["source", "file"], count / len(files)).select(BRONZE_KEYS.fieldNames())
        change.append(tables.few_files(index, "source"), "bronze_keys", ["source"])


def merge_batch(
    warehouse: Warehouse, source: str, documents: DataFrame, policy: str = "history",
    limits: Limits = DEFAULT_LIMITS, change: Change | None = None,
) -> int:
    """Merge typed documents of a feed into bronze and return how many versions were added.

    Nothing stored is rewritten: new versions are appended, and versions that are no longer active are noted by
    key and version in a narrow table that readers join, so a batch writes in proportion to itself, and reads the files
    that may hold its keys. The keys of a batch too large to broadcast are compared with those of all files in one aggregate.
    All becomes visible with the commit: with ``change`` the caller's, else one made here.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}, not {policy!r}")
    own = change is None
    if own:
        warehouse = warehouse.at()
        change = warehouse.change(read_by(source))
    key = list(DOCUMENT_KEY)
    change.adopt("retired")
    incoming = with_month(documents).select(BRONZE.fieldNames())
    held = change.of("bronze", f"source={source}/")
    if policy == "history":
        if incoming.count() <= max(INDEXED_KEYS, limits.table_bytes // KEY_BYTES):
            arrived = cut_lineage(incoming.select(key).distinct())
            known = stored_versions(warehouse, source, arrived, limits, held)
        else:
            known = warehouse.files("bronze", held)
        accepted = merge.accepted_versions(known, incoming, key)
        added = merge.activated(accepted)
        retired = accepted.filter("known").select(*[F.col(f"new.{name}").alias(name) for name in key], F.col("stored").alias("updated_at"))
    else:
        arrived = cut_lineage(incoming.select(key).distinct())
        known = cut_lineage(stored_versions(warehouse, source, arrived, limits, held))
        added = cut_lineage(merge.unknown_keys(known, incoming, key, limits=limits))
        noted = warehouse.stored("retired", source)
        retired = cut_lineage(lookup_join(known.select(*key, "updated_at").distinct(), noted, [*key, "updated_at"], "left_anti", True, limits))
    files = change.append(tables.few_files(added, MONTH), "bronze", BRONZE_PARTITIONS)
    change.append(tables.few_files(retired, "source"), "retired", ["source"])
    count = added.count()
    index_files(warehouse, change, files, count)
    if own:
        change.commit()
    return count


def read_by(source: str) -> list[str]:
    """What a load of a feed rests on: of two loads at once the second fails and is repeated."""
    return [f"bronze/source={source}/", f"retired/source={source}/"]


def load_documents(
    warehouse: Warehouse, source: str, raw: DataFrame, run_id: str, policy: str = "history",
    limits: Limits = DEFAULT_LIMITS, since: datetime | None = None, broken: DataFrame | None = None,
    rescued: DataFrame | None = None, loaded: DataFrame | None = None,
) -> None:
    """Raw documents of a feed: type them, set rejects aside, merge the rest, audit every stage.

    The merge decides per key what is new, so pages may come late, twice or in any order. ``since`` leaves out
    documents that are not newer than it, for those who ask for a part of the history only. ``broken`` are pages
    that could not be read, ``rescued`` fields beyond the schema, and ``loaded`` the files that the ledger gets. All of it
    becomes visible by one commit.
    """
    warehouse = warehouse.at()
    with Audit(warehouse.spark, warehouse.path("audit"), run_id, f"load {source}") as audit, dropping(warehouse.spark):
        change = warehouse.change(read_by(source))

        def write(name: str, schema, found: DataFrame) -> int:
            wide = found.withColumn("run_id", F.lit(run_id)).select(schema.fieldNames())
            return audit.count(wide, lambda rows: change.append(rows, name, ["source"]))

        typed = cut_lineage(feeds.typed(feeds.conform(raw), source))
        accepted, rejected = feeds.split_rejects(typed)
        if broken is not None:
            rejected = rejected.unionByName(feeds.rejected_pages(broken, source), allowMissingColumns=True)
        else:
            rejected = rejected.withColumn("page", F.lit(None).cast("string"))
        audit.stage("reject", write("rejects", REJECTS, rejected))
        if rescued is not None and not rescued.isEmpty():
            audit.stage("rescued", write("rescued", RESCUED, rescued))
        if since is not None:
            accepted = feeds.newer_than(accepted, since)
        merged = merge_batch(warehouse, source, accepted, policy, limits, change)
        if loaded is not None:
            write("ledger", LEDGER, loaded.withColumn("source", F.lit(source)))
        change.commit()
        audit.stage("merge", merged)


def load_feed(
    warehouse: Warehouse, source: str, landing: str, run_id: str, policy: str = "history",
    limits: Limits = DEFAULT_LIMITS, since: datetime | None = None, multi_line: bool = False,
) -> None:
    """Load the page files under ``landing``; pages that are no envelopes are set aside and counted.

    Under the history policy a file is read once: those in the feed's ledger with the same length and time are left
    alone. ``flag_only`` takes down the flag of whatever comes again, so it reads all; so does a load of a part of the history
    (``since``), which enters nothing in the ledger either.
    """
    spark = warehouse.spark
    with dropping(spark):
        fresh = None
        paths = [landing]
        if policy == "history" and since is None:
            fresh = cut_lineage(feeds.new_files(spark, landing, warehouse.stored("ledger", source)))
            paths = [row["path"] for row in fresh.select("path").collect()]  # the reader needs their names on the driver
        texts = feeds.landed_pages(spark, paths, multi_line) if paths else feeds.parsed_pages(
            spark.createDataFrame([], "value string")
        )
        load_pages(warehouse, source, texts, run_id, policy, limits, since, fresh)


def load_pages(
    warehouse: Warehouse, source: str, pages: DataFrame, run_id: str, policy: str = "history",
    limits: Limits = DEFAULT_LIMITS, since: datetime | None = None, loaded: DataFrame | None = None,
) -> None:
    """Load parsed pages, which are stored once and then read for their documents, broken pages and rescued fields."""
    with dropping(warehouse.spark):
        load_stored_pages(warehouse, source, cut_lineage(pages), run_id, policy, limits, since, loaded)


def load_stored_pages(
    warehouse: Warehouse, source: str, pages: DataFrame, run_id: str, policy: str = "history",
    limits: Limits = DEFAULT_LIMITS, since: datetime | None = None, loaded: DataFrame | None = None,
) -> None:
    """``load_pages`` of pages that may be read more than once."""
    load_documents(
        warehouse, source, feeds.unnest_pages(pages), run_id, policy, limits, since, feeds.broken_pages(pages),
        feeds.rescued_fields(pages, source), loaded,
    )
