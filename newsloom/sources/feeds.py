"""Landed feed pages to typed documents, and the incremental window over them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.instants import history_start, parse_instant
from newsloom.operators.lookup import lookup_join
from newsloom.sources.schemas import INSTANTS, PAGE, RAW_DOCUMENT

REASON = "reject_reason"
BROKEN = "_broken"


def unnest_pages(pages: DataFrame) -> DataFrame:
    """The documents of page envelopes, one row each; pages without results give none.

    The slice is the whole list. Of a bare column Spark would infer a filter, and parse each page for it a second time.
    """
    whole = F.slice("results", F.lit(1), F.lit((1 << 31) - 1))
    return pages.select(F.explode(whole).alias("document")).select("document.*")


def read_pages(spark: SparkSession, landing: str, multi_line: bool = False) -> DataFrame:
    """The raw documents of all page files under ``landing``.

    One page per line, or one per file with ``multi_line``. A page that is not JSON fails the load.
    """
    reader = spark.read.schema(PAGE).option("mode", "FAILFAST").option("multiLine", multi_line)
    return unnest_pages(reader.json(landing))


def landed_pages(spark: SparkSession, landing: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """All page files under ``landing``, or these files, as (results, extra, broken, page).

    One page per line, or one per file with ``multi_line``. A page is broken if it is not JSON, or has no results,
    as the body of an error has; then ``broken`` says so and ``page`` is its whole text.
    """
    paths = [landing] if isinstance(landing, str) else list(landing)
    return parsed_pages(spark.read.text(paths, wholetext=multi_line))


def parsed_pages(texts: DataFrame) -> DataFrame:
    """Texts of pages (value) parsed; blank ones are left out.

    ``extra`` has for each document the fields that the canonical schema lacks, null where there are none. Other columns
    of ``texts`` stay.
    """
    others = [name for name in texts.columns if name != "value"]
    schema = T.StructType([*PAGE.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    pages = texts.filter(F.trim("value") != "").select(*others, "value", F.from_json("value", schema, options).alias("parsed"))
    results = F.col("parsed.results")
    reason = F.coalesce(F.col(f"parsed.{BROKEN}"), F.when(results.isNull(), F.lit("no results")))
    known = [f.name for f in RAW_DOCUMENT.fields]
    objects = F.try_variant_get(F.try_parse_json("value"), "$.results", "array<map<string,variant>>")
    beyond = F.transform(objects, lambda fields: F.map_filter(fields, lambda name, _: ~name.isin(known)))
    extra = F.transform(beyond, lambda fields: F.when(F.size(fields) > 0, F.to_variant_object(fields)))
    return pages.select(
        *others, F.when(reason.isNull(), results).alias("results"), F.when(reason.isNull(), extra).alias("extra"),
        reason.alias(BROKEN), F.when(reason.isNotNull(), F.col("value")).alias("page"),
    )


def broken_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col(BROKEN).isNotNull()).select(BROKEN, "page")


def rejected_pages(broken: DataFrame, source: str) -> DataFrame:
    """Broken pages as rows for the rejects: the first 1000 signs as title, the whole text as page."""
    return broken.select(
        F.lit(source).alias("source"), F.substring(BROKEN, 1, 1000).alias("title"),
        F.lit("broken page").alias(REASON), "page",
    )


def rescued_fields(pages: DataFrame, source: str) -> DataFrame:
    """(id, updated_at, fields, source): what documents have beyond the canonical fields, of those that have any."""
    documents = pages.select(F.explode(F.arrays_zip("results", "extra")).alias("both"))
    found = documents.filter(F.col("both.extra").isNotNull())
    return found.select(
        F.col("both.results.id").alias("id"), parse_instant(F.col("both.results.updated_at")).alias("updated_at"),
        F.col("both.extra").alias("fields"), F.lit(source).alias("source"),
    )


def listing(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified_at) of the files under ``landing``; their content is not read."""
    files = spark.read.format("binaryFile").load(landing)
    return files.select("path", "length", F.col("modificationTime").alias("modified_at"))


def new_files(spark: SparkSession, landing: str, ledger: DataFrame) -> DataFrame:
    """The files under ``landing`` that the ledger does not have, or has with another length or time."""
    known = ledger.select("path", "length", "modified_at").distinct()
    return lookup_join(listing(spark, landing), known, ["path", "length", "modified_at"], "left_anti")


def conform(documents: DataFrame) -> DataFrame:
    """Any feed's documents with exactly the canonical raw columns, missing ones null, the id as text."""
    have = set(documents.columns)
    return documents.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RAW_DOCUMENT.fields
    ])


def reject_reason(key: Column, instants: dict[str, Column]) -> Column:
    """Why a row cannot be stored, or null: no key, or a timestamp text that does not parse."""
    reason = F.when(key.isNull(), F.lit("null key"))
    for name, text in instants.items():
        reason = reason.when(
            text.isNotNull() & parse_instant(text).isNull(), F.lit(f"malformed {name}")
        )
    return reason


def typed(raw: DataFrame, source: str) -> DataFrame:
    """Raw documents with parsed timestamps, feed name, load time, active flag and reject reason."""
    reason = reject_reason(F.col("id"), {name: F.col(name) for name in INSTANTS})
    tagged = raw.withColumn(REASON, reason)
    return stamped(tagged.withColumns({n: parse_instant(n) for n in INSTANTS}), source)


def stamped(documents: DataFrame, source: str) -> DataFrame:
    """Add the feed name, the load time and the active flag."""
    return documents.withColumns({
        "source": F.lit(source),
        "ingested_at": F.current_timestamp(),
        "is_active": F.lit(True),
    })


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reject reason."""
    return rows.filter(F.col(REASON).isNull()).drop(REASON), rows.filter(F.col(REASON).isNotNull())


def high_water_mark(rows: DataFrame, by: tuple[str, ...] = (), version: str = "updated_at") -> DataFrame:
    """The newest version stored, per ``by`` if given; the start of history where there is none."""
    kind = rows.schema[version].dataType
    return rows.groupBy(*by).agg(
        F.coalesce(F.max(version), history_start(kind)).alias("high_water_mark")
    )


def newer_than(rows: DataFrame, mark, version: str = "updated_at") -> DataFrame:
    """Rows strictly newer than ``mark``, which is one value and reaches the scan as a pushed filter."""
    return rows.filter(F.col(version) > F.lit(mark))
