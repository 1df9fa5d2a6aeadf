"""Line dedup by site-relative frequency: lines that many pages of one site share are boilerplate and are dropped.

A line is compared without white space at its ends. For each host, the pages that contain a line are counted (a
page counts once, however often it has the line) and divided by the host's pages. A line with more than ``ratio``
of the pages, and on ``min_pages`` at least, is dropped wherever the host has it. All of it is DataFrame
functions. A line's 64-bit hash stands for it in counting and in dropping; what is shuffled are (host, hash,
count) rows, summed within each task first, so neither a hot host nor a hot line fills a task.

A host has fewer boilerplate lines than its mean number of lines a page divided by ``ratio``, so they travel as one
array per host. The table of these arrays is stored and measured: below ``broadcast_bytes`` it is broadcast, else
joined by host, where adaptive execution splits a hot host's pages.

Defined results: a null text stays null, an empty one empty, and both count as pages; blank lines stay; a text
whose lines are all boilerplate becomes empty; pages without a host (null) form a host of their own; repeated rows
are pages of their own; other columns pass through, but ``n_dropped`` takes the place of a column of that name;
an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import cut_lineage

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_BYTES = 32 << 20
BLANKS = " \t\r\f\v"


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(BLANKS)))


def boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): the hashes of each host's boilerplate lines, for the hosts that have any."""
    # Every expression stands inside the explode: a column made before it would be computed twice.
    def keys():
        lines = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0)
        return F.explode(F.array_distinct(F.transform(lines, line_key)))

    site = F.col(f"`{host}`").alias("host")
    found = pages.select(site, keys().alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages"))
    found = found.filter(F.col("pages") >= min_pages)
    totals = pages.select(site).groupBy("host").agg(F.count("*").alias("total"))
    totals = totals.withColumnRenamed("host", "of_host")
    shared = found.join(totals, found["host"].eqNullSafe(totals["of_host"]))
    shared = shared.filter(F.col("pages") > F.col("total") * F.lit(ratio))
    return shared.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def line_dedup(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``pages`` without boilerplate lines, and how many lines each lost in ``n_dropped``."""
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("n_dropped", "__host", "__lines")])
    table = cut_lineage(boilerplate(pages, host, text, ratio, min_pages).toDF("__host", "__lines"))
    size = table.agg(F.sum(F.size("__lines") * 8 + F.coalesce(F.octet_length("__host"), F.lit(0)) + 32)).first()[0]
    small = F.broadcast(table) if (size or 0) <= broadcast_bytes else table
    joined = pages.join(small, F.col(f"`{host}`").eqNullSafe(F.col("__host")), "left")
    kept = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x: ~F.array_contains("__lines", line_key(x)))
    cleaned = F.when(F.col("__lines").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
    lines = F.size(F.split(F.col(f"`{text}`"), "\n"))
    dropped = F.when(F.col("__lines").isNull() | F.col(f"`{text}`").isNull(), 0).otherwise(lines - F.size(kept))
    columns = [cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns]
    return joined.select(*columns, dropped.cast("long").alias("n_dropped"))
