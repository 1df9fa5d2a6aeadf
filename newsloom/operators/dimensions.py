"""Star schema: dimensions with lasting keys, and the fact table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.session import cut_lineage, frozen


def numbered(members: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Number distinct members ``first``, ``first + 1``, ... in the given order, without a one-task sort.

    The members are range-partitioned, sorted within partitions and stored; a member's number is its place
    in its partition plus the sizes of the partitions before. Only one row per partition is brought together.
    """
    stored = frozen(members.repartitionByRange(*order).sortWithinPartitions(*order))
    # monotonically_increasing_id is the partition number << 33 plus the row's place in the partition.
    placed = stored.withColumn("__place", F.monotonically_increasing_id()).withColumns({
        "__part": F.shiftrightunsigned("__place", 33),
        "__row": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__part").count().select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.lit(first).cast("long") + F.col("__offset") + F.col("__row"))
        .drop("__place", "__part", "__row", "__offset")
    )


def keyed_dimension(
    members: DataFrame, natural: Sequence[str], name: str, existing: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Members, one per natural key (null counts as a value), with a surrogate key ``name``.

    A member of ``existing`` keeps its key and takes its new attributes; one that is gone stays as it is;
    a new one gets the next number in natural order.
    """
    natural = list(natural)
    if existing is None:
        return numbered(members, natural, name).select(name, *members.columns)
    members, existing = cut_lineage(members), cut_lineage(existing)
    keys = existing.select(name, *natural)
    known = lookup_join(members, keys, natural, null_safe=True, limits=limits)
    new = lookup_join(members, keys, natural, "left_anti", null_safe=True, limits=limits)
    gone = lookup_join(
        existing, members.select(natural), natural, "left_anti", null_safe=True, limits=limits
    )
    last = existing.agg(F.max(name).alias("last")).first()["last"] or 0
    columns = [name, *members.columns]
    fresh = numbered(new, natural, name, first=last + 1)
    return known.select(columns).unionByName(fresh.select(columns)).unionByName(gone.select(columns))


def dim_news_source(
    activity: DataFrame, existing: DataFrame | None = None, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """One row per source, news site and domain, its document count as ``reliability_score``."""
    members = activity.groupBy(
        "source", F.col("news_site").alias("name"), F.col("domain_url").alias("url")
    ).agg(F.sum("count").alias("reliability_score"))
    keyed = keyed_dimension(members, ("source", "name", "url"), "source_id", existing, limits)
    return keyed.select("source_id", "name", "url", "reliability_score", "source")


def dim_topic(
    topics: DataFrame, top_terms: DataFrame | None = None, existing: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per source and topic number; documents without a topic have none here.

    A topic is one of its own feed's model, so equal numbers of two feeds are two members.
    """
    natural = ("source", "topic")
    members = topics.select(*natural).filter(F.col("topic").isNotNull()).distinct()
    if top_terms is None:
        members = members.withColumn("top_terms", F.lit(None).cast("array<string>"))
    else:
        members = lookup_join(members, top_terms, natural, "left", limits=limits)
    keyed = keyed_dimension(members, natural, "topic_id", existing, limits)
    return keyed.select("topic_id", "source", "topic", "top_terms")


def fact_article(
    analysis: DataFrame, news_sources: DataFrame, topics: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The analysed documents with the keys of their news source and topic, one row per document."""
    sites = news_sources.select(
        "source_id", "source", F.col("name").alias("news_site"), F.col("url").alias("domain_url")
    )
    natural = ("source", "news_site", "domain_url")
    with_site = lookup_join(analysis, sites, natural, "left", null_safe=True, limits=limits)
    keyed = lookup_join(
        with_site, topics.select("topic_id", "source", "topic"), ("source", "topic"), "left", limits=limits
    )
    measures = [name for name in analysis.columns if name not in ("id", "news_site", "domain_url")]
    return keyed.select(F.col("id").alias("article_id"), "source_id", "topic_id", *measures)
