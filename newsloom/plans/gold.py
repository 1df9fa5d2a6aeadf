"""The star schema over all feeds."""

from newsloom.operators.audit import Audit
from newsloom.operators.dimensions import dim_news_source, dim_topic, fact_article
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits
from newsloom.plans.warehouse import Warehouse
from newsloom.session import dropping
from newsloom.sources.tables import clear_partitions, overwrite_partitions, replace_table


def refresh_gold(warehouse: Warehouse, run_id: str, limits: Limits = DEFAULT_LIMITS) -> None:
    """Bring the dimensions up to date, store them, then build the fact from the stored keys."""
    spark = warehouse.spark
    with Audit(spark, warehouse.path("audit"), run_id, "star schema") as audit, dropping(spark):
        analysis = warehouse.table("analysis")
        sites = dim_news_source(warehouse.table("sources"), warehouse.table("dim_news_source"), limits)
        topics = dim_topic(
            analysis, warehouse.table("topic_terms"), warehouse.table("dim_topic"), limits
        )
        for name, dimension in (("dim_news_source", sites), ("dim_topic", topics)):
            path = warehouse.path(name)
            audit.stage(name, audit.count(dimension, lambda rows, path=path: replace_table(rows, path)))
        fact = fact_article(
            analysis, warehouse.table("dim_news_source"), warehouse.table("dim_topic"), limits
        )
        path = warehouse.path("fact_article")
        feeds = [row["source"] for row in analysis.select("source").distinct().collect()]
        clear_partitions(spark, path, "source", feeds)
        audit.stage("fact_article", audit.count(fact, lambda rows: overwrite_partitions(rows, path)))
