"""Command line: load feeds and refresh the tables built from them.

    python -m newsloom.plans.refresh --warehouse W --landing L --lexicon X --gazetteer G

or ``spark-submit --py-files newsloom.zip newsloom/plans/refresh.py`` with the same options.

Pages are expected under L/articles, L/blogs and L/reports.
"""

import argparse
import uuid
from datetime import datetime

from newsloom.operators.content import Feature, table_features
from newsloom.plans.bronze import POLICIES, load_feed
from newsloom.plans.gold import refresh_gold
from newsloom.plans.silver import refresh_analysis, refresh_trends
from newsloom.plans.warehouse import Warehouse
from newsloom.session import build_session
from newsloom.sources.schemas import SOURCES

STEPS = ("load", "analysis", "trends", "gold")


def refresh(
    warehouse: Warehouse, landing: str, score: Feature, tag: Feature, sources=SOURCES, steps=STEPS,
    policy: str = "history", run_id: str | None = None, since: datetime | None = None, multi_line: bool = False,
) -> str:
    """Run the steps for each feed, then the star schema; returns the run's id in the audit table."""
    run_id = run_id or uuid.uuid4().hex
    for source in sources:
        if "load" in steps:
            load_feed(warehouse, source, f"{landing.rstrip('/')}/{source}", run_id, policy, since=since, multi_line=multi_line)
        if "analysis" in steps:
            refresh_analysis(warehouse, source, run_id, score, tag)
        if "trends" in steps:
            refresh_trends(warehouse, source, run_id)
    if "gold" in steps:
        refresh_gold(warehouse, run_id)
    return run_id


def main(arguments=None) -> None:
    parser = argparse.ArgumentParser(description="Load feeds and refresh the tables built from them.")
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("--landing", required=True, help="folder of the landed pages, one per feed inside")
    parser.add_argument("--lexicon", required=True, help="Parquet table (token, valence)")
    parser.add_argument("--gazetteer", required=True, help="Parquet table (phrase, label)")
    parser.add_argument("--source", nargs="*", default=SOURCES, choices=SOURCES)
    parser.add_argument("--step", nargs="*", default=STEPS, choices=STEPS)
    parser.add_argument("--policy", default="history", choices=POLICIES)
    parser.add_argument("--since", type=datetime.fromisoformat, help="leave out documents not newer than this")
    parser.add_argument("--multi-line", action="store_true", help="a page is a file and not a line")
    options = parser.parse_args(arguments)
    spark = build_session("newsloom refresh")
    score, tag = table_features(
        spark.read.parquet(options.lexicon), spark.read.parquet(options.gazetteer)
    )
    refresh(
        Warehouse(spark, options.warehouse), options.landing, score, tag, options.source,
        options.step, options.policy, since=options.since, multi_line=options.multi_line,
    )


if __name__ == "__main__":
    main()
