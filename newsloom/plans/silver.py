"""The analysis, trend and source tables of one feed."""

import zlib
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.stopwords import SUMMARY_STOP_WORDS, TITLE_STOP_WORDS
from newsloom.operators.audit import Audit
from newsloom.operators.content import Feature, content_analysis
from newsloom.operators.lookup import DEFAULT_LIMITS, Limits, lookup_join
from newsloom.operators.topics import continued, fit_topics
from newsloom.operators.trends import changed, source_activity, totals, word_trends
from newsloom.plans.bronze import active_documents, files_with
from newsloom.plans.warehouse import Warehouse
from newsloom.session import cut_lineage, dropping
from newsloom.sources.schemas import ACTIVITY, TRENDS
from newsloom.sources.tables import clear_partition, few_files, overwrite_partitions


COUNTS = {
    "trends": (TRENDS, word_trends),
    "sources": (ACTIVITY, lambda documents, stop_words: source_activity(documents)),
}
# What the counts read of a document.
COUNTED_COLUMNS = ("source", "id", "title", "news_site", "url", "published_at")
# A feed's counts are folded into one set of files when batches have left more of them than this.
COUNT_FILES = 32


def refresh_trends(
    warehouse: Warehouse, source: str, run_id: str, stop_words: Iterable[str] = TITLE_STOP_WORDS, limits: Limits = DEFAULT_LIMITS
) -> None:
    """Bring the feed's part of ``trends`` and ``sources`` up to date; other feeds stay as they are.

    Counts are sums over active documents, so versions added since the last refresh count plus one and those retired
    since minus one; the signed counts are appended and readers add them up. What is read and written grows with the
    batches. All is counted anew the first time, with other stop words, or if files of the changes are gone.
    """
    warehouse = warehouse.at()
    stop_words = sorted(stop_words)
    with Audit(warehouse.spark, warehouse.path("audit"), run_id, f"trends {source}") as audit, dropping(warehouse.spark):
        change = warehouse.change([f"{name}/source={source}/" for name in COUNTS])
        words = zlib.crc32("\n".join(stop_words).encode())
        batches = changes_since(warehouse, source, limits) if change.base.marks.get(f"words/{source}") == words else None
        if batches is None:
            documents = active_documents(warehouse, source)
        else:  # each count reads both; the retired ones come of joins
            added, lost = batches
            batches = added, cut_lineage(lost.select(*COUNTED_COLUMNS))
        for name, (schema, count) in COUNTS.items():
            old = change.of(name, f"source={source}/")
            if batches is None:
                counted = count(documents, stop_words)
            else:
                counted = changed(partial(count, stop_words=stop_words), *batches)
            if batches is None or len(old) > COUNT_FILES:
                change.remove(name, old)
                if batches is not None:
                    counted = totals(warehouse.files(name, old).unionByName(counted.select(schema.fieldNames())))
            stored = cut_lineage(counted.select(schema.fieldNames()))
            change.append(few_files(stored, "source"), name, ["source"])
            audit.stage(name, stored.count())
        change.marks = {f"counted/{source}": change.base.version, f"words/{source}": words}
        change.commit()


def changes_since(warehouse: Warehouse, source: str, limits: Limits = DEFAULT_LIMITS) -> tuple[DataFrame, DataFrame] | None:
    """Documents that became active, and documents that ceased to be, since the feed's counts were last brought up to date.

    Read from the files that loads have added since then, and from the files that may hold a retired key. None if the counts were
    never made, or if a compaction has replaced some of these files.
    """
    snapshot = warehouse.snapshot()
    since = snapshot.marks.get(f"counted/{source}")
    if since is None:
        return None
    added, removed = warehouse.snapshots().changes(since, snapshot.version)
    within = f"source={source}/"
    new = {name: sorted(f for f in added.get(name, ()) if f.startswith(f"{name}/{within}")) for name in ("bronze", "retired")}
    if any(not set(files) <= set(snapshot.of(name, within)) for name, files in new.items()) or removed & {"bronze", "retired"}:
        return None
    key = ["source", "id", "updated_at"]
    before = warehouse.files("retired", set(snapshot.of("retired", within)) - set(new["retired"])).distinct()
    retired = lookup_join(warehouse.files("retired", new["retired"]).distinct(), before, key, "left_anti", True, limits, stored=True)
    retired = cut_lineage(retired)
    holding = warehouse.files("bronze", files_with(warehouse, source, retired.select("id").distinct()))
    lost = lookup_join(holding.filter("is_active"), retired, key, "left_semi", True, limits, stored=True)
    return warehouse.files("bronze", new["bronze"]).filter("is_active"), lost


def _replace(warehouse: Warehouse, audit: Audit, name: str, source: str, frame: DataFrame) -> int:
    """Replace the feed's partition of a table; one that has no rows any more is cleared. Returns the rows."""
    path = warehouse.path(name)
    rows = audit.count(frame, lambda found: overwrite_partitions(found, path))
    if not rows:
        clear_partition(warehouse.spark, path, "source", source)
    return rows


def refresh_analysis(
    warehouse: Warehouse, source: str, run_id: str, score: Feature, tag: Feature,
    stop_words: Iterable[str] = SUMMARY_STOP_WORDS,
) -> None:
    """Rebuild the feed's part of ``analysis`` and ``topic_terms``; other feeds stay as they are.

    A refit numbers its topics as it comes. Those alike to topics of before take over their numbers, so that a number, and the
    key that it has in the topic dimension, goes on meaning the same topic; the others get numbers never used.

    ``score`` and ``tag`` are usually ``table_features`` of a lexicon and a gazetteer.
    """
    with Audit(warehouse.spark, warehouse.path("audit"), run_id, f"analysis {source}") as audit, dropping(warehouse.spark):
        documents = active_documents(warehouse, source)
        stored = cut_lineage(warehouse.table("topic_weights", source))
        model = continued(fit_topics(documents, stop_words), stored, source)
        analysis, top_terms = content_analysis(documents, source, score, tag, stop_words, model)
        audit.stage("analysis", _replace(warehouse, audit, "analysis", source, analysis))
        if top_terms is not None:
            overwrite_partitions(top_terms, warehouse.path("topic_terms"))
            gone = stored.filter(~F.col("topic").isin(model.numbers))
            weights = model.weights(source).unionByName(gone)
            change = warehouse.change([f"topic_weights/source={source}/"])
            change.remove("topic_weights", change.of("topic_weights", f"source={source}/"))
            change.append(few_files(weights, "source"), "topic_weights", ["source"])
            change.commit()
        else:
            clear_partition(warehouse.spark, warehouse.path("topic_terms"), "source", source)
