"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import time

from catalogue.queries import QUERIES
from newsloom.session import build_session

HEADLINE = """
word_trends_monthly word_trends_by_source source_activity flatten_cross merge_history merge_flag_only
clean_summary tokens_no_stopwords term_counts vocabulary_top1000 tfidf keywords_top5 argmax_index sentiment
entities content_analysis lda_topics dim_news_source fact_article page_envelope_unnest typed_rejects
""".split()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    QUERIES["scan_project"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
