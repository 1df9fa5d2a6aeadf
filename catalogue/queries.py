"""One query per operator. Each reads whole tables under ``sf_dir`` and returns a DataFrame.

The tables stand in for feeds: documents are articles, pages give URLs, orders are versions of a record.
"""

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.arrays import argmax_index
from newsloom.functions.instants import parse_instant
from newsloom.functions.stopwords import TITLE_STOP_WORDS
from newsloom.functions.words import clean_summary, clean_title, domain_of, tokens, without
from newsloom.operators import content, dimensions, entities, merge, sentiment, terms, topics, trends
from newsloom.operators.audit import Audit
from newsloom.operators.flatten import flatten_documents
from newsloom.operators.lookup import lookup_join
from newsloom.plans import bronze, silver
from newsloom.plans.compaction import compact
from newsloom.plans.warehouse import Warehouse
from newsloom.session import cut_lineage, shared_folder
from newsloom.sources import feeds
from newsloom.sources.schemas import ANALYSIS, RAW_DOCUMENT, SOCIALS
from newsloom.sources.tables import by_count, preview, spread

QUERIES = {}


def query(run, name: str | None = None):
    QUERIES[name or run.__name__] = run
    return run


def named(name: str):
    """Register under a name that an operator of this module already has."""
    return lambda run: query(run, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_table(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def articles(spark, sf_dir) -> DataFrame:
    """The documents as (source, id, title, summary, news_site, url, published_at)."""
    renamed = table(spark, sf_dir, "documents").select(
        F.lit("articles").alias("source"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("title"),
        F.col("text").alias("summary"),
        F.col("source").alias("news_site"),
        F.format_string("https://%s.example.org/%s", "lang", "source").alias("url"),
        F.lit(None).cast("timestamp").alias("published_at"),
    )
    return spread(renamed)


def summaries(spark, sf_dir) -> DataFrame:
    """The documents as (doc_id, summary)."""
    return documents_table(spark, sf_dir).select("doc_id", F.col("text").alias("summary"))


def lexicon(spark, sf_dir) -> DataFrame:
    """A valence from -4 to 4 for each word of the benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(tokens(clean_summary("text"))).alias("token"))
    return words.distinct().withColumn("valence", (F.length("token") % 9 - 4).cast("double"))


def gazetteer(spark, sf_dir) -> DataFrame:
    """Names of one to three words, one after the other through the whole of each benchmark text, a label each."""
    words = table(spark, sf_dir, "benchmark").select("item_id", tokens("text").alias("words"))
    size = (F.col("item_id") % 3 + 1).cast("int")
    label = F.get(F.array(*[F.lit(name) for name in entities.LABELS]), (F.col("item_id") % 3).cast("int"))
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), size)).alias("start")
    placed = words.select("words", size.alias("size"), label.alias("label"), starts)
    return placed.select(F.array_join(F.slice("words", F.col("start"), F.col("size")), " ").alias("phrase"), "label").distinct()


# Scans and sources


@query
def scan_project(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


@query
def page_envelope_unnest(spark, sf_dir):
    """Documents landed as JSON pages of 100 and read as the load reads them."""
    documents = articles(spark, sf_dir)
    number = F.floor(F.col("id").cast("long") / 100)
    pages = documents.groupBy(number.alias("page")).agg(
        F.collect_list(F.struct("id", "title", "summary", "news_site", "url")).alias("results")
    )
    landing = scratch(spark)
    pages.select("results").write.json(landing)
    return feeds.unnest_pages(feeds.landed_pages(spark, landing)).select("id", "title", "summary", "news_site", "url")


def order_feed(spark, sf_dir) -> DataFrame:
    """Orders as raw documents: pending ones without a key, urgent ones with a malformed date."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("title"),
        stamp.alias("published_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("soon")).otherwise(stamp).alias("updated_at"),
    )
    return feeds.conform(orders)


@query
def typed_rejects(spark, sf_dir):
    accepted, rejected = feeds.split_rejects(feeds.typed(order_feed(spark, sf_dir), "articles"))
    columns = ["source", "id", "title", F.unix_micros("updated_at").alias("updated_us")]
    return accepted.select(*columns, F.lit("").alias("reason")).unionByName(
        rejected.select(*columns, F.col(feeds.REASON).alias("reason"))
    )


@query
def parse_timestamps(spark, sf_dir):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("not a time"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(parse_instant(text)).alias("instant_us")
    )


@query
def ingest_stamp(spark, sf_dir):
    return feeds.stamped(articles(spark, sf_dir).drop("source"), "blogs").select(
        "id", "source", "is_active", F.col("ingested_at").isNotNull().alias("is_stamped")
    )


@query
def high_water_mark(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    per_type = feeds.high_water_mark(events, ("event_type",), "ts")
    never = feeds.high_water_mark(events.filter(F.col("ts").isNull()), (), "ts")
    return per_type.unionByName(never.withColumn("event_type", F.lit("none"))).select(
        "event_type", F.date_format("high_water_mark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark")
    )


@query
def incremental_rows(spark, sf_dir):
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return feeds.newer_than(table(spark, sf_dir, "events"), mark, "ts").select(
        "event_id", "event_type", "value"
    )


# Flattening


def nested_customers(spark, sf_dir) -> DataFrame:
    """Customers as documents with 0 to 2 authors, 0 to 3 launches and 0 or 1 event, or null arrays."""
    number, nation = F.col("c_custkey"), F.col("c_nationkey")

    def some(count: Column, element) -> Column:
        return F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= count), element
        )

    socials = F.struct(*[
        F.concat(F.lit(f"{name}/"), number).alias(name)
        for name in ("youtube", "instagram", "linkedin", "mastodon", "bluesky")
    ])
    customers = table(spark, sf_dir, "customer").select(
        number.cast("string").alias("id"),
        F.col("c_name").alias("title"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY",
            some(nation % 3, lambda i: F.struct(
                F.concat_ws("-", "c_mktsegment", i).alias("name"), F.when(i > 1, socials).alias("socials")
            )),
        ).alias("authors"),
        some(F.floor("c_acctbal") % 4, lambda i: F.struct(
            F.concat_ws("-", number, i).alias("launch_id"), F.col("c_mktsegment").alias("provider")
        )).alias("launches"),
        F.when(
            F.col("c_acctbal") > 0,
            some(nation % 2, lambda i: F.struct((nation + i).alias("event_id"), F.col("c_name").alias("provider"))),
        ).alias("events"),
    )
    return feeds.conform(customers)


@query
def flatten_cross(spark, sf_dir):
    flat = flatten_documents(nested_customers(spark, sf_dir))
    return flat.drop("url", "image_url", "news_site", "summary", "published_at", "updated_at", "featured")


@query
def flatten_single(spark, sf_dir):
    """Lines as authors, without launches or events: a row per line, and one for a document without any."""
    lines = F.array_remove(F.split("text", "\n"), "")
    authors = F.transform(lines, lambda line: F.struct(line.alias("name"), F.lit(None).cast(SOCIALS).alias("socials")))
    documents = documents_table(spark, sf_dir).select(F.col("doc_id").alias("id"), authors.alias("authors"))
    flat = flatten_documents(feeds.conform(documents))
    return flat.select(F.col("id").cast("long").alias("doc_id"), F.col("authors_name").alias("line"))


# Merge


def stored_orders(spark, sf_dir) -> DataFrame:
    """All orders but the pending ones, active, and an older inactive version of the finished ones."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    current = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(True).alias("is_active"),
        F.col("o_orderstatus").alias("status"),
    )
    older = current.filter(F.col("status") == "F").withColumns({
        "updated_at": F.col("updated_at") - F.expr("INTERVAL 30 DAYS"),
        "is_active": F.lit(False),
    })
    return current.unionByName(older).drop("status")


def arriving_orders(spark, sf_dir) -> DataFrame:
    """Every order again, newer, equal or stale by its priority; open orders arrive in two versions."""
    shift = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.expr("INTERVAL 10 DAYS"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.expr("INTERVAL 0 DAYS"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.expr("INTERVAL -5 DAYS"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.expr("INTERVAL 20 DAYS"))
        .otherwise(F.expr("INTERVAL -40 DAYS"))
    )
    orders = table(spark, sf_dir, "orders")
    once = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("again "), "o_orderpriority").alias("title"),
        (F.col("o_orderdate") + shift).alias("updated_at"),
        F.col("o_orderstatus").alias("status"),
    )
    twice = once.filter(F.col("status") == "O").withColumns({
        "title": F.concat(F.lit("late "), "title"),
        "updated_at": F.col("updated_at") + F.expr("INTERVAL 5 DAYS"),
    })
    return once.unionByName(twice).drop("status")


def scratch(spark) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _urgent(spark, sf_dir) -> DataFrame:
    return arriving_orders(spark, sf_dir).filter(F.col("title").contains("1-URGENT"))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd"))


@query
def mark_superseded(spark, sf_dir):
    return _dated(merge.mark_superseded(stored_orders(spark, sf_dir), _urgent(spark, sf_dir), ["id"]))


@query
def new_rows_anti(spark, sf_dir):
    return _dated(merge.new_rows(stored_orders(spark, sf_dir), arriving_orders(spark, sf_dir), ["id"]))


@query
def latest_versions(spark, sf_dir):
    return _dated(merge.latest_versions(arriving_orders(spark, sf_dir), ["id"]))


@query
def merge_flag_only(spark, sf_dir):
    return _dated(
        merge.merge_flag_only(stored_orders(spark, sf_dir), arriving_orders(spark, sf_dir), ["id"])
    )


@query
def merge_history(spark, sf_dir):
    return _dated(
        merge.merge_history(stored_orders(spark, sf_dir), arriving_orders(spark, sf_dir), ["id"])
    )


def order_batches(spark, sf_dir) -> list[DataFrame]:
    """Three batches of orders as raw documents: old versions, current ones, and those that arrive."""
    stored = stored_orders(spark, sf_dir)
    stamp = F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    batches = (stored.filter("NOT is_active"), stored.filter("is_active"), arriving_orders(spark, sf_dir))
    return [batch.select("id", "title", stamp.alias("published_at"), stamp.alias("updated_at")) for batch in batches]


def loaded(spark, sf_dir, after=None) -> Warehouse:
    """A new warehouse with the batches of orders; ``after`` each of them something else is done."""
    warehouse = Warehouse(spark, scratch(spark))
    for run, raw in enumerate(order_batches(spark, sf_dir)):
        bronze.load_documents(warehouse, "articles", raw, f"run {run}")
        if after:
            after(warehouse, f"run {run}")
    return warehouse


@query
def merge_stored(spark, sf_dir):
    """The same merge through the load: three batches of orders into a new warehouse."""
    warehouse = loaded(spark, sf_dir)
    return _dated(warehouse.table("bronze", "articles").select("id", "title", "updated_at", "is_active"))


@query
def merge_compacted(spark, sf_dir):
    """The merged orders as they are stored after a compaction, which leaves nothing in the table of retired versions."""
    warehouse = loaded(spark, sf_dir)
    compact(warehouse, "articles", "compaction", files_per_month=1)
    rows = _dated(warehouse.stored("bronze", "articles").select("id", "title", "updated_at", "is_active"))
    return rows.unionByName(warehouse.stored("retired").select("id", F.lit("retired").alias("title")), allowMissingColumns=True)


@query
def versions_by_index(spark, sf_dir):
    """The stored versions of the twenty oldest orders, read from the files that the key index names."""
    warehouse = loaded(spark, sf_dir)
    oldest = order_batches(spark, sf_dir)[1].orderBy("updated_at", F.col("id").cast("long")).limit(20)
    arrived = cut_lineage(oldest.select(F.lit("articles").alias("source"), "id"))
    return _dated(bronze.stored_versions(warehouse, "articles", arrived).select("id", "updated_at"))


@query
def trends_by_batch(spark, sf_dir):
    """Trends kept up to date batch by batch with signed counts, which must be those of a recount."""
    warehouse = loaded(spark, sf_dir, lambda w, run: silver.refresh_trends(w, "articles", run))
    return warehouse.table("trends", "articles")


@query
def activity_by_batch(spark, sf_dir):
    """Activity of sites kept up to date: three feeds of pages, every third page with a new version of another site."""
    warehouse = Warehouse(spark, scratch(spark))
    pages = page_feed(spark, sf_dir).select(
        "id", "url", "news_site", F.lit("2025-01-01T00:00:00Z").alias("updated_at"), F.lit("page").alias("title")
    )
    moved = pages.filter("id % 3 = 0").withColumns({
        "news_site": F.concat(F.lit("new "), "news_site"), "updated_at": F.lit("2025-02-01T00:00:00Z"),
    })
    for run, batch in enumerate((pages.filter("id % 2 = 0"), pages.filter("id % 2 = 1"), moved)):
        bronze.load_documents(warehouse, "blogs", batch, f"run {run}")
        silver.refresh_trends(warehouse, "blogs", f"run {run}")
    return warehouse.table("sources", "blogs")


@query
def ledger_runs(spark, sf_dir):
    """Documents landed as pages in two parts and loaded four times: how many documents each run took, and whether it read any file."""
    warehouse, landing = Warehouse(spark, scratch(spark)), scratch(spark)
    documents = articles(spark, sf_dir).select("id", "title", "url", F.lit("2025-01-01T00:00:00Z").alias("updated_at"))
    pages = documents.groupBy(F.floor(F.col("id").cast("long") / 100).alias("page")).agg(
        F.collect_list(F.struct("id", "title", "url", "updated_at")).alias("results")
    )
    for run, part in enumerate((0, None, 1, None)):
        if part is not None:
            found = pages.filter(F.col("page") % 2 == part)
            found.select("results").write.mode("append").json(landing)
        bronze.load_feed(warehouse, "articles", landing, f"run {run}")
    merged = warehouse.table("audit").filter("stage = 'merge'").select("run_id", F.col("record_count").alias("merged"))
    runs = warehouse.stored("ledger", "articles").select("run_id", F.lit(True).alias("read")).distinct()
    joined = merged.join(F.broadcast(runs), "run_id", "left")  # a row for each run
    return joined.select("run_id", "merged", F.coalesce("read", F.lit(False)).alias("read_files"))


@query
def rescued_fields(spark, sf_dir):
    """Fields that the schema lacks, kept as variants: the language and length of documents from their pages."""
    warehouse, landing = Warehouse(spark, scratch(spark)), scratch(spark)
    page = table(spark, sf_dir, "documents").select(
        F.array(F.struct(
            F.col("doc_id").alias("id"), F.lit("2025-01-01T00:00:00Z").alias("updated_at"),
            F.col("lang").alias("language"), F.struct("n_chars", "source").alias("size"),
        )).alias("results")
    )
    page.write.json(landing)
    bronze.load_feed(warehouse, "reports", landing, "run")
    return warehouse.table("rescued", "reports").select(
        "id", F.variant_get("fields", "$.language", "string").alias("lang"),
        F.variant_get("fields", "$.size.n_chars", "long").alias("n_chars"), F.variant_get("fields", "$.size.source", "string").alias("source"),
    )


@query
def versions_read(spark, sf_dir):
    """One partition of three is replaced: what readers of the version before and of the latest one see."""
    warehouse = Warehouse(spark, scratch(spark))
    members = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("part "), F.pmod("n_nationkey", F.lit(3))).alias("source"), F.col("n_name").alias("news_site"),
        F.lit("").alias("domain_url"), F.col("n_regionkey").cast("long").alias("count"),
    )
    first = warehouse.change()
    first.append(members, "sources", ["source"])
    before = first.commit().version
    second = warehouse.change()
    second.remove("sources", second.of("sources", "source=part 1/"))
    second.append(members.filter("source = 'part 1'").withColumn("count", F.col("count") + 100), "sources", ["source"])
    second.commit()
    read = [warehouse.at(v).stored("sources").select(F.lit(name).alias("version"), "source", "news_site", "count")
            for name, v in (("before", before), ("latest", None))]
    return read[0].unionByName(read[1])


@query
def union_missing_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


# Text


@named("clean_summary")
def clean_summaries(spark, sf_dir):
    return documents_table(spark, sf_dir).select("doc_id", clean_summary("text").alias("clean_summary"))


@named("clean_title")
def clean_titles(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", clean_title("text").alias("clean_title")
    )


def _listed(words: Column) -> list[Column]:
    return [F.size(words).alias("n_tokens"), F.array_join(words, " ").alias("token_text")]


@named("tokens")
def summary_tokens(spark, sf_dir):
    return documents_table(spark, sf_dir).select("doc_id", *_listed(tokens(clean_summary("text"))))


@query
def tokens_no_stopwords(spark, sf_dir):
    return terms.summary_tokens(summaries(spark, sf_dir)).select("doc_id", *_listed(F.col("tokens")))


@query
def title_tokens_no_stopwords(spark, sf_dir):
    words = without(tokens(clean_title("text")), TITLE_STOP_WORDS)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", *_listed(words))


@query
def term_counts(spark, sf_dir):
    return terms.term_counts(summaries(spark, sf_dir), ["doc_id"])


@query
def vocabulary_top1000(spark, sf_dir):
    return terms.vocabulary(summaries(spark, sf_dir))


@query
def document_frequency(spark, sf_dir):
    return terms.document_frequency(summaries(spark, sf_dir))


@query
def tfidf(spark, sf_dir):
    weighted = terms.tfidf(summaries(spark, sf_dir), key=["doc_id"])
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


@query
def tfidf_vocabulary(spark, sf_dir):
    """TF-IDF of the vocabulary's terms only, the features of the topic model."""
    documents = summaries(spark, sf_dir)
    words = cut_lineage(terms.vocabulary(documents))
    weighted = terms.tfidf(documents, words, key=["doc_id"])
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


@query
def keywords_top5(spark, sf_dir):
    return terms.keywords(tfidf(spark, sf_dir), 5, key=["doc_id"]).select("doc_id", "rank", "term", "tfidf")


# Enrichment


@named("argmax_index")
def argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", argmax_index("embedding").alias("topic"))


@query
def lda_topics(spark, sf_dir):
    documents = summaries(spark, sf_dir)
    model = topics.fit_topics(documents)
    return topics.assign_topics(model, documents, ["doc_id"])


@query
def topic_terms(spark, sf_dir):
    return topics.fit_topics(summaries(spark, sf_dir)).top_terms("articles")


@query
def lda_topics_checked(spark, sf_dir):
    """What must hold of any topic model: a distribution per document, a topic of those there are, or none."""
    found = lda_topics(spark, sf_dir)
    mass = F.aggregate("topic_distribution", F.lit(0.0), lambda total, share: total + share)
    return found.select(
        "doc_id", F.round(mass, 6).alias("mass"), F.col("topic").isNull().alias("no_topic"),
        F.coalesce(F.col("topic").between(0, topics.TOPICS - 1), F.lit(True)).alias("in_range"),
    )


@query
def topic_terms_checked(spark, sf_dir):
    """Topics, how many top terms each has and how many of these are in the vocabulary."""
    documents = summaries(spark, sf_dir)
    listed = topics.fit_topics(documents).top_terms("articles").select("topic", F.explode("top_terms").alias("term"))
    words = terms.vocabulary(documents).select("term", F.lit(1).alias("known"))
    joined = lookup_join(listed, cut_lineage(words), ["term"], "left")
    return joined.groupBy("topic").agg(F.count("*").alias("n_terms"), F.count("known").alias("n_known"))


@query
def topic_vectors(spark, sf_dir):
    """The model's input: the TF-IDF weight of each vocabulary term of a document."""
    documents = summaries(spark, sf_dir)
    model = topics.fit_topics(documents, iterations=1)
    words = F.array(*[F.lit(word) for word in model.counts.vocabulary])
    placed = model.features(documents, ["doc_id"]).select("doc_id", F.posexplode(vector_to_array("features")).alias("at", "weight"))
    weighted = placed.filter("weight > 0")
    return weighted.select("doc_id", F.get(words, F.col("at")).alias("term"), F.round("weight", 6).alias("weight"))


@query
def topics_continued(spark, sf_dir):
    """The numbers that topics of a refit take over: vectors of four labels as term weights, those of other vectors in another order."""
    listed = table(spark, sf_dir, "embeddings").filter("label < 4").select(
        "vec_id", "label", F.posexplode("embedding").alias("term", "x")
    )

    def weights(rows, topic):
        return rows.groupBy(topic.cast("long").alias("topic"), "term").agg(F.avg(F.abs("x").cast("double")).alias("weight"))

    stored = weights(listed.filter("vec_id % 2 = 0"), F.col("label"))
    new = cut_lineage(weights(listed.filter("vec_id % 2 = 1"), (F.col("label") + 1) % 4))
    numbers = topics.lasting_numbers(new, cut_lineage(stored), 4)
    return spark.createDataFrame(list(enumerate(numbers)), "topic long, number long")


@named("sentiment")
def sentiment_score(spark, sf_dir):
    scored = sentiment.sentiment_scores(articles(spark, sf_dir), lexicon(spark, sf_dir))
    return scored.select("id", F.round("sentiment_score", 6).alias("sentiment_score"))


@named("entities")
def entity_lists(spark, sf_dir):
    found = entities.entities(articles(spark, sf_dir), gazetteer(spark, sf_dir))
    return found.select("id", *[F.array_join(name, "|").alias(name) for name in entities.LABELS.values()])


@query
def content_analysis(spark, sf_dir):
    """The analysis table without the topics, which only the model can tell."""
    score, tag = content.table_features(lexicon(spark, sf_dir), gazetteer(spark, sf_dir))
    return content.enriched(articles(spark, sf_dir), score, tag).withColumns({
        "sentiment_score": F.round("sentiment_score", 6),
        **{name: F.array_join(name, "|") for name in entities.LABELS.values()},
    })


@query
def analysis_row(spark, sf_dir):
    """The whole analysis table as the job makes it; of the topics, what must hold of any model."""
    score, tag = content.table_features(lexicon(spark, sf_dir), gazetteer(spark, sf_dir))
    found, _ = content.content_analysis(articles(spark, sf_dir), "articles", score, tag)
    mass = F.aggregate("topic_distribution", F.lit(0.0), lambda total, share: total + share)
    largest = F.get("topic_distribution", F.col("topic").cast("int")) == F.array_max("topic_distribution")
    return found.withColumns({
        "sentiment_score": F.round("sentiment_score", 6), "mass": F.round(mass, 6), "no_topic": F.col("topic").isNull(),
        "largest": F.coalesce(largest, F.lit(True)), **{name: F.array_join(name, "|") for name in entities.LABELS.values()},
    }).drop("topic_distribution", "topic")


@query
def topic_weights_checked(spark, sf_dir):
    """Of each topic, the terms it weighs, how many of them are in the vocabulary, and the sum of the weights."""
    documents = summaries(spark, sf_dir)
    weights = topics.fit_topics(documents, iterations=2).weights("articles")
    words = terms.vocabulary(documents).select("term", F.lit(1).alias("known"))
    joined = lookup_join(weights, cut_lineage(words), ["term"], "left")
    return joined.groupBy("topic").agg(
        F.count("*").alias("n_terms"), F.count("known").alias("n_known"), F.round(F.sum("weight"), 6).alias("total")
    )


# Trends


@query
def word_trends_monthly(spark, sf_dir):
    """Part names as titles, published when shipped."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title")
    )
    shipped = spread(table(spark, sf_dir, "lineitem")).select(
        F.lit("articles").alias("source"), F.col("l_partkey").alias("id"),
        F.col("l_shipdate").alias("published_at"),
    )
    return trends.word_trends(lookup_join(shipped, parts, ["id"]))


@query
def word_trends_by_source(spark, sf_dir):
    """Three feeds together: documents, conversations and benchmark texts, published a day after the other."""
    feeds_ = {
        "articles": documents_table(spark, sf_dir).withColumnRenamed("doc_id", "id"),
        "blogs": table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "id"),
        "reports": table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "id"),
    }
    together = None
    for name, feed in feeds_.items():
        titled = feed.select(
            F.lit(name).alias("source"), "id", F.col("text").alias("title"),
            F.timestamp_seconds(F.col("id") * 86400).alias("published_at"),
        )
        together = titled if together is None else together.unionByName(titled)
    return trends.word_trends(together)


@query
def top_trends(spark, sf_dir):
    """The ten most frequent words and months."""
    ranked = by_count(word_trends_monthly(spark, sf_dir), ties=["year", "month", "word"])
    return preview(ranked, 10)


def page_feed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.lit("articles").alias("source"), F.col("page_id").alias("id"), "url",
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("news_site"),
    )


@query
def source_activity(spark, sf_dir):
    return trends.source_activity(page_feed(spark, sf_dir))


# Star schema


@query
def dim_news_source(spark, sf_dir):
    return dimensions.dim_news_source(source_activity(spark, sf_dir))


@query
def dim_news_source_grown(spark, sf_dir):
    """The dimension of the http pages, then of all pages: old members keep their keys."""
    first = page_feed(spark, sf_dir).filter(F.col("url").startswith("http://"))
    existing = dimensions.dim_news_source(trends.source_activity(first))
    return dimensions.dim_news_source(source_activity(spark, sf_dir), existing)


def vector_topics(spark, sf_dir) -> DataFrame:
    return argmax(spark, sf_dir).select(
        F.lit("articles").alias("source"), F.col("vec_id").cast("string").alias("id"),
        F.col("topic").cast("long").alias("topic"),
    )


@query
def dim_topic(spark, sf_dir):
    return dimensions.dim_topic(vector_topics(spark, sf_dir)).drop("top_terms")


@query
def fact_article(spark, sf_dir):
    """Documents with the topic of the vector of their number, if there is one."""
    documents = articles(spark, sf_dir)
    topic = vector_topics(spark, sf_dir)
    analysed = documents.join(topic, ["source", "id"], "left").select(
        "source", "id", "title", "news_site", domain_of("url").alias("domain_url"), "topic"
    )
    sites = dimensions.dim_news_source(trends.source_activity(documents))
    return dimensions.fact_article(analysed, sites, dimensions.dim_topic(topic))


@query
def fact_article_measures(spark, sf_dir):
    """The fact with all its measures: the analysis of the documents, and vectors as their topic distributions."""
    documents = articles(spark, sf_dir)
    score, tag = content.table_features(lexicon(spark, sf_dir), gazetteer(spark, sf_dir))
    vectors = table(spark, sf_dir, "embeddings").select(
        F.lit("articles").alias("source"), F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").cast("array<double>").alias("topic_distribution"),
        argmax_index("embedding").cast("long").alias("topic"),
    )
    analysed = content.enriched(documents, score, tag).join(vectors, ["source", "id"], "left").select(ANALYSIS.fieldNames())
    sites = dimensions.dim_news_source(trends.source_activity(documents))
    fact = dimensions.fact_article(analysed, sites, dimensions.dim_topic(vector_topics(spark, sf_dir)))
    return fact.withColumns({
        "sentiment_score": F.round("sentiment_score", 6),
        "topic_distribution": F.array_join(F.transform("topic_distribution", lambda x: F.floor(x * 1000).cast("string")), "|"),
        **{name: F.array_join(name, "|") for name in entities.LABELS.values()},
    })


# Audit


@query
def audit_log(spark, sf_dir):
    """What a run writes of its stages."""
    accepted, rejected = feeds.split_rejects(feeds.typed(order_feed(spark, sf_dir), "articles"))
    path = scratch(spark)
    with Audit(spark, path, "run", "load articles") as audit:
        for stage, rows in (("accepted", accepted), ("rejected", rejected)):
            audit.stage(stage, audit.count(rows, lambda found: found.write.format("noop").mode("overwrite").save()))
    written = spark.read.parquet(path).filter(F.col("stage").isin("accepted", "rejected"))
    return written.select("process_name", "stage", "status", "record_count")
