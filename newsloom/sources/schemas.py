"""The canonical document and the tables built from it."""

from pyspark.sql import types as T

SOURCES = ("articles", "blogs", "reports")

SOCIALS = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("youtube", "instagram", "linkedin", "mastodon", "bluesky")
])
AUTHOR = T.StructType([T.StructField("name", T.StringType()), T.StructField("socials", SOCIALS)])
LAUNCH = T.StructType([
    T.StructField("launch_id", T.StringType()), T.StructField("provider", T.StringType()),
])
EVENT = T.StructType([
    T.StructField("event_id", T.IntegerType()), T.StructField("provider", T.StringType()),
])

# A document as it arrives: the union of the three feeds, the id as text, timestamps still unparsed.
RAW_DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.ArrayType(AUTHOR)),
    T.StructField("url", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("news_site", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("featured", T.BooleanType()),
    T.StructField("launches", T.ArrayType(LAUNCH)),
    T.StructField("events", T.ArrayType(EVENT)),
])
INSTANTS = ("published_at", "updated_at")
PAGE = T.StructType([
    T.StructField("next", T.StringType()),
    T.StructField("results", T.ArrayType(RAW_DOCUMENT)),
])

# Bronze: one row per document version.
DOCUMENT_KEY = ("source", "id")
DOCUMENT = T.StructType(
    [T.StructField("source", T.StringType())]
    + [
        T.StructField(f.name, T.TimestampType()) if f.name in INSTANTS else f
        for f in RAW_DOCUMENT.fields
    ]
    + [T.StructField("ingested_at", T.TimestampType()), T.StructField("is_active", T.BooleanType())]
)

# The month a document was published in, the folder its versions are stored under.
MONTH = "published_month"
BRONZE_PARTITIONS = ("source", MONTH)
BRONZE = T.StructType(DOCUMENT.fields + [T.StructField(MONTH, T.StringType())])
RETIRED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("source", T.StringType()),
])
REJECTS = T.StructType(
    DOCUMENT.fields
    + [T.StructField(name, T.StringType()) for name in ("reject_reason", "page", "run_id")]
)
# Which page files a feed has loaded, by what a listing of the landing folder says of them.
LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
])
# What pages say of documents beyond the canonical fields.
RESCUED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("fields", T.VariantType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
])
# Of each bronze file, its lowest and highest key and the bits of its keys' hashes, a bucket of bits a row.
BRONZE_KEYS = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("low", T.StringType()),
    T.StructField("high", T.StringType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("bits", T.BinaryType()),
    T.StructField("source", T.StringType()),
])

# The names of the nested fields in the flat table.
FLAT_FIELDS = {
    "authors.name": "authors_name",
    "authors.socials.youtube": "authors_socials_youtube",
    "authors.socials.instagram": "authors_socials_instagram",
    "authors.socials.linkedin": "authors_socials_linkedin",
    "authors.socials.mastodon": "authors_socials_mastodon",
    "authors.socials.bluesky": "authors_socials_bluesky",
    "launches.launch_id": "launches_launch_id",
    "launches.provider": "launches_provider",
    "events.event_id": "events_event_id",
    "events.provider": "events_provider",
}

ANALYSIS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("clean_summary", T.StringType()),
    T.StructField("news_site", T.StringType()),
    T.StructField("domain_url", T.StringType()),
    T.StructField("persons", T.ArrayType(T.StringType())),
    T.StructField("organizations", T.ArrayType(T.StringType())),
    T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("topic_distribution", T.ArrayType(T.DoubleType())),
    T.StructField("topic", T.LongType()),
])
TRENDS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("word", T.StringType()),
    T.StructField("count", T.LongType()),
])
ACTIVITY = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("news_site", T.StringType()),
    T.StructField("domain_url", T.StringType()),
    T.StructField("count", T.LongType()),
])
TOPIC_TERMS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("topic", T.LongType()),
    T.StructField("top_terms", T.ArrayType(T.StringType())),
])
# The terms of every topic that a feed has ever had, as of the last model it was in.
TOPIC_WEIGHTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("topic", T.LongType()),
    T.StructField("term", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])
DIM_NEWS_SOURCE = T.StructType([
    T.StructField("source_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("reliability_score", T.LongType()),
    T.StructField("source", T.StringType()),
])
DIM_TOPIC = T.StructType([
    T.StructField("topic_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("topic", T.LongType()),
    T.StructField("top_terms", T.ArrayType(T.StringType())),
])
AUDIT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("execution_date", T.TimestampType()),
    T.StructField("process_name", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("record_count", T.LongType()),
])
