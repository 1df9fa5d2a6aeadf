import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.functions.instants import parse_instant
from newsloom.operators.flatten import explode_all, flatten_documents
from newsloom.sources import feeds

AUTHOR = {"name": "A", "socials": {"youtube": "y", "bluesky": "b"}}


def document(number, **fields):
    return {
        "id": number, "title": f"title {number}", "authors": [], "url": "https://a.org/1",
        "image_url": None, "news_site": "Site", "summary": "text", "featured": False, "launches": [],
        "published_at": "2025-03-10T12:00:00Z", "updated_at": "2025-03-10T12:00:00.123456Z", "events": [],
        **fields,
    }


def land(folder, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    taken = len(list(folder.iterdir()))
    for number, page in enumerate(pages):
        text = json.dumps({"next": None, "results": page})
        (folder / f"page{taken + number}.json").write_text(text + "\n")
    return str(folder)


def test_pages_are_unnested(spark, tmp_path):
    folder = land(tmp_path / "in", [document(1), document("r-2")], [], [document(3)])
    assert rows(feeds.read_pages(spark, folder).select("id", "title")) == [
        ("1", "title 1"), ("3", "title 3"), ("r-2", "title r-2"),
    ]


def test_a_page_that_is_not_json_fails(spark, tmp_path):
    folder = land(tmp_path / "in", [document(1)])
    (tmp_path / "in" / "bad.json").write_text("{ not json\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        feeds.read_pages(spark, folder).collect()


def test_conform_fills_missing_fields(spark):
    reports = spark.createDataFrame([(7, "t")], "id int, title string")
    conformed = feeds.conform(reports)
    assert conformed.schema["id"].dataType.simpleString() == "string"
    assert conformed.first()["launches"] is None and conformed.first()["id"] == "7"


@pytest.mark.parametrize("text, micros", [
    ("2025-03-10T12:00:00Z", 0), ("2025-03-10T12:00:00.5Z", 500_000),
    ("2025-03-10T12:00:00.123456Z", 123_456), ("2025-03-10T12:00:00+00:00", 0), ("2025-03-10T14:00:00.1234567+02:00", 123_456),
    ("2025-03-10T12:00:00.123456789Z", 123_456), ("2025-03-10T12:00:00", None), ("2025-02-30T12:00:00+00:00", None), ("10/03/2025", None), (None, None),
])
def test_instants(spark, text, micros):
    start = 1741608000 * 1_000_000
    found = spark.createDataFrame([(text,)], "t string").select(F.unix_micros(parse_instant("t"))).first()[0]
    assert found == (None if micros is None else start + micros)


def test_rejects(spark, tmp_path):
    folder = land(tmp_path / "in", [
        document(1), document(None), document(2, updated_at="soon"), document(3, published_at="x"),
        document(4, updated_at=None),
    ])
    accepted, rejected = feeds.split_rejects(feeds.typed(feeds.read_pages(spark, folder), "articles"))
    assert rows(accepted.select("source", "id", "is_active")) == [
        ("articles", "1", True), ("articles", "4", True),
    ]
    assert rows(rejected.select("id", feeds.REASON)) == [
        ("2", "malformed updated_at"), ("3", "malformed published_at"), (None, "null key"),
    ]


def test_high_water_mark_and_strictly_newer(spark):
    stored = spark.createDataFrame([(1, "2025-01-01 00:00:00"), (2, "2025-01-02 00:00:00")], "id int, t string")
    stored = stored.select("id", F.col("t").cast("timestamp").alias("updated_at"))
    mark = feeds.high_water_mark(stored).first()[0]
    assert feeds.newer_than(stored, mark).count() == 0
    assert rows(feeds.newer_than(stored, "2025-01-01 00:00:00").select("id")) == [(2,)]
    empty = feeds.high_water_mark(stored.limit(0)).select(F.unix_micros("high_water_mark")).first()[0]
    assert empty == -631152000 * 1_000_000


def test_flatten_multiplies_the_arrays(spark, tmp_path):
    launches = [{"launch_id": f"l{i}", "provider": "p"} for i in range(3)]
    folder = land(tmp_path / "in", [
        document(1, authors=[AUTHOR, {"name": "B", "socials": None}], launches=launches, events=None),
        document(2),
    ])
    flat = flatten_documents(feeds.read_pages(spark, folder))
    counts = dict(rows(flat.groupBy("id").count()))
    assert counts == {"1": 6, "2": 1}
    assert rows(flat.filter("id = 1").select("authors_name", "authors_socials_youtube").distinct()) == [
        ("A", "y"), ("B", None),
    ]
    assert rows(flat.filter("id = 2").select("authors_name", "launches_launch_id", "events_event_id")) == [
        (None, None, None),
    ]


def test_flatten_authors_only(spark, tmp_path):
    folder = land(tmp_path / "in", [document(1, authors=[AUTHOR, AUTHOR])])
    reports = feeds.read_pages(spark, folder).drop("launches", "events", "featured")
    flat = flatten_documents(reports)
    assert flat.count() == 2 and "launches_launch_id" not in flat.columns


def test_explode_all_keeps_rows_of_empty_arrays(spark):
    frame = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert rows(explode_all(frame, ["a"])) == [(1, 1), (1, 2), (2, None), (3, None)]
