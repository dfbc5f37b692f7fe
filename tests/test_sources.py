"""Scrape files as the collector writes them: one document per file."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import normalize, words
from threadloom.schemas import SUBREDDIT_FILE
from threadloom.sinks import writers
from threadloom.sources import documents, files


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2), encoding="utf-8")


def submission(i, **more):
    return {"id": f"s{i}", "title": f"T{i}", "selftext": "This is a test", "score": i, "edited": False, **more}


def test_submission_files_of_every_shape(spark, tmp_path):
    put(tmp_path, "wrapped.json", {"scrape_settings": {"subreddit": "x"}, "data": [submission(1), "text", 7, submission(2, nsfw=True)]})
    put(tmp_path, "bare.json", [submission(3), submission(4)])
    put(tmp_path, "broken.json", '{"data": [')
    put(tmp_path, "empty.json", {"scrape_settings": {"subreddit": "x"}, "data": []})
    rows = documents.submission_scrapes(spark, str(tmp_path)).collect()
    assert sorted((r["id"], r["subreddit"], r["score"]) for r in rows) == [
        ("s1", "x", 1), ("s2", "x", 2), ("s3", None, 3), ("s4", None, 4),
    ]
    rejects = documents.corrupt_documents(spark, str(tmp_path), SUBREDDIT_FILE).collect()
    assert [r["file"].endswith("broken.json") for r in rejects] == [True]


def test_load_rows_take_defaults(spark, tmp_path):
    put(tmp_path, "a.json", {"scrape_settings": {"subreddit": "x"}, "data": [
        {"id": "a", "title": "t", "url": "u", "permalink": "p", "created_utc": "2020-06-16 07:05:24"},
    ]})
    row = normalize.submission_row(documents.submission_scrapes(spark, str(tmp_path))).first()
    assert (row["author"], row["selftext"], row["score"], row["is_nsfw"], row["upvote_ratio"]) == ("[deleted]", "", 0, False, None)
    assert str(row["created_utc"]) == "2020-06-16 07:05:24"


def comment(i, edited=False, **more):
    return {"id": f"c{i}", "body": "This is a test", "author": None, "created_utc": "2020-06-16 07:05:24", "edited": edited,
            "parent_id": "t3_p", "link_id": "t3_p", "score": 1, "is_submitter": False, "stickied": False, **more}


def test_comment_files_and_edits(spark, tmp_path):
    put(tmp_path, "c.json", {"scrape_settings": {"style": "raw", "url": "https://x/comments/p/"}, "data": {
        "comments": [comment(1), comment(2, "2021-01-02 03:04:05")]}})
    scraped = documents.comment_scrapes(spark, str(tmp_path))
    rows = {r["reddit_id"]: r for r in normalize.comment_row(scraped).collect()}
    assert (rows["c1"]["edited_flag"], rows["c1"]["edited_at"], rows["c1"]["author"]) == (False, None, "[deleted]")
    assert rows["c2"]["edited_flag"] is True and str(rows["c2"]["edited_at"]) == "2021-01-02 03:04:05"
    counts = {r["word"]: r["frequency"] for r in words.comment_words(scraped).collect()}
    assert counts == {"This": 2, "is": 2, "a": 2, "test": 2}


def test_redditor_file_skips_forbidden(spark, tmp_path):
    put(tmp_path, "r.json", {"scrape_settings": {"redditor": "r", "n_results": "2"}, "data": {"information": {"name": "r"}, "interactions": {
        "comments": [{"type": "comment", "body": "This body"}],
        "submissions": [{"type": "submission", "selftext": "This selftext", "title": "This title"}],
        "saved": ["FORBIDDEN"], "hot": [],
    }}})
    items = documents.redditor_scrapes(spark, str(tmp_path))
    assert sorted(r["category"] for r in items.collect()) == ["comments", "submissions"]
    counts = {r["word"]: r["frequency"] for r in words.mixed_words(items).collect()}
    assert counts == {"This": 3, "body": 1, "selftext": 1, "title": 1}
    labelled = normalize.label_interactions(documents.redditor_documents(spark, str(tmp_path)), ["redditor"]).collect()
    assert sorted((r["category"], r["forbidden"]) for r in labelled) == [("comments", False), ("saved", True), ("submissions", False)]


def test_livestream_file(spark, tmp_path):
    put(tmp_path, "l.json", {"livestream_settings": {"included_reddit_objects": "comments", "redditor": "r"}, "livestream_metadata": {},
                             "data": [{"type": "comment", "body": "a b"}]})
    row = documents.livestream_scrapes(spark, str(tmp_path)).first()
    assert (row["object_kind"], row["source"]) == ("comments", "r")


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/data/scrapes/05-06-2024/livestream/by_community/a.json", ("05-06-2024", "livestream")),
        ("/data/scrapes/05-06-2024/livestream/a.txt", None),
        ("/data/scrapes/05-06-2024/analytics/wordcloud/b.json", None),
        ("elsewhere/f.json", None),
    ],
)
def test_route_by_path(spark, path, expected):
    rows = files.route_by_path(spark.createDataFrame([(path,)], "path string")).collect()
    assert [(r["scrape_date"], r["scrape_type"]) for r in rows] == ([expected] if expected else [])


def test_analytics_dir_mirrors_the_layout(spark):
    given = F.lit("../scrapes/d/livestream/subreddits/f.json")
    row = spark.range(1).select(files.analytics_dir(given, "frequencies").alias("d")).first()
    assert row["d"] == "../scrapes/d/analytics/frequencies/livestream/subreddits"


def test_frequency_files(spark, tmp_path):
    df = spark.createDataFrame([("test", 1), ('say "x",\ny', 2)], "word string, frequency bigint")
    writers.write_frequencies_csv(df, str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("*.csv")))
    assert text.startswith('"words","frequencies"\n') and '"say ""x"",' in text
    pages = spark.createDataFrame([("f.json", 0, [("test", 1), ("testing", 2)])], "file string, page bigint, entries array<struct<word: string, frequency: bigint>>")
    writers.write_json(writers.frequency_documents(pages), str(tmp_path / "json"))
    doc = json.loads("".join(p.read_text() for p in (tmp_path / "json").glob("*.json")))
    assert doc["raw_file"] == "f.json" and doc["data"] == {"test": 1, "testing": 2}


def test_compressed_documents_are_read_back(spark, tmp_path):
    rows = spark.range(500).select("id", F.lit("the same text " * 20).alias("text"))
    writers.write_json(rows, str(tmp_path / "plain"))
    writers.write_json(rows, str(tmp_path / "packed"), compression="gzip")
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).glob("part-*"))
    assert size("packed") * 10 < size("plain")
    assert spark.read.schema("id bigint, text string").json(str(tmp_path / "packed")).exceptAll(rows).isEmpty()


def test_files_over_size(spark, tmp_path):
    put(tmp_path, "small.json", "{}")
    put(tmp_path, "deep/large.json", "x" * 101)
    put(tmp_path, "large.txt", "x" * 200)
    rows = files.files_over_size(spark, str(tmp_path)).collect()
    assert [r["path"].endswith("large.json") for r in rows] == [True]


def test_record_shapes(spark):
    raw = spark.createDataFrame(
        [(None, "b", "h", 1592291124.0, None, "false", "i", True, "t3_l", "t3_l", 1, False),
         ("n", "b", "h", 1592291124.0, None, "1592291125.0", "j", True, "t3_l", "t3_l", 1, False)],
        """author_name string, body string, body_html string, created_utc double, distinguished string, e string, id string,
        is_submitter boolean, link_id string, parent_id string, score int, stickied boolean""",
    ).withColumn("edited", F.parse_json("e"))
    rows = normalize.comment_record(raw).orderBy("id").collect()
    assert [(r["author"], r["created_utc"], r["edited"]) for r in rows] == [
        ("[deleted]", "2020-06-16 07:05:24", "false"), ("u/n", "2020-06-16 07:05:24", "2020-06-16 07:05:25"),
    ]
    assert len(rows[0]) == 12


def test_nested_comments_of_thirty_levels(spark, tmp_path):
    node = None
    for k in reversed(range(30)):
        node = {"id": f"c{k}", "parent_id": f"t1_c{k - 1}" if k else "t3_p", "link_id": "t3_p", "body": f"b{k}", "replies": [node] if node else []}
    document = {"scrape_settings": {"style": "structured", "url": "u"}, "data": {"comments": [node, {"id": "x", "parent_id": "t3_p", "link_id": "t3_p", "replies": []}]}}
    (tmp_path / "nested.json").write_text(json.dumps(document, indent=2))
    rows = documents.nested_comment_scrapes(spark, str(tmp_path)).select("id", "depth", "parent_id").collect()
    expected = [(f"c{k}", k, f"t1_c{k - 1}" if k else "t3_p") for k in range(30)] + [("x", 0, "t3_p")]
    assert sorted(map(tuple, rows)) == sorted(expected)
