"""Streams over several arriving files equal their batch twins."""

import json

from pyspark.sql import functions as F

from threadloom.operators import words
from threadloom.streaming import feeds

SHAPE = "reddit_id string, score int"


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def run(spark, tmp_path, landing):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    arriving = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).json(str(landing))
    load = feeds.store_new_rows(out, [F.asc("score")])
    feeds.ingest_stream(arriving, load, checkpoint).awaitTermination()
    return spark.read.schema(SHAPE).parquet(out)


def test_incremental_ingest_over_batches_and_restarts(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", [{"reddit_id": "a", "score": 2}, {"reddit_id": "a", "score": 1}])
    land(landing, "2.json", [{"reddit_id": "a", "score": 0}, {"reddit_id": "b", "score": 5}])
    rows = run(spark, tmp_path, landing)
    assert len({tuple(r) for r in rows.collect()}) == rows.count() == 2
    land(landing, "3.json", [{"reddit_id": "b", "score": 1}, {"reddit_id": "c", "score": 1}])
    again = run(spark, tmp_path, landing)
    assert sorted(r["reddit_id"] for r in again.collect()) == ["a", "b", "c"]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("a", 2)], SHAPE)
    load = feeds.store_new_rows(out, [F.asc("score")])
    load(df, 0)
    load(df, 1)
    load(df, 1)
    load(df, 0)
    stored = spark.read.schema(SHAPE).parquet(out).select("reddit_id", "score")
    assert [tuple(r) for r in stored.collect()] == [("a", 1)]


def test_word_counts_over_batches(spark, tmp_path):
    items = [{"type": "comment", "body": "a b"}, {"type": "submission", "selftext": "b", "title": "(c)"}, {"type": "comment", "body": "a"}]
    landing = tmp_path / "landing"
    for i, item in enumerate(items):
        land(landing, f"{i}.json", [{"item": item}])
    arriving = spark.readStream.schema("item variant").option("maxFilesPerTrigger", 1).json(str(landing))
    feeds.store_word_counts(arriving, str(tmp_path / "shares"), str(tmp_path / "checkpoint")).awaitTermination()
    shares = spark.read.schema("word string, frequency bigint, batch int").parquet(str(tmp_path / "shares"))
    assert shares.select("batch").distinct().count() > 1
    streamed = {r["word"]: r["frequency"] for r in feeds.total_counts(shares).collect()}
    batch = words.mixed_words(spark.read.schema("item variant").json(str(landing)))
    assert streamed == {r["word"]: r["frequency"] for r in batch.collect()} == {"a": 2, "b": 2, "c": 1}


def test_stored_tables_feed_as_a_file_or_a_folder(spark, tmp_path):
    folder = tmp_path / "folder"
    spark.range(10).repartition(3).write.parquet(str(folder / "items.parquet"))
    part = next((folder / "items.parquet").glob("part-*"))
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "items.parquet").write_bytes(part.read_bytes())
    expected = {"folder": spark.range(10), "file": spark.read.parquet(str(part))}
    for kind, rows in expected.items():
        out = str(tmp_path / f"out-{kind}")
        feed = feeds.table_feed(spark, str(tmp_path / kind), "items", "id bigint")
        feeds.append_to(feed, out, str(tmp_path / f"checkpoint-{kind}")).awaitTermination()
        assert sorted(r[0] for r in spark.read.schema("id bigint").parquet(out).collect()) == sorted(r[0] for r in rows.collect())


def test_small_files_share_a_batch(spark, tmp_path):
    rows = spark.range(40)
    rows.repartition(12).write.parquet(str(tmp_path / "landing"))
    feed = feeds.parquet_feed(spark, str(tmp_path / "landing"), "*.parquet", rows.schema, bytes_per_trigger=1 << 20)
    feeds.show(feed, str(tmp_path / "checkpoint"), str(tmp_path / "counts"), rows=0).awaitTermination()
    counts = spark.read.schema("shown bigint, batch int").parquet(str(tmp_path / "counts"))
    assert counts.agg(F.sum("shown"), F.count("*")).first() == (40, 1)


def test_new_rows_take_their_stored_form_after_the_dedupe(spark, tmp_path):
    land(tmp_path / "landing", "1.json", [{"reddit_id": "a", "score": 2}, {"reddit_id": "a", "score": 1}, {"reddit_id": "b", "score": 5}])
    feed = feeds.json_feed(spark, str(tmp_path / "landing"), "reddit_id string, score int")
    out = str(tmp_path / "out")
    load = feeds.store_new_rows(out, [F.asc("score")], lambda rows: rows.select("reddit_id", (F.col("score") * 10).alias("tens")))
    feeds.ingest_stream(feed, load, str(tmp_path / "checkpoint")).awaitTermination()
    rows = spark.read.schema("reddit_id string, tens int").parquet(out).select("reddit_id", "tens")
    assert sorted(map(tuple, rows.collect())) == [("a", 10), ("b", 50)]


def test_selection(spark):
    df = spark.createDataFrame([("submission", "s", "u/a", 1), ("comment", "s", "u/b", 5)], "type string, subreddit string, author string, created_utc int")
    assert feeds.only(df, "comment").count() == 1
    assert feeds.by_entity(df, subreddit="s").count() == 2
    assert feeds.by_entity(df, redditor="u/b").count() == 1
    assert feeds.skip_existing(df, F.lit(2)).count() == 1


def test_session_stats(spark):
    df = spark.createDataFrame([("r/x", "2024-01-01 00:00:00"), ("r/x", "2024-01-01 01:02:03")], "source string, t string")
    row = feeds.session_stats(df.withColumn("seen_at", F.col("t").cast("timestamp")), ["source"]).first()
    assert (row["items"], row["stream_duration"]) == (2, "01:02:03")


POST = "reddit_id string, id string, subreddit_id int, arrived timestamp"
COMMENT = "reddit_id string, id string, link_id string, arrived timestamp"


def load_parents(spark, tmp_path):
    feed = lambda name, schema: feeds.json_feed(spark, str(tmp_path / name), schema, files_per_trigger=1)
    query = feeds.ingest_with_parents(
        feed("posts", POST), feed("comments", COMMENT), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        F.lit("2024-01-05").cast("timestamp"), [F.asc("id")], wait="1 day",
    )
    query.awaitTermination()
    read = lambda name, schema: sorted(tuple(r)[:-1] for r in spark.read.schema(schema).parquet(str(tmp_path / "out" / name)).collect())
    placed = read("comments", "reddit_id string, submission_row string, subreddit_id int")
    queue = read("queue/comments", "reddit_id string") + read("queue/submissions", "reddit_id string")
    return placed, [r[0] for r in read("rejected", "reddit_id string")], sorted(r[0] for r in queue)


def test_comments_wait_for_their_posts(spark, tmp_path):
    day = lambda d, h=0: f"2024-01-{d:02d} {h:02d}:00:00"
    post = lambda i, at: {"reddit_id": i, "id": f"s{i}", "subreddit_id": 7, "arrived": at}
    comment = lambda i, up, at: {"reddit_id": i, "id": f"c{i}", "link_id": f"t3_{up}", "arrived": at}
    land(tmp_path / "posts", "1.json", [post("p", day(1)), post("p", day(1))])
    land(tmp_path / "comments", "1.json", [comment("a", "p", day(1)), comment("b", "q", day(1, 1)), comment("x", "none", day(1, 1)), comment("a", "p", day(1))])
    assert load_parents(spark, tmp_path) == ([("a", "sp", 7)], [], ["a", "p"])
    # A restart; the post of b comes two batches after its comment.
    land(tmp_path / "comments", "2.json", [comment("a", "p", day(1, 2)), comment("c", "p", day(1, 2))])
    assert load_parents(spark, tmp_path)[0] == [("a", "sp", 7), ("c", "sp", 7)]
    land(tmp_path / "posts", "2.json", [post("q", day(1, 3)), post("p", day(1, 3))])
    assert load_parents(spark, tmp_path) == ([("a", "sp", 7), ("b", "sq", 7), ("c", "sp", 7)], [], ["a", "b", "c", "p", "q"])
    # Days later the wait of x is over; d belongs to a post that is no longer in the join's state, only stored.
    for k, d in enumerate((4, 7)):
        land(tmp_path / "posts", f"{3 + k}.json", [post(f"late{d}", day(d))])
        land(tmp_path / "comments", f"{3 + k}.json", [comment(f"d{d}", "p", day(d))])
    land(tmp_path / "posts", "5.json", [post("end", day(12))])
    land(tmp_path / "comments", "5.json", [comment("e", "end", day(12))])
    placed, rejected, queue = load_parents(spark, tmp_path)
    assert rejected == ["x"]
    assert {"a", "b", "c", "d4", "e"} <= {p[0] for p in placed} and len(placed) == len({p[0] for p in placed})
    assert dict((p[0], p[1]) for p in placed)["d4"] == "sp" and queue.count("p") == 1


def test_waiting_comments_lie_in_one_store_a_task(spark, tmp_path):
    land(tmp_path / "posts", "1.json", [{"reddit_id": "p", "id": "sp", "subreddit_id": 7, "arrived": "2024-01-01 00:00:00"}])
    land(tmp_path / "comments", "1.json", [{"reddit_id": "a", "id": "ca", "link_id": "t3_p", "arrived": "2024-01-01 00:00:00"}])
    feed = lambda name, schema: feeds.json_feed(spark, str(tmp_path / name), schema)
    before = spark.conf.get(feeds.JOIN_FORMAT)
    query = feeds.ingest_with_parents(
        feed("posts", POST), feed("comments", COMMENT), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        F.lit("2024-01-05").cast("timestamp"), [F.asc("id")],
    )
    query.awaitTermination()
    stores = [s["numStateStoreInstances"] for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"] == "symmetricHashJoin"]
    assert stores and set(stores) == {int(spark.conf.get("spark.sql.shuffle.partitions"))}
    assert spark.conf.get(feeds.JOIN_FORMAT) == before


def test_session_windows_close_by_event_time(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    at = lambda h, m=0: f"2024-01-01 {h:02d}:{m:02d}:00"
    item = lambda who, t: {"who": who, "t": t}
    late = feeds.LateRows()
    spark.streams.addListener(late)

    def closed():
        arriving = feeds.json_feed(spark, str(landing), "who string, t timestamp", files_per_trigger=1)
        windows = feeds.session_windows(arriving, ["who"], "t", "30 minutes", "10 minutes")
        feeds.store_session_windows(windows, out, checkpoint).awaitTermination()
        rows = spark.read.schema(windows.schema).parquet(out).collect()
        return sorted((r["who"], r["stream_start"].hour, r["items"], r["stream_duration"]) for r in rows)

    try:
        # Items a whole gap apart still belong together; b's burst goes on in the next batch.
        land(landing, "1.json", [item("a", at(1)), item("a", at(1, 30)), item("b", at(2)), item("a", at(2, 20))])
        assert closed() == [("a", 1, 2, "00:30:00")]
        land(landing, "2.json", [item("b", at(2, 15)), item("a", at(3, 30))])
        assert closed() == [("a", 1, 2, "00:30:00"), ("a", 2, 1, "00:00:00"), ("b", 2, 2, "00:15:00")]
        # Too late for its window, which has come out already.
        land(landing, "3.json", [item("b", at(2, 20)), item("c", at(9))])
        assert closed() == [("a", 1, 2, "00:30:00"), ("a", 2, 1, "00:00:00"), ("a", 3, 1, "00:00:00"), ("b", 2, 2, "00:15:00")]
    finally:
        spark.streams.removeListener(late)
    assert late.dropped == 1
