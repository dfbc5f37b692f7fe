"""Loads, logs and read rules that the stored tables do not show."""

from datetime import datetime

from pyspark.sql import functions as F

from threadloom.operators import ingest, quality, reads, stats

NOW = datetime(2024, 1, 2)
POST = "reddit_id string, id string, subreddit_id int, created_utc string"
REPLY = "reddit_id string, id string, link_id string, created_utc string"


def batch(spark):
    posts = spark.createDataFrame([("p1", "1", 7, "b"), ("p1", "1x", 8, "c"), ("p2", "2", 7, "a")], POST)
    replies = spark.createDataFrame(
        [("c1", "1", "t3_p1", "a"), ("c1", "1x", "t3_p2", "b"), ("c2", "2", "t3_p2", "a"), ("c3", "3", "t3_gone", "a")], REPLY
    )
    return posts, replies


def test_ingest_twice_is_ingest_once(spark):
    posts, replies = batch(spark)
    nothing = spark.createDataFrame([], POST), spark.createDataFrame([], REPLY)
    one = ingest.ingest_batch(posts, replies, *nothing, F.lit(NOW))
    assert sorted((r["reddit_id"], r["id"]) for r in one["submissions"].collect()) == [("p1", "1"), ("p2", "2")]
    assert sorted((r["reddit_id"], r["submission_row"], r["subreddit_id"]) for r in one["comments"].collect()) == [
        ("c1", "1", 7), ("c2", "2", 7),
    ]
    assert [r["reddit_id"] for r in one["rejected"].collect()] == ["c3"]
    assert sorted((r["reddit_id"], r["priority"]) for r in one["queue"].collect()) == [("c1", 0), ("c2", 0), ("p1", 1), ("p2", 1)]
    assert tuple(one["totals"].first()) == (3, 2, 2)
    two = ingest.ingest_batch(posts, replies, one["submissions"], one["comments"].select("reddit_id"), F.lit(NOW))
    assert [two[k].count() for k in ("submissions", "comments", "queue")] == [0, 0, 0]


def test_claims(spark):
    queue = spark.createDataFrame([("a", "pending"), ("b", "completed")], "id string, processing_status string")
    log = spark.createDataFrame(
        [("a", 1, "note", "x"), ("a", 2, "claim", "x"), ("a", 3, "claim", "y"), ("b", 4, "claim", "x"), ("gone", 5, "claim", "x")],
        "item_id string, seq bigint, action string, processor string",
    ).withColumn("at", F.lit("t"))
    outcome = {r["seq"]: r["claimed"] for r in ingest.claim_if_pending(queue, log).collect()}
    assert outcome == {2: True, 3: False, 4: False, 5: False}
    owners = {r["item_id"]: r["processor_name"] for r in ingest.claim_unconditional(queue, log).collect()}
    assert owners == {"a": "y", "b": "x"}


def test_session_state_measures_duration(spark):
    log = spark.createDataFrame(
        [("s", 1, datetime(2024, 1, 1), "pending", None), ("s", 2, datetime(2024, 1, 1, 0, 0, 1), "running", None),
         ("s", 3, datetime(2024, 1, 1, 0, 2, 1), "success", 25)],
        "session_id string, seq bigint, at timestamp, status string, submissions_found int",
    ).withColumn("comments_scraped", F.lit(150)).withColumn("error_message", F.lit(None).cast("string"))
    row = ingest.session_state(log).first()
    assert (row["status"], row["duration_seconds"], row["submissions_found"], row["comments_scraped"]) == ("success", 120, 25, 150)


def test_keyword_wildcards_and_backslash(spark):
    rows = [("1", "100% sure", 3), ("2", "100 sure", 2), ("3", "a\\b", 1), ("4", "ab", 0), ("5", None, 9)]
    posts = spark.createDataFrame(rows, "reddit_id string, title string, score int").withColumn("selftext", F.lit(""))
    nobody = spark.createDataFrame([], "id int, name string")

    def found(words, **more):
        return [r["reddit_id"] for r in reads.keyword_search(posts, nobody, words, **more).collect()]

    assert found(["100% SURE"]) == ["1", "2"]
    assert found(["100% sure"], literal=True) == ["1"]
    assert found(["a\\b"]) == ["4"]
    assert found(["a\\b"], literal=True) == ["3"]
    assert found([]) == ["5", "1", "2", "3", "4"]


def test_missing_and_deleted_authors(spark):
    rows = [("p", None), ("p", None), ("p", "[deleted]"), ("p", "u/a")]
    replies = spark.createDataFrame(rows, "submission_id string, author string")
    assert [(r["author"], r["comment_count"]) for r in stats.top_comment_authors(replies).collect()] == [("u/a", 1)]
    shown = {r["author"]: r["comments"] for r in stats.top_commenters_per_post(replies).collect()}
    assert shown == {None: 2, "u/a": 1}


def test_post_without_comments_has_zeros(spark):
    posts = spark.createDataFrame([("p",)], "reddit_id string")
    none = spark.createDataFrame([], "submission_id string, score int")
    assert tuple(stats.post_comment_stats(posts, none).first()) == ("p", 0, 0, 0, 0, 0, 0, 0.0)


def test_existing_id_gives_no_fallback(spark):
    posts = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "reddit_id string, first_seen_at int")
    assert [r["reddit_id"] for r in reads.post_or_recent(posts, "a").collect()] == ["a"]
    assert sorted(r["reddit_id"] for r in reads.post_or_recent(posts, "zz", 2).collect()) == ["b", "c"]


def test_request_rules(spark):
    rows = [(1, "T", "25", "day"), (2, "h", "10", "day"), (3, "x", "10", None), (4, "t", "0", None), (5, "s", "any words", None), (6, "c", "5", "decade")]
    requests = spark.createDataFrame(rows, "request_id int, category string, n_results string, time_filter string")
    broken = sorted(map(tuple, quality.subreddit_request_violations(requests).collect()))
    assert broken == [(2, "time filter not available"), (3, "invalid category"), (4, "invalid result count"), (6, "invalid time filter")]
    zero = spark.createDataFrame([(1, "0"), (2, "1e"), (3, "5")], "request_id int, n_results string")
    assert sorted(r["request_id"] for r in quality.redditor_request_violations(zero).collect()) == [1, 2]
    assert sorted(r["request_id"] for r in quality.comment_request_violations(zero).collect()) == [2]


def test_retention_rewrites_touched_folders_only(spark, tmp_path):
    from threadloom.sinks import writers

    path = str(tmp_path / "queue")
    rows = [(k, f"2024-01-0{k % 4 + 1}") for k in range(40)]
    spark.createDataFrame(rows, "id bigint, day string").write.partitionBy("day").parquet(path)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "queue").rglob("*.parquet")}

    gone = spark.createDataFrame([(0,), (4,), (999,), *[(k,) for k in range(3, 40, 4)]], "id bigint")
    before = files()
    assert writers.remove_rows(gone, path, "id", "day") == 2
    after = files()
    untouched = {f for f in before if "day=2024-01-02" in f or "day=2024-01-03" in f}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not any("day=2024-01-04" in f for f in after)
    left = sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert left == [k for k in range(40) if k % 4 != 3 and k not in (0, 4)]
    assert writers.remove_rows(gone, path, "id", "day") == 0
    assert files() == after


def test_config_sets_do_not_depend_on_order(spark):
    from threadloom.operators import quality

    shape = "run int, name string, category string, time_filter string, n_results int, keywords string"
    one = [(1, "b", "h", None, 5, None), (1, "a", "t", "day", 5, None), (1, "a", "t", "day", 5, None)]
    many = [(2, f"a_rather_long_name_{k}", "h", None, 1, None) for k in range(4)]
    found = {r["run"]: r for r in quality.config_sets(spark.createDataFrame(one + many, shape), ["run"]).collect()}
    again = {r["run"]: r for r in quality.config_sets(spark.createDataFrame(many[::-1] + one[::-1], shape), ["run"]).collect()}
    assert found == again
    assert (found[1]["subjects"], found[1]["configs"]) == ("a_b", 3)
    assert len(found[2]["subjects"]) == len("multi_") + 8
    changed = quality.config_sets(spark.createDataFrame([*one[:2], (1, "a", "t", "week", 5, None)], shape), ["run"]).first()
    assert changed["signature"] != found[1]["signature"]


def test_scratch_goes_when_asked(spark, tmp_path):
    from pathlib import Path

    from threadloom import session

    stored = session.materialize(spark.range(5), "going")
    folder = Path(stored.scratch.removeprefix("file:"))
    assert stored.count() == 5 and folder.exists()
    session.discard(stored)
    assert not folder.exists()


def test_a_repeated_load_moves_new_rows_only(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], "reddit_id string, v int")
    stored = spark.createDataFrame([("a",), ("c",)], "reddit_id string")
    assert sorted(r["v"] for r in ingest.unstored(batch, stored).collect()) == [2, 3, 4]
    again = ingest.unstored(batch.where("reddit_id IN ('a', 'c')"), stored)
    assert again.isEmpty()
    # Rows are only exchanged where new ones may be many: they meet the few new keys where they lie.
    assert "SortMergeJoin" not in again._jdf.queryExecution().executedPlan().toString()


def test_loads_exchange_what_arrived_not_what_is_stored(spark):
    from threadloom.plans.bindings import FIRST_COPY, Tables
    from threadloom.plans.loading import arrivals, comment_rows, raw_batch
    from threadloom.operators.ranking import keep_first

    t = Tables(spark, "/root/testdata/sf0.001")
    order = [F.asc(c) for c in FIRST_COPY]
    rows = comment_rows(keep_first(arrivals(t.stored("lineitem")), ["reddit_id"], order))
    whole = keep_first(raw_batch(t), ["reddit_id"], order)
    assert rows.schema == whole.schema and rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS body") < plan.index("Window")
