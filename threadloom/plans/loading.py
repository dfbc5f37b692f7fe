"""Registered queries: loads, state logs, checks and run reports."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import config_text, iso_time, short_hash
from ..operators import enrich, ingest, inventory, quality
from ..session import scratch_path
from ..sinks import writers
from ..sources.tables import append_bucketed
from .bindings import COMMENTS, FIRST_COPY, Tables, newest
from .reading import LAST_EVENT, _last_event, iso
from .registry import query



def raw_batch(t: Tables) -> DataFrame:
    """The comment feed with its copies and the columns that order them."""
    return t.stored("lineitem").selectExpr(*COMMENTS, *FIRST_COPY)


# What a load tells comments apart and places them by.
KEYS = [e for e in COMMENTS if e.endswith((" AS id", " AS reddit_id", " AS link_id"))]


def arrivals(lines: DataFrame) -> DataFrame:
    """Rows of the comment feed as they arrive, with their keys: half as wide as the rows they become."""
    return lines.selectExpr("*", *KEYS)


def comment_rows(arrived: DataFrame) -> DataFrame:
    """The rows that are stored, as in ``raw_batch``: made once copies and known ones are gone."""
    return arrived.selectExpr(*COMMENTS, *FIRST_COPY)


@query("dedupe_new_submissions", """SELECT reddit_id, title, score FROM submissions
    WHERE reddit_id NOT IN (SELECT CAST(o_orderkey AS STRING) FROM orders WHERE o_orderstatus = 'F')""")
def dedupe_new_submissions(t: Tables) -> DataFrame:
    # Every post comes twice; the second copy has a higher score.
    again = t.posts.withColumn("score", F.col("score") + 1)
    stored = t.stored("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("reddit_id"))
    rows = ingest.new_rows(t.posts.unionByName(again), stored, [F.asc("score")])
    return rows.select("reddit_id", "title", "score")


NEW_COMMENTS = """SELECT reddit_id, author, score FROM comments
    WHERE reddit_id NOT IN (SELECT reddit_id FROM raw_comments WHERE is_submitter)"""


@query("dedupe_new_comments", NEW_COMMENTS)
def dedupe_new_comments(t: Tables) -> DataFrame:
    stored = t.raw_comments.where("is_submitter").select("reddit_id")
    rows = ingest.new_rows(raw_batch(t), stored, [F.asc(c) for c in FIRST_COPY])
    return rows.select("reddit_id", "author", "score")


@query("dedupe_stored_buckets", NEW_COMMENTS)
def dedupe_stored_buckets(t: Tables) -> DataFrame:
    """The same load against ids that are kept in buckets, so the stored side is not exchanged."""
    path = scratch_path(t.spark, "known")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    ids = t.raw_comments.where("is_submitter").select("reddit_id")
    stored = append_bucketed(ids, f"known_{path[-32:]}", path, "reddit_id", buckets)
    rows = ingest.new_rows(raw_batch(t), stored, [F.asc(c) for c in FIRST_COPY])
    return rows.select("reddit_id", "author", "score")


@query("comment_to_submission", """SELECT c.reddit_id, s.id AS submission_row, s.subreddit_id
    FROM comments c JOIN submissions s ON split_part(c.link_id, '_', -1) = s.reddit_id""")
def comment_to_submission(t: Tables) -> DataFrame:
    rows = ingest.comment_to_submission(t.comments, t.submissions)
    return rows.select("reddit_id", "submission_row", "subreddit_id")


@query("comments_without_submission", """SELECT c.reddit_id FROM comments c
    WHERE c.submission_id NOT IN (SELECT reddit_id FROM submissions WHERE processing_status <> 'pending')""")
def comments_without_submission(t: Tables) -> DataFrame:
    stored = t.posts.where("processing_status <> 'pending'")
    return ingest.comments_without_submission(t.comments, stored).select("reddit_id")


ASKED = """(SELECT 'NATION_' || (c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 20 ELSE 0 END) AS name,
      CAST(NULL AS STRING) AS display_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS description,
      CAST(c_custkey % 1000 AS BIGINT) AS subscribers, c_custkey AS seq FROM customer)"""


def asked(t: Tables) -> DataFrame:
    return t.stored("customer").selectExpr(
        "'NATION_' || (c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 20 ELSE 0 END) AS name",
        "CAST(NULL AS STRING) AS display_name",
        "CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS description",
        "CAST(c_custkey % 1000 AS BIGINT) AS subscribers",
        "c_custkey AS seq",
    )


@query("get_or_create_subreddits", f"""
    WITH asked AS (SELECT * FROM {ASKED}), names AS (SELECT DISTINCT name FROM asked),
    described AS (SELECT name, description AS d FROM asked WHERE description IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1),
    counted AS (SELECT name, subscribers AS n FROM asked WHERE subscribers IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1),
    wanted AS (SELECT * FROM names LEFT JOIN described USING (name) LEFT JOIN counted USING (name))
    SELECT coalesce(CAST(r.id AS STRING), sha256(name)) AS id, name, coalesce(r.display_name, name) AS display_name,
      coalesce(d, r.description) AS description, coalesce(n, r.subscribers) AS subscribers, r.id IS NULL AS created
    FROM subreddits r FULL OUTER JOIN wanted w USING (name)""")
def get_or_create_subreddits(t: Tables) -> DataFrame:
    return ingest.get_or_create_subreddits(t.subreddits, asked(t))


@query("subreddit_metadata_upsert", f"""
    WITH wanted AS (SELECT name, max(description) AS d, CASE WHEN name < 'NATION_2' THEN max(subscribers) END AS n FROM {ASKED} GROUP BY 1)
    SELECT name, coalesce(d, description) AS description, coalesce(n, subscribers) AS subscribers,
      (d IS NOT NULL AND d IS DISTINCT FROM description) OR (n IS NOT NULL AND n IS DISTINCT FROM subscribers) AS stamped
    FROM subreddits LEFT JOIN wanted USING (name)""")
def subreddit_metadata_upsert(t: Tables) -> DataFrame:
    updates = asked(t).groupBy("name").agg(F.max("description").alias("description"), F.max("subscribers").alias("n"))
    updates = updates.select("name", "description", F.when(F.col("name") < "NATION_2", F.col("n")).alias("subscribers"))
    rows = ingest.upsert_subreddit_metadata(
        t.subreddits, updates, ["description", "subscribers"], _last_event(t).cast("timestamp")
    )
    return rows.select("name", "description", "subscribers", F.col("last_scraped_at").isNotNull().alias("stamped"))


@query("session_log_to_state", f"""WITH folded AS (SELECT session_id, arg_max(status, seq) AS status,
      max(x.at) FILTER (status = 'running') AS a, max(x.at) FILTER (status IN ('success', 'failed')) AS b,
      arg_max(submissions_found, seq) FILTER (submissions_found IS NOT NULL) AS submissions_found,
      arg_max(comments_scraped, seq) FILTER (comments_scraped IS NOT NULL) AS comments_scraped,
      arg_max(error_message, seq) FILTER (error_message IS NOT NULL) AS error_message, count(*) AS events
    FROM session_log x GROUP BY 1)
    SELECT session_id, status, {iso('a')} AS started_at, {iso('b')} AS completed_at, submissions_found,
      comments_scraped, error_message, events, CAST(trunc((epoch_us(b) - epoch_us(a)) / 1000000) AS INTEGER) AS duration_seconds
    FROM folded""")
def session_log_to_state(t: Tables) -> DataFrame:
    state = ingest.session_state(t.session_log)
    return state.withColumn("started_at", iso_time("started_at")).withColumn("completed_at", iso_time("completed_at"))


@query("enqueue_content", f"""
    SELECT sha256('submission:' || reddit_id) AS id, 'submission' AS content_type, id AS content_id, reddit_id, 1 AS priority,
      'pending' AS processing_status, {iso(LAST_EVENT)} AS queued_at FROM submissions
    UNION ALL SELECT sha256('comment:' || reddit_id), 'comment', id, reddit_id, 0, 'pending', {iso(LAST_EVENT)} FROM comments""")
def enqueue_content(t: Tables) -> DataFrame:
    now = _last_event(t)
    rows = ingest.enqueue(t.posts, "submission", now).unionByName(ingest.enqueue(t.comments, "comment", now))
    return rows.drop("processor_name").withColumn("queued_at", iso_time("queued_at"))


@query("claim_item_if_pending", """
    WITH first AS (SELECT item_id, min(seq) AS seq FROM queue_log WHERE action IN ('claim', 'complete') GROUP BY 1)
    SELECT l.item_id, l.seq, l.processor, f.seq IS NOT NULL AND q.id IS NOT NULL AS claimed
    FROM queue_log l LEFT JOIN first f ON f.item_id = l.item_id AND f.seq = l.seq
      LEFT JOIN queue q ON q.id = l.item_id AND q.processing_status = 'pending'
    WHERE l.action = 'claim'""")
def claim_item_if_pending(t: Tables) -> DataFrame:
    return ingest.claim_if_pending(t.queue, t.queue_log)


@query("claim_item_unconditional", f"""SELECT item_id, arg_max(processor, seq) AS processor_name,
      {iso('max(l.at)')} AS started_processing_at
    FROM queue_log l WHERE action = 'claim' AND item_id IN (SELECT id FROM queue) GROUP BY 1""")
def claim_item_unconditional(t: Tables) -> DataFrame:
    rows = ingest.claim_unconditional(t.queue, t.queue_log)
    return rows.withColumn("started_processing_at", iso_time("started_processing_at"))


@query("complete_item", f"""WITH done AS (SELECT item_id, max(x.at) AS b, arg_max(result, seq) FILTER (result IS NOT NULL) AS r
      FROM queue_log x WHERE action = 'complete' GROUP BY 1)
    SELECT item_id, 'completed' AS processing_status, {iso('b')} AS completed_at, coalesce(r, processing_result) AS processing_result
    FROM queue JOIN done ON id = item_id""")
def complete_item(t: Tables) -> DataFrame:
    rows = ingest.complete_items(t.queue, t.queue_log)
    return rows.withColumn("completed_at", iso_time("completed_at"))


@query("queue_with_content", """SELECT q.id, q.content_type, q.reddit_id, coalesce(s.author, c.author) AS author,
      coalesce(s.score, c.score) AS score
    FROM queue q LEFT JOIN submissions s ON q.content_type = 'submission' AND q.reddit_id = s.reddit_id
      LEFT JOIN comments c ON q.content_type = 'comment' AND q.reddit_id = c.reddit_id""")
def queue_with_content(t: Tables) -> DataFrame:
    rows = ingest.queue_with_content(t.queue, t.posts, t.comments)
    return rows.select("id", "content_type", "reddit_id", "author", "score")


@query("queue_health", f"""SELECT processing_status, processor_name, count(*) AS items,
      max(CAST(floor((epoch_us({LAST_EVENT}) - epoch_us(queued_at)) / 1000000) AS BIGINT)) AS oldest_seconds,
      count(*) FILTER (retry_count >= 3) AS exhausted FROM queue GROUP BY 1, 2""")
def queue_health(t: Tables) -> DataFrame:
    return ingest.queue_health(t.queue, _last_event(t))


@query("retention_cleanup", f"""
    SELECT 'processing_queue' AS table_name, id FROM queue WHERE processing_status = 'completed' AND completed_at < {LAST_EVENT} + INTERVAL 12 DAY - INTERVAL 30 DAY
    UNION ALL SELECT 'task_metrics', id FROM metrics WHERE recorded_at < {LAST_EVENT} + INTERVAL 12 DAY - INTERVAL 90 DAY
    UNION ALL SELECT 'scrape_sessions', id FROM sessions WHERE started_at < {LAST_EVENT} + INTERVAL 12 DAY - INTERVAL 365 DAY""")
def retention_cleanup(t: Tables) -> DataFrame:
    later = _last_event(t) + F.expr("INTERVAL 12 DAYS")
    return ingest.expired(t.queue, t.metrics, t.sessions, later)


@query("retention_rewrite", f"""SELECT id, processing_status, strftime(queued_at, '%Y-%m-%d') AS day FROM queue
    WHERE NOT coalesce(processing_status = 'completed' AND completed_at < {LAST_EVENT} + INTERVAL 12 DAY - INTERVAL 30 DAY, FALSE)""")
def retention_rewrite(t: Tables) -> DataFrame:
    """The stored queue, by day, without the items past their retention."""
    path = scratch_path(t.spark, "queue")
    t.queue.withColumn("day", F.date_format("queued_at", "yyyy-MM-dd")).hint("rebalance", "day").write.partitionBy("day").parquet(path)
    later = _last_event(t) + F.expr("INTERVAL 12 DAYS")
    gone = ingest.expired(t.queue, t.metrics, t.sessions, later).where("table_name = 'processing_queue'")
    writers.remove_rows(gone, path, "id", "day")
    return t.spark.read.parquet(path).select("id", "processing_status", F.col("day").cast("string").alias("day"))


@query("complete_item_rewrite", """WITH done AS (SELECT item_id, arg_max(result, seq) FILTER (result IS NOT NULL) AS r
      FROM queue_log x WHERE action = 'complete' GROUP BY 1)
    SELECT id, CASE WHEN item_id IS NULL THEN processing_status ELSE 'completed' END AS processing_status,
      coalesce(r, processing_result) AS processing_result, strftime(queued_at, '%Y-%m-%d') AS day
    FROM queue LEFT JOIN done ON id = item_id""")
def complete_item_rewrite(t: Tables) -> DataFrame:
    """The stored queue, by day, with the completed items in place of the stored ones."""
    path = scratch_path(t.spark, "queue")
    stored = t.queue.select("id", "processing_status", "processing_result", F.date_format("queued_at", "yyyy-MM-dd").alias("day"))
    stored.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    done = ingest.complete_items(t.queue, t.queue_log).withColumnRenamed("item_id", "id")
    done = done.select("id", "processing_status", "processing_result").join(stored.select("id", "day"), "id")
    writers.upsert_rows(done, path, "id", "day")
    return t.spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))


KNOWN_POST = "(SELECT reddit_id FROM submissions WHERE processing_status <> 'pending')"


@query("ingest_batch", f"""
    WITH arrived AS (SELECT * FROM comments WHERE NOT reddit_id IN (SELECT reddit_id FROM raw_comments WHERE is_submitter)),
    posted AS (SELECT * FROM submissions WHERE processing_status = 'processing'),
    found AS (SELECT a.*, s.id AS submission_row, s.subreddit_id FROM arrived a
      LEFT JOIN (SELECT * FROM submissions WHERE processing_status <> 'pending') s ON a.submission_id = s.reddit_id)
    SELECT 'submissions' AS part, reddit_id, title AS text, score, id AS place, CAST(subreddit_id AS BIGINT) AS number FROM posted
    UNION ALL SELECT 'comments', reddit_id, body, score, submission_row, subreddit_id FROM found WHERE submission_row IS NOT NULL
    UNION ALL SELECT 'rejected', reddit_id, body, score, NULL, NULL FROM found WHERE submission_row IS NULL
    UNION ALL SELECT 'queue', reddit_id, 'submission', 1, id, NULL FROM posted
    UNION ALL SELECT 'queue', reddit_id, 'comment', 0, id, NULL FROM found WHERE submission_row IS NOT NULL
    UNION ALL SELECT 'totals', 'found', NULL, NULL, NULL, count(*) FROM submissions WHERE processing_status <> 'pending'
    UNION ALL SELECT 'totals', 'submissions', NULL, NULL, NULL, count(*) FROM posted
    UNION ALL SELECT 'totals', 'comments', NULL, NULL, NULL, count(*) FROM found WHERE submission_row IS NOT NULL
    UNION ALL SELECT 'events', 'load', 'running', 1, NULL, NULL
    UNION ALL SELECT 'events', 'load', 'success', 2, (SELECT count(*) || ' comments without a submission' FROM found WHERE submission_row IS NULL),
      (SELECT count(*) FROM found WHERE submission_row IS NOT NULL)""")
def ingest_batch(t: Tables) -> DataFrame:
    """Finished posts are stored, running ones arrive, pending ones are unknown."""
    parts = ingest.ingest_batch(
        t.submissions.where("processing_status <> 'pending'"),
        arrivals(t.stored("lineitem")),
        t.submissions.where("processing_status = 'completed'"),
        t.raw_comments.where("is_submitter"),
        _last_event(t),
        comment_order=FIRST_COPY,
    )
    number = "CAST(NULL AS BIGINT)"
    totals = "stack(3, 'found', submissions_found, 'submissions', submissions_scraped, 'comments', comments_scraped) AS (reddit_id, number)"
    # The text and score of a comment are made from what arrived.
    shown = [e for e in COMMENTS if e.endswith((" AS body", " AS score"))]
    placed, rejected = (parts[name].selectExpr("*", *shown) for name in ("comments", "rejected"))
    rows = [
        parts["submissions"].selectExpr("'submissions' AS part", "reddit_id", "title AS text", "score", "id AS place", "CAST(subreddit_id AS BIGINT) AS number"),
        placed.selectExpr("'comments'", "reddit_id", "body", "score", "submission_row", "CAST(subreddit_id AS BIGINT)"),
        rejected.selectExpr("'rejected'", "reddit_id", "body", "score", "CAST(NULL AS STRING)", number),
        parts["queue"].selectExpr("'queue'", "reddit_id", "content_type", "priority", "content_id", number),
        parts["totals"].selectExpr(totals).selectExpr("'totals'", "reddit_id", "CAST(NULL AS STRING)", "CAST(NULL AS INT)", "CAST(NULL AS STRING)", "number"),
        parts["events"].selectExpr("'events'", "session_id", "status", "seq", "error_message", "comments_scraped"),
    ]
    return reduce(DataFrame.union, rows)


@query("process_pending_with", """SELECT id AS item_id, 'complete' AS action, upper(reddit_id) || ':' || priority AS result
    FROM queue WHERE processing_status = 'pending'""")
def process_pending_with(t: Tables) -> DataFrame:
    def process(batch: pd.DataFrame) -> pd.DataFrame:
        text = batch["reddit_id"].str.upper() + ":" + batch["priority"].astype(str)
        return pd.DataFrame({"item_id": batch["id"], "action": "complete", "result": text})

    pending = t.queue.where("processing_status = 'pending'").select("id", "reddit_id", "priority")
    return enrich.process_pending_with(pending, process, "item_id string, action string, result string")


# --- checks ----------------------------------------------------------------

# The characters a result count may not hold, and number shapes.
BAD_TEXT = r"'[@_!#$%^&*()<>?/\\|}{~:+`=]'"
NUMBER = r"'^\s*[+-]?[0-9]+(_[0-9]+)*\s*$'"
ZERO = r"'^\s*[+-]?0+(_0+)*\s*$'"


@query("validate_scrape_requests", f"""
    WITH r AS (SELECT *, lower(category) AS code FROM requests)
    SELECT request_id, 'invalid category' AS violation FROM r WHERE code NOT IN ('h', 'n', 't', 'r', 'c', 's')
    UNION ALL SELECT request_id, 'time filter not available' FROM r WHERE code IN ('h', 'n', 'r') AND time_filter IS NOT NULL
    UNION ALL SELECT request_id, 'invalid time filter' FROM r WHERE code IN ('t', 'c', 's')
      AND lower(time_filter) NOT IN ('all', 'day', 'hour', 'month', 'week', 'year')
    UNION ALL SELECT request_id, 'invalid result count' FROM r WHERE code IN ('h', 'n', 't', 'r', 'c')
      AND (NOT regexp_matches(n_results, {NUMBER}) OR regexp_matches(n_results, {ZERO}))""")
def validate_scrape_requests(t: Tables) -> DataFrame:
    return quality.subreddit_request_violations(t.requests)


@query("validate_redditor_requests", f"""SELECT request_id, 'invalid result count' AS violation FROM requests
    WHERE regexp_matches(n_results, '\\p{{L}}') OR regexp_matches(n_results, {BAD_TEXT})
      OR NOT regexp_matches(n_results, {NUMBER}) OR regexp_matches(n_results, {ZERO})""")
def validate_redditor_requests(t: Tables) -> DataFrame:
    return quality.redditor_request_violations(t.requests)


@query("validate_comment_requests", f"""SELECT request_id, 'invalid result count' AS violation FROM requests
    WHERE regexp_matches(n_results, '\\p{{L}}') OR regexp_matches(n_results, {BAD_TEXT})""")
def validate_comment_requests(t: Tables) -> DataFrame:
    return quality.comment_request_violations(t.requests)


@query("default_time_filter", """SELECT request_id, coalesce(time_filter, CASE WHEN lower(category) IN ('t', 'c', 's') THEN 'all' END) AS time_filter
    FROM requests""")
def default_time_filter(t: Tables) -> DataFrame:
    return quality.default_time_filter(t.requests).select("request_id", "time_filter")


@query("validate_entities", "SELECT request_id, name, name IN (SELECT name FROM subreddits) AS valid FROM requests")
def validate_entities(t: Tables) -> DataFrame:
    return quality.validate_entities(t.requests.select("request_id", "name"), t.subreddits)


@query("except_known", "SELECT request_id, name FROM requests WHERE name NOT IN (SELECT name FROM subreddits)")
def except_known(t: Tables) -> DataFrame:
    return quality.except_known(t.requests, t.subreddits).select("request_id", "name")


@query("settings_for_valid_entities", """SELECT name, request_id, category, n_results,
      coalesce(time_filter, CASE WHEN lower(category) IN ('t', 'c', 's') THEN 'all' END) AS time_filter
    FROM requests WHERE name IN (SELECT name FROM subreddits)""")
def settings_for_valid_entities(t: Tables) -> DataFrame:
    rows = quality.settings_for_valid(t.requests, t.subreddits)
    return rows.select("name", "request_id", "category", "n_results", "time_filter")


@query("last_setting_for_valid", """SELECT name, arg_max(n_results, request_id) AS n_results FROM requests
    WHERE name IN (SELECT name FROM subreddits) GROUP BY 1""")
def last_setting_for_valid(t: Tables) -> DataFrame:
    return quality.last_setting_for_valid(t.requests, t.subreddits)


@query("enum_violations", """SELECT id AS row_id, 'task_type' AS column_name, task_type AS value FROM sessions
    WHERE task_type NOT IN ('scheduled', 'manual')
    UNION ALL SELECT id, 'time_filter', time_filter FROM sessions
      WHERE time_filter NOT IN ('all', 'day', 'hour', 'month', 'week', 'year')""")
def enum_violations(t: Tables) -> DataFrame:
    return quality.enum_violations(t.sessions, "id", ["task_type", "time_filter", "category", "status"])


@query("config_signature", """SELECT config_id, substring(md5(concat_ws('|', coalesce(name, ''), coalesce(category, ''),
      coalesce(time_filter, ''), coalesce(CAST(n_results AS STRING), ''), coalesce(keywords, ''))), 1, 8) AS signature FROM configs""")
def config_signature(t: Tables) -> DataFrame:
    text = config_text("name", "category", "time_filter", "n_results", "keywords")
    return t.configs.select("config_id", short_hash(text).alias("signature"))


CONFIG_TEXT = """concat_ws('|', coalesce(name, ''), coalesce(category, ''), coalesce(time_filter, ''),
      coalesce(CAST(n_results AS STRING), ''), coalesce(keywords, ''))"""


@query("config_set_signature", f"""WITH runs AS (SELECT CAST(floor(config_id / 12) AS BIGINT) AS run, name, {CONFIG_TEXT} AS text FROM configs),
    sets AS (SELECT run, substring(md5(string_agg(text, chr(10) ORDER BY text)), 1, 8) AS signature, count(*) AS configs,
      array_to_string(list_sort(list_distinct(list(name))), '_') AS names FROM runs GROUP BY 1)
    SELECT run, signature, configs, CASE WHEN length(names) > 50 THEN 'multi_' || substring(md5(names), 1, 8) ELSE names END AS subjects FROM sets""")
def config_set_signature(t: Tables) -> DataFrame:
    """A dozen configs make a run."""
    runs = t.configs.withColumn("run", F.floor(F.col("config_id") / 12).cast("bigint"))
    return quality.config_sets(runs, ["run"])


# --- inventories and runs --------------------------------------------------

LAST_OBJECT = "(SELECT max(last_modified) FROM objects)"


def _last_object(t: Tables):
    return newest(t.objects, "last_modified")


@query("object_inventory", f"""SELECT key, size, {iso('o.last_modified')} AS last_modified, round(size / 1048576, 2) AS size_mb
    FROM objects o WHERE starts_with(key, 'daily') AND o.last_modified >= {LAST_OBJECT} - INTERVAL 7 DAY""")
def object_inventory(t: Tables) -> DataFrame:
    rows = inventory.object_inventory(t.objects, _last_object(t), "daily")
    return rows.withColumn("last_modified", iso_time("last_modified"))


@query("recent_uploads", f"""SELECT key, size, {iso('o.last_modified')} AS last_modified, round(size / 1048576, 2) AS size_mb
    FROM objects o WHERE o.last_modified > {LAST_OBJECT} - INTERVAL 24 HOUR""")
def recent_uploads(t: Tables) -> DataFrame:
    return inventory.recent_uploads(t.objects, _last_object(t)).withColumn("last_modified", iso_time("last_modified"))


@query("object_metadata", f"""SELECT key, size AS content_length, {iso('o.last_modified')} AS last_modified,
      coalesce(upload_metadata, '{{}}') AS metadata, coalesce(content_type, 'unknown') AS content_type
    FROM objects o LEFT JOIN archives ON key = r2_object_key""")
def object_metadata(t: Tables) -> DataFrame:
    return inventory.object_metadata(t.objects, t.archives).withColumn("last_modified", iso_time("last_modified"))


RECENT = f"(SELECT * FROM objects WHERE last_modified >= {LAST_OBJECT} - INTERVAL 7 DAY)"


@query("naming_conflicts", f"""WITH k AS (SELECT key, replace(split_part(key, '/', 1), '_scrapes', '') || '_' || split_part(key, '/', 2) AS conflict_group
      FROM {RECENT} WHERE contains(key, '/'))
    SELECT key, conflict_group, files FROM k JOIN (SELECT conflict_group, count(*) AS files FROM k GROUP BY 1) USING (conflict_group)
    WHERE files > 1""")
def naming_conflicts(t: Tables) -> DataFrame:
    return inventory.naming_conflicts(t.objects, _last_object(t)).drop("last_modified")


@query("scrape_pattern_report", f"""WITH l AS (SELECT *, split_part(key, '/', 1) AS prefix FROM {RECENT} WHERE contains(key, '_scrapes/'))
    SELECT prefix, position, key, size, files, greatest(files - 10, 0) AS more_files FROM (
      SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY last_modified DESC, key) AS position,
        count(*) OVER (PARTITION BY prefix) AS files FROM l) WHERE position <= 10""")
def scrape_pattern_report(t: Tables) -> DataFrame:
    rows = inventory.scrape_pattern_report(t.objects, _last_object(t))
    return rows.select("prefix", "position", "key", "size", "files", "more_files")


@query("locate_comment_file", """SELECT reddit_id, path, CAST(scrape_date AS STRING) AS scrape_date FROM (
      SELECT f.*, s.reddit_id, row_number() OVER (PARTITION BY s.reddit_id ORDER BY scrape_date DESC, path) AS r
      FROM comment_files f JOIN submissions s ON f.permalink = '/r/n/comments/' || s.reddit_id || '/t/'
      WHERE scrape_date > CAST((SELECT max(l_shipdate) FROM lineitem) AS DATE) - 3) WHERE r = 1""")
def locate_comment_file(t: Tables) -> DataFrame:
    rows = inventory.locate_comment_file(t.posts, t.comment_files, newest(t.stored("lineitem"), "l_shipdate"))
    return rows.select("reddit_id", "path", F.col("scrape_date").cast("string").alias("scrape_date"))


@query("locate_comment_file_containing", "SELECT path FROM comment_files WHERE contains(url, '123') OR contains(permalink, '123')")
def locate_comment_file_containing(t: Tables) -> DataFrame:
    return inventory.comment_files_containing(t.comment_files, "123").select("path")


@query("run_totals", """WITH s AS (SELECT x.*, CAST(CAST(x.started_at AS DATE) AS STRING) AS run_date, r.name
      FROM sessions x LEFT JOIN subreddits r ON x.subreddit_id = r.id),
    d AS (SELECT DISTINCT run_date, name FROM s WHERE status = 'success' AND name IS NOT NULL),
    p AS (SELECT run_date, (rn - 1) // 10 AS page, string_agg(name, ',' ORDER BY rn) AS names
      FROM (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY name) AS rn FROM d) GROUP BY ALL)
    SELECT t.*, coalesce(page, 0) AS page, coalesce(names, '') AS subreddits FROM (
      SELECT run_date, count(*) AS configs_processed, count(*) FILTER (status = 'success') AS successful_scrapes,
        count(*) FILTER (status = 'skipped') AS skipped_scrapes, CAST(sum(coalesce(submissions_found, 0)) AS BIGINT) AS total_submissions,
        CAST(sum(coalesce(comments_scraped, 0)) AS BIGINT) AS total_comments_scraped FROM s GROUP BY 1) t
      LEFT JOIN p USING (run_date)""")
def run_totals(t: Tables) -> DataFrame:
    names = t.subreddits.select(F.col("id").alias("subreddit_id"), F.col("name").alias("subreddit"))
    runs = t.sessions.join(names, "subreddit_id", "left").withColumn("run_date", F.col("started_at").cast("date").cast("string"))
    return inventory.run_totals(runs, ["run_date"], page_size=10)


@query("active_scrape_stats", f"""SELECT r.name AS subreddit_name, count(*) AS total_sessions,
      count(*) FILTER (status = 'success') AS successful_sessions,
      {iso("max(completed_at) FILTER (status = 'success')")} AS last_successful_scrape,
      CAST(sum(coalesce(submissions_scraped, 0)) AS BIGINT) AS total_submissions,
      CAST(sum(coalesce(comments_scraped, 0)) AS BIGINT) AS total_comments, round(avg(duration_seconds), 6) AS avg_session_duration
    FROM sessions s JOIN subreddits r ON s.subreddit_id = r.id GROUP BY 1""")
def active_scrape_stats(t: Tables) -> DataFrame:
    rows = inventory.active_scrape_stats(t.sessions, t.subreddits)
    return rows.withColumn("avg_session_duration", F.round("avg_session_duration", 6)).withColumn(
        "last_successful_scrape", iso_time("last_successful_scrape")
    )


@query("task_metric_rollup", """SELECT session_id, metric_name, metric_unit, count(*) AS samples,
      round(avg(metric_value), 4) AS average, min(metric_value) AS lowest, max(metric_value) AS highest
    FROM metrics GROUP BY ALL""")
def task_metric_rollup(t: Tables) -> DataFrame:
    return inventory.task_metric_rollup(t.metrics).withColumn("average", F.round("average", 4))
