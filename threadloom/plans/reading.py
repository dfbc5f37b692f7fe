"""Registered queries: views, reads, joins, statistics and rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import iso_time
from ..operators import reads, stats, substring_index, views
from ..session import scratch_path
from .bindings import Tables, newest
from .registry import query

# Text of a time in the checking database, as iso_time writes it.
ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({0}, '%f') = '000000' THEN '' ELSE '.' || strftime({0}, '%f') END"


def iso(c: str) -> str:
    return ISO.format(c)


SUB_COLS = f"""s.id, s.reddit_id, s.title, s.url, s.permalink, s.selftext, s.author,
  {iso('s.created_utc')} AS created_utc, s.score, s.upvote_ratio, s.num_comments, s.is_self, s.is_nsfw,
  s.is_spoiler, s.is_stickied, s.link_flair_text, r.name AS subreddit, s.processing_status,
  {iso('s.first_seen_at')} AS first_seen_at"""
SUB_FROM = "FROM submissions s LEFT JOIN subreddits r ON s.subreddit_id = r.id"
COM_COLS = f"""c.id, c.reddit_id, c.body, c.author, {iso('c.created_utc')} AS created_utc, c.score, c.parent_id,
  c.link_id, c.depth, c.is_submitter, c.is_stickied, c.processing_status, c.submission_id"""
LAST_POST = "(SELECT max(o_orderdate) FROM orders)"
LAST_EVENT = "(SELECT max(ts) FROM events)"


def _posts(t: Tables, rows: DataFrame) -> DataFrame:
    return views.submission_view(rows, t.subreddits)


def _last_post(t: Tables):
    return newest(t.stored("orders"), "o_orderdate")


def _last_event(t: Tables):
    return newest(t.stored("events"), "ts")


def _candidates(t: Tables, keywords: list[str], fields: list[str]) -> DataFrame:
    """Submissions of the blocks that a trigram index names."""
    path, schema = scratch_path(t.spark, "indexed"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.submissions.schema)
    substring_index.write_indexed(t.submissions, path, ["title", "selftext"])
    return substring_index.candidates(t.spark, path, schema, keywords, fields)


# Each stored table with its first key.
KEYED = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id",
    "pages": "page_id", "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


@query("scan_tables", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, count({c}) AS keyed, min({c})::BIGINT AS least, max({c})::BIGINT AS largest FROM {n}"
    for n, c in KEYED.items()))
def scan_tables(t: Tables) -> DataFrame:
    parts = [
        t.stored(n).agg(
            F.lit(n).alias("table_name"), F.count("*").alias("row_count"), F.count(c).alias("keyed"),
            F.min(c).cast("bigint").alias("least"), F.max(c).cast("bigint").alias("largest"),
        )
        for n, c in KEYED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("api_submission_view", f"SELECT {SUB_COLS} {SUB_FROM}")
def api_submission_view(t: Tables) -> DataFrame:
    return _posts(t, t.submissions)


@query("api_comment_view", f"SELECT {COM_COLS} FROM stored_comments c")
def api_comment_view(t: Tables) -> DataFrame:
    return views.comment_view(t.stored_comments)


@query("api_session_view", f"""SELECT s.id, task_id, task_type, r.name AS subreddit, category, n_results, keywords,
    time_filter, status, {iso('started_at')} AS started_at, {iso('completed_at')} AS completed_at, duration_seconds,
    submissions_found, submissions_scraped, comments_scraped, error_message
    FROM sessions s LEFT JOIN subreddits r ON s.subreddit_id = r.id""")
def api_session_view(t: Tables) -> DataFrame:
    return views.session_view(t.sessions, t.subreddits)


@query("session_with_subreddit", """SELECT s.id, s.status, r.name AS subreddit
    FROM sessions s LEFT JOIN subreddits r ON s.subreddit_id = r.id""")
def session_with_subreddit(t: Tables) -> DataFrame:
    return views.with_subreddit(t.sessions, t.subreddits).select("id", "status", "subreddit")


QUEUE_COLS = f"""id, content_type, content_id, reddit_id, priority, processing_status, processor_name,
  {iso('queued_at')} AS queued_at, {iso('started_processing_at')} AS started_processing_at,
  {iso('completed_at')} AS completed_at, retry_count, processing_result"""


@query("api_queue_view", f"SELECT {QUEUE_COLS} FROM queue")
def api_queue_view(t: Tables) -> DataFrame:
    return views.queue_view(t.queue)


@query("preview_text", """
    SELECT reddit_id, 'title' AS kind, substring(title, 1, 60) || '...' AS short,
      CASE WHEN length(selftext) > 500 THEN substring(selftext, 1, 500) || '...' ELSE selftext END AS text
    FROM submissions
    UNION ALL
    SELECT reddit_id, 'body', substring(replace(body, chr(10), ' '), 1, 100) || '...',
      CASE WHEN length(body) > 200 THEN substring(body, 1, 200) || '...' ELSE body END FROM stored_comments""")
def preview_text(t: Tables) -> DataFrame:
    return views.previews(t.stored_comments, t.submissions)


@query("content_flags", """SELECT reddit_id, concat_ws(', ',
      CASE WHEN is_nsfw THEN 'NSFW' END, CASE WHEN is_spoiler THEN 'SPOILER' END,
      CASE WHEN is_stickied THEN 'STICKIED' END, CASE WHEN is_locked THEN 'LOCKED' END,
      CASE WHEN is_original_content THEN 'OC' END) AS flags FROM submissions""")
def content_flags(t: Tables) -> DataFrame:
    return views.flag_list(t.posts)


@query("recent_submissions", f"""SELECT {SUB_COLS} {SUB_FROM}
    WHERE s.created_utc >= {LAST_POST} - INTERVAL 7 DAY ORDER BY s.created_utc DESC, s.reddit_id LIMIT 100""")
def recent_submissions(t: Tables) -> DataFrame:
    return _posts(t, reads.recent_submissions(t.submissions, t.subreddits, _last_post(t)))


@query("filter_by_subreddit_name", f"""SELECT {SUB_COLS} {SUB_FROM}
    WHERE r.name = 'NATION_3' AND s.created_utc >= {LAST_POST} - INTERVAL 365 DAY
    ORDER BY s.created_utc DESC, s.reddit_id LIMIT 100""")
def filter_by_subreddit_name(t: Tables) -> DataFrame:
    rows = reads.recent_submissions(t.submissions, t.subreddits, _last_post(t), 365, "NATION_3")
    return _posts(t, rows)


@query("submission_with_subreddit", "SELECT s.reddit_id, s.title, r.name AS subreddit " + SUB_FROM)
def submission_with_subreddit(t: Tables) -> DataFrame:
    return views.with_subreddit(t.submissions, t.subreddits).select("reddit_id", "title", "subreddit")


KEYWORD_SQL = f"""SELECT {SUB_COLS} {SUB_FROM}
    WHERE s.title ILIKE '%urgent f%' OR s.selftext ILIKE '%urgent f%' OR s.title ILIKE '%total 1_00%'
      OR s.selftext ILIKE '%total 1_00%'
    ORDER BY s.score DESC, s.reddit_id LIMIT 100"""
KEYWORDS = ["Urgent F", "total 1_00"]


@query("keyword_search", KEYWORD_SQL)
def keyword_search(t: Tables) -> DataFrame:
    return _posts(t, reads.keyword_search(t.submissions, t.subreddits, KEYWORDS))


@query("keyword_search_indexed", KEYWORD_SQL)
def keyword_search_indexed(t: Tables) -> DataFrame:
    found = _candidates(t, KEYWORDS, ["title", "selftext"])
    return _posts(t, reads.keyword_search(found, t.subreddits, KEYWORDS))


TITLE_SQL = f"""SELECT s.reddit_id, s.title, s.author, s.score, r.name AS subreddit,
      {iso('s.created_utc')} AS created_utc, coalesce(n, 0) AS comment_count
    {SUB_FROM} LEFT JOIN (SELECT submission_id, count(*) AS n FROM stored_comments GROUP BY 1) c ON c.submission_id = s.reddit_id
    WHERE s.title ILIKE '%urgent%'"""


def _titles(t: Tables, posts: DataFrame) -> DataFrame:
    found = reads.title_search(posts, t.subreddits, t.stored_comments, "urgent")
    return found.select("reddit_id", "title", "author", "score", "subreddit", iso_time("created_utc").alias("created_utc"), "comment_count")


@query("title_search", TITLE_SQL)
def title_search(t: Tables) -> DataFrame:
    return _titles(t, t.submissions)


@query("title_search_indexed", TITLE_SQL)
def title_search_indexed(t: Tables) -> DataFrame:
    return _titles(t, _candidates(t, ["urgent"], ["title"]))


@query("author_submissions", f"""SELECT {SUB_COLS} {SUB_FROM} WHERE s.author = 'u/7'
    ORDER BY s.created_utc DESC, s.reddit_id LIMIT 100""")
def author_submissions(t: Tables) -> DataFrame:
    return _posts(t, reads.by_author(t.submissions, "u/7"))


@query("author_comments", f"""SELECT {COM_COLS} FROM stored_comments c WHERE author = 'u/7'
    ORDER BY c.created_utc DESC, c.reddit_id LIMIT 100""")
def author_comments(t: Tables) -> DataFrame:
    return views.comment_view(reads.by_author(t.stored_comments, "u/7"))


@query("author_activity_union", f"""
    (SELECT reddit_id, author, {iso('created_utc')} AS created_utc, score, 'submission' AS content_type FROM submissions x
     WHERE author = 'u/7' ORDER BY x.created_utc DESC, reddit_id LIMIT 100)
    UNION ALL
    (SELECT reddit_id, author, {iso('created_utc')}, score, 'comment' FROM stored_comments x
     WHERE author = 'u/7' ORDER BY x.created_utc DESC, reddit_id LIMIT 100)""")
def author_activity_union(t: Tables) -> DataFrame:
    both = reads.author_activity(t.posts, t.stored_comments, "u/7")
    return both.withColumn("created_utc", iso_time("created_utc"))


@query("point_lookup", f"SELECT {SUB_COLS} {SUB_FROM} WHERE s.reddit_id = '42'")
def point_lookup(t: Tables) -> DataFrame:
    return _posts(t, reads.point_lookup(t.submissions, "42"))


@query("pending_queue", f"""SELECT {QUEUE_COLS} FROM queue x WHERE processing_status = 'pending'
      AND content_type = 'submission'
    ORDER BY priority DESC, x.queued_at, id LIMIT 100""")
def pending_queue(t: Tables) -> DataFrame:
    return views.queue_view(reads.pending_queue(t.queue, content_type="submission"))


@query("session_history", f"""SELECT id, status, {iso('started_at')} AS started_at FROM sessions x
    WHERE x.started_at >= {LAST_EVENT} - INTERVAL 30 DAY ORDER BY x.started_at DESC, id LIMIT 100""")
def session_history(t: Tables) -> DataFrame:
    rows = reads.session_history(t.sessions, _last_event(t))
    return rows.select("id", "status", iso_time("started_at").alias("started_at"))


@query("exclude_deleted_authors", "SELECT reddit_id, author FROM stored_comments WHERE author <> '[deleted]'")
def exclude_deleted_authors(t: Tables) -> DataFrame:
    return reads.exclude_deleted(t.stored_comments).select("reddit_id", "author")


@query("top_submissions_by_score", f"""SELECT {SUB_COLS} {SUB_FROM}
    WHERE s.created_utc >= {LAST_POST} - INTERVAL 7 DAY ORDER BY s.score DESC, s.reddit_id LIMIT 50""")
def top_submissions_by_score(t: Tables) -> DataFrame:
    return _posts(t, reads.top_submissions_by_score(t.submissions, t.subreddits, _last_post(t)))


@query("latest_sessions", f"""SELECT id, status, submissions_scraped, comments_scraped FROM sessions
    ORDER BY started_at DESC, id LIMIT 5""")
def latest_sessions(t: Tables) -> DataFrame:
    return reads.latest(t.sessions, "started_at", 5, "id").select("id", "status", "submissions_scraped", "comments_scraped")


@query("latest_submissions", """SELECT reddit_id, substring(title, 1, 50) || '...' AS title FROM submissions
    ORDER BY first_seen_at DESC, reddit_id LIMIT 3""")
def latest_submissions(t: Tables) -> DataFrame:
    rows = reads.latest(t.posts, "first_seen_at", 3)
    return rows.select("reddit_id", views.preview("title", 50).alias("title"))


@query("latest_comments", """SELECT reddit_id, substring(body, 1, 50) || '...' AS body FROM stored_comments
    ORDER BY first_seen_at DESC, reddit_id LIMIT 3""")
def latest_comments(t: Tables) -> DataFrame:
    rows = reads.latest(t.stored_comments, "first_seen_at", 3)
    return rows.select("reddit_id", views.preview("body", 50).alias("body"))


@query("fallback_recent_posts", """SELECT reddit_id, title FROM submissions
    ORDER BY first_seen_at DESC, reddit_id LIMIT 5""")
def fallback_recent_posts(t: Tables) -> DataFrame:
    return reads.post_or_recent(t.posts, "no such post").select("reddit_id", "title")


@query("listing_new", """SELECT s.reddit_id FROM submissions s JOIN subreddits r ON s.subreddit_id = r.id
    WHERE r.name = 'NATION_5' ORDER BY s.created_utc DESC, s.reddit_id LIMIT 25""")
def listing_new(t: Tables) -> DataFrame:
    return reads.listing_new(t.submissions, t.subreddits, "NATION_5", 25).select("reddit_id")


@query("listing_top", f"""SELECT s.reddit_id, s.score FROM submissions s JOIN subreddits r ON s.subreddit_id = r.id
    WHERE r.name = 'NATION_5' AND s.created_utc >= {LAST_POST} - INTERVAL 365 DAY
    ORDER BY s.score DESC, s.reddit_id LIMIT 25""")
def listing_top(t: Tables) -> DataFrame:
    rows = reads.listing_top(t.submissions, t.subreddits, "NATION_5", 25, _last_post(t), "year")
    return rows.select("reddit_id", "score")


@query("listing_search", f"""SELECT s.reddit_id, s.score FROM submissions s JOIN subreddits r ON s.subreddit_id = r.id
    WHERE r.name = 'NATION_5' AND s.created_utc >= {LAST_POST} - INTERVAL 365 DAY
      AND (s.title ILIKE '%high%' OR s.selftext ILIKE '%high%' OR s.title ILIKE '%low%' OR s.selftext ILIKE '%low%')
    ORDER BY s.score DESC, s.reddit_id LIMIT 100""")
def listing_search(t: Tables) -> DataFrame:
    rows = reads.listing_search(t.submissions, t.subreddits, "NATION_5", "high low", _last_post(t), "year")
    return rows.select("reddit_id", "score")


@query("enabled_configs", """SELECT config_id, name, is_manual FROM configs
    WHERE CASE WHEN is_manual THEN coalesce(enabled, true) ELSE coalesce(enabled, false) AND schedule IS NOT NULL END""")
def enabled_configs(t: Tables) -> DataFrame:
    both = reads.enabled_configs(t.configs).unionByName(reads.enabled_configs(t.configs, manual=True))
    return both.select("config_id", "name", "is_manual")


@query("configs_by_predicate", """SELECT config_id, name, schedule FROM configs
    WHERE NOT is_manual AND coalesce(enabled, false) AND schedule LIKE '%U%'""")
def configs_by_predicate(t: Tables) -> DataFrame:
    return reads.configs_by(t.configs, F.col("schedule").contains("U")).select("config_id", "name", "schedule")


@query("unique_subreddits", """SELECT DISTINCT name FROM configs
    WHERE NOT is_manual AND coalesce(enabled, false) AND schedule IS NOT NULL""")
def unique_subreddits(t: Tables) -> DataFrame:
    return reads.unique_subreddits(t.configs)


# Nested comments come as text: id and score in time order, pages of 4.
NESTED = """(SELECT submission_id, (rn - 1) // 4 AS page,
      string_agg(reddit_id || ':' || score, ' ' ORDER BY rn) AS comments
    FROM (SELECT submission_id, reddit_id, score,
            row_number() OVER (PARTITION BY submission_id ORDER BY created_utc, reddit_id) AS rn FROM stored_comments)
    GROUP BY ALL)"""


def _as_text(pages: DataFrame) -> DataFrame:
    item = F.transform("comments", lambda c: F.concat(c["reddit_id"], F.lit(":"), c["score"]))
    return pages.withColumn("comments", F.coalesce(F.array_join(item, " "), F.lit("")))


@query("submission_with_comments", f"""SELECT s.reddit_id, coalesce(c.page, 0) AS page, coalesce(c.comments, '') AS comments
    FROM submissions s LEFT JOIN {NESTED} c ON s.reddit_id = c.submission_id""")
def submission_with_comments(t: Tables) -> DataFrame:
    pages = stats.nested_comments(t.posts.select("reddit_id"), t.stored_comments, ["reddit_id", "score"], page_size=4)
    return _as_text(pages)


STATS = """(SELECT submission_id, count(*) AS total_comments, count(*) FILTER (score >= 10) AS high_score_comments,
      count(*) FILTER (score BETWEEN 1 AND 9) AS medium_score_comments, count(*) FILTER (score < 1) AS low_score_comments,
      max(score) AS highest_score, min(score) AS lowest_score, avg(score) AS average_score
    FROM stored_comments GROUP BY 1)"""
STAT_COLS = """coalesce(total_comments, 0) AS total_comments, coalesce(high_score_comments, 0) AS high_score_comments,
    coalesce(medium_score_comments, 0) AS medium_score_comments, coalesce(low_score_comments, 0) AS low_score_comments,
    coalesce(highest_score, 0) AS highest_score, coalesce(lowest_score, 0) AS lowest_score,
    round(coalesce(average_score, 0), 6) AS average_score"""

STAT_NAMES = [
    "total_comments", "high_score_comments", "medium_score_comments", "low_score_comments",
    "highest_score", "lowest_score", "average_score",
]


@query("post_comment_stats", f"""SELECT s.reddit_id, {STAT_COLS} FROM submissions s
    LEFT JOIN {STATS} k ON s.reddit_id = k.submission_id""")
def post_comment_stats(t: Tables) -> DataFrame:
    rows = stats.post_comment_stats(t.posts, t.stored_comments)
    return rows.withColumn("average_score", F.round("average_score", 6))


FULL_POST = f"""SELECT s.reddit_id, s.title, s.author, coalesce(r.name, 'Unknown') AS subreddit, {STAT_COLS},
      coalesce(c.page, 0) AS page, coalesce(c.comments, '') AS comments
    {SUB_FROM} LEFT JOIN {STATS} k ON s.reddit_id = k.submission_id
    LEFT JOIN {NESTED} c ON s.reddit_id = c.submission_id"""


def full_post_text(pages: DataFrame) -> DataFrame:
    """Pages of full posts as rows that can be compared."""
    pages = _as_text(pages)
    numbers = [c for c in pages.columns if c in STAT_NAMES]
    return pages.withColumn("average_score", F.round("average_score", 6)).select(
        "reddit_id", "title", "author", "subreddit", *numbers, "page", "comments"
    )


@query("full_post", FULL_POST)
def full_post(t: Tables) -> DataFrame:
    return full_post_text(stats.full_post(t.submissions, t.subreddits, t.stored_comments, page_size=4))


@query("submissions_having_comments", """SELECT reddit_id, title FROM submissions
    WHERE reddit_id IN (SELECT submission_id FROM stored_comments)""")
def submissions_having_comments(t: Tables) -> DataFrame:
    return stats.submissions_with_comments(t.posts, t.stored_comments).select("reddit_id", "title")


@query("subreddit_stats", f"""SELECT r.name AS subreddit, coalesce(p.n, 0) AS total_submissions,
      round(coalesce(p.a, 0), 6) AS avg_score, coalesce(p.m, 0) AS max_score, coalesce(p.u, 0) AS unique_authors,
      coalesce(k.n, 0) AS total_comments, round(coalesce(k.a, 0), 6) AS avg_comment_score,
      coalesce(p.w, 0) AS recent_submissions_7d
    FROM subreddits r
    LEFT JOIN (SELECT subreddit_id, count(*) AS n, avg(score) AS a, max(score) AS m, count(DISTINCT author) AS u,
        count(*) FILTER (created_utc >= {LAST_POST} - INTERVAL 7 DAY) AS w FROM submissions GROUP BY 1) p
      ON p.subreddit_id = r.id
    LEFT JOIN (SELECT s.subreddit_id, count(*) AS n, avg(c.score) AS a
        FROM stored_comments c JOIN submissions s ON c.submission_id = s.reddit_id GROUP BY 1) k ON k.subreddit_id = r.id""")
def subreddit_stats(t: Tables) -> DataFrame:
    rows = stats.subreddit_stats(t.subreddits, t.submissions, t.stored_comments, _last_post(t))
    return rows.withColumn("avg_score", F.round("avg_score", 6)).withColumn("avg_comment_score", F.round("avg_comment_score", 6))


@query("submissions_per_subreddit", """SELECT r.name, count(s.reddit_id) AS submission_count
    FROM subreddits r LEFT JOIN submissions s ON s.subreddit_id = r.id GROUP BY 1""")
def submissions_per_subreddit(t: Tables) -> DataFrame:
    return stats.per_subreddit(t.subreddits, t.submissions, "submission_count")


PLACED = "(SELECT c.*, s.subreddit_id FROM stored_comments c JOIN submissions s ON c.submission_id = s.reddit_id)"


@query("comments_per_subreddit", f"""SELECT r.name, count(c.reddit_id) AS comment_count
    FROM subreddits r LEFT JOIN {PLACED} c ON c.subreddit_id = r.id GROUP BY 1""")
def comments_per_subreddit(t: Tables) -> DataFrame:
    return stats.comments_per_subreddit(t.subreddits, t.submissions, t.stored_comments)


@query("ranked_listing", f"""SELECT row_number() OVER (ORDER BY comment_count DESC, author) AS position, author AS name, comment_count
    FROM (SELECT author, count(*) AS comment_count FROM stored_comments WHERE author <> '[deleted]' GROUP BY 1)""")
def ranked_listing(t: Tables) -> DataFrame:
    named = reads.exclude_deleted(t.stored_comments)
    counts = named.groupBy(F.col("author").alias("name")).agg(F.count("*").alias("comment_count"))
    return stats.ranked_listing(counts, "comment_count")


@query("comments_per_submission", """SELECT s.reddit_id, s.title, coalesce(n, 0) AS comment_count FROM submissions s
    LEFT JOIN (SELECT submission_id, count(*) AS n FROM stored_comments GROUP BY 1) c ON s.reddit_id = c.submission_id""")
def comments_per_submission(t: Tables) -> DataFrame:
    return stats.comments_per_submission(t.posts, t.stored_comments).select("reddit_id", "title", "comment_count")


@query("top_comment_authors", """SELECT author, count(*) AS comment_count FROM stored_comments WHERE author <> '[deleted]'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def top_comment_authors(t: Tables) -> DataFrame:
    return stats.top_comment_authors(t.stored_comments)


@query("top_commenters_per_post", """SELECT * FROM (SELECT submission_id, author, count(*) AS comments,
      row_number() OVER (PARTITION BY submission_id ORDER BY count(*) DESC, author ASC NULLS FIRST) AS position
    FROM stored_comments WHERE author IS DISTINCT FROM '[deleted]' GROUP BY 1, 2) WHERE position <= 3""")
def top_commenters_per_post(t: Tables) -> DataFrame:
    return stats.top_commenters_per_post(t.stored_comments)


@query("global_average_scores", """SELECT 'submissions' AS kind, round(avg(score), 6) AS average_score FROM submissions
    UNION ALL SELECT 'comments', round(avg(score), 6) FROM stored_comments""")
def global_average_scores(t: Tables) -> DataFrame:
    rows = stats.global_average_scores(t.posts, t.stored_comments)
    return rows.withColumn("average_score", F.round("average_score", 6))


@query("table_counts", """SELECT 'subreddits' AS table_name, count(*) AS rows FROM subreddits
    UNION ALL SELECT 'submissions', count(*) FROM submissions UNION ALL SELECT 'comments', count(*) FROM stored_comments
    UNION ALL SELECT 'sessions', count(*) FROM sessions UNION ALL SELECT 'queue', count(*) FROM queue""")
def table_counts(t: Tables) -> DataFrame:
    return stats.table_counts(
        {"subreddits": t.subreddits, "submissions": t.posts, "comments": t.stored_comments, "sessions": t.sessions, "queue": t.queue}
    )


@query("latest5_submissions_per_subreddit", f"""SELECT s.subreddit_id, s.position, s.reddit_id, s.title,
      coalesce(n, 0) AS comment_count
    FROM (SELECT *, row_number() OVER (PARTITION BY subreddit_id ORDER BY first_seen_at DESC, reddit_id) AS position
          FROM submissions) s
    LEFT JOIN (SELECT submission_id, count(*) AS n FROM stored_comments GROUP BY 1) c ON s.reddit_id = c.submission_id
    WHERE position <= 5""")
def latest5_submissions_per_subreddit(t: Tables) -> DataFrame:
    rows = stats.latest_submissions_per_subreddit(t.submissions, t.stored_comments)
    return rows.select("subreddit_id", "position", "reddit_id", "title", "comment_count")


TOP = """SELECT submission_id, position, reddit_id, author, score,
      substring(replace(body, chr(10), ' '), 1, {n}) || '...' AS preview{more}
    FROM (SELECT *, row_number() OVER (PARTITION BY submission_id ORDER BY score DESC, reddit_id) AS position,
            count(*) OVER (PARTITION BY submission_id) AS total FROM stored_comments) WHERE position <= {k}"""


@query("top2_comments_per_submission", TOP.format(n=80, k=2, more=""))
def top2_comments_per_submission(t: Tables) -> DataFrame:
    rows = stats.top_comments_per_submission(t.stored_comments, 2)
    return rows.select("submission_id", "position", "reddit_id", "author", "score",
                       views.preview(views.one_line("body"), 80).alias("preview"))


@query("top5_comments_per_submission", TOP.format(n=100, k=5, more=", total AS total_comments"))
def top5_comments_per_submission(t: Tables) -> DataFrame:
    rows = stats.top_comments_with_total(t.stored_comments, 5)
    return rows.select("submission_id", "position", "reddit_id", "author", "score",
                       views.preview(views.one_line("body"), 100).alias("preview"), "total_comments")


@query("banded_comment_preview", """SELECT submission_id, band, position, reddit_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY submission_id, band ORDER BY created_utc, reddit_id) AS position
      FROM (SELECT *, CASE WHEN score >= 10 THEN 'high' WHEN score >= 1 THEN 'medium' ELSE 'low' END AS band FROM stored_comments))
    WHERE position <= CASE band WHEN 'high' THEN 10 WHEN 'medium' THEN 5 ELSE 3 END""")
def banded_comment_preview(t: Tables) -> DataFrame:
    return stats.banded_comment_preview(t.stored_comments).select("submission_id", "band", "position", "reddit_id", "score")


@query("comments_by_score", """SELECT submission_id, reddit_id, score,
      row_number() OVER (PARTITION BY submission_id ORDER BY score DESC, reddit_id) AS position FROM stored_comments""")
def comments_by_score(t: Tables) -> DataFrame:
    return stats.comments_by_score(t.stored_comments.select("submission_id", "reddit_id", "score"))


@query("comments_by_time", f"SELECT submission_id, reddit_id, {iso('created_utc')} AS created_utc FROM stored_comments")
def comments_by_time(t: Tables) -> DataFrame:
    rows = stats.comments_by_time(t.stored_comments.select("submission_id", "reddit_id", "created_utc"))
    return rows.withColumn("created_utc", iso_time("created_utc"))
