"""Canonical tables over the stored star-schema tables.

Each binding is a list of SQL expressions that Spark and the checking database
both read, so the two sides cannot drift apart.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ranking import keep_first
from ..sources.tables import parquet_table

SUBREDDITS = [
    "n_nationkey AS id",
    "n_name AS name",
    "n_name AS display_name",
    "CASE WHEN n_regionkey = 1 THEN NULL ELSE 'group ' || n_regionkey END AS description",
    "CAST(n_nationkey * 1000 AS BIGINT) AS subscribers",
    "CAST(NULL AS TIMESTAMP) AS last_scraped_at",
]

SUBMISSIONS = [
    "'s' || o_orderkey AS id",
    "CAST(o_orderkey AS STRING) AS reddit_id",
    "o_orderpriority || ' ' || o_orderstatus AS title",
    "'https://www.reddit.com/r/n' || c_nationkey || '/comments/' || o_orderkey || '/' AS url",
    "'/r/n' || c_nationkey || '/comments/' || o_orderkey || '/' AS permalink",
    "CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'total ' || CAST(floor(o_totalprice) AS BIGINT) || chr(10) || lower(o_orderpriority) END AS selftext",
    "CASE WHEN o_custkey % 50 = 0 THEN '[deleted]' ELSE 'u/' || o_custkey END AS author",
    "o_orderdate AS created_utc",
    "CAST(floor(o_totalprice / 1000) AS INTEGER) AS score",
    "CAST(o_orderkey % 101 AS DOUBLE) / 100 AS upvote_ratio",
    "CAST(o_orderkey % 50 AS INTEGER) AS num_comments",
    "o_orderkey % 2 = 0 AS is_self",
    "o_orderkey % 19 = 0 AS is_original_content",
    "o_orderkey % 7 = 0 AS is_nsfw",
    "o_orderkey % 11 = 0 AS is_spoiler",
    "o_orderkey % 13 = 0 AS is_stickied",
    "o_orderkey % 17 = 0 AS is_locked",
    "o_orderpriority AS link_flair_text",
    "CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing' ELSE 'completed' END AS processing_status",
    "o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 72) AS first_seen_at",
    "c_nationkey AS subreddit_id",
]

COMMENTS = [
    "'c' || l_orderkey || '-' || l_linenumber AS id",
    "l_orderkey || '-' || l_linenumber AS reddit_id",
    "l_returnflag || chr(10) || 'part ' || l_partkey || ' by ' || l_suppkey || ', ' || l_linestatus || '.' AS body",
    "CASE WHEN l_suppkey % 20 = 0 THEN '[deleted]' WHEN l_suppkey % 33 = 0 THEN NULL ELSE 'u/' || l_suppkey END AS author",
    "l_shipdate AS created_utc",
    "CAST(l_quantity AS INTEGER) - 25 AS score",
    "CASE WHEN l_linenumber = 1 THEN 't3_' || l_orderkey ELSE 't1_' || l_orderkey || '-' || CAST(floor(l_linenumber * 0.5) AS BIGINT) END AS parent_id",
    "'t3_' || l_orderkey AS link_id",
    "0 AS depth",
    "l_suppkey % 10 = 1 AS is_submitter",
    "l_linenumber = 7 AS is_stickied",
    "CASE WHEN l_tax = 0.08 THEN 'moderator' END AS distinguished",
    "CASE WHEN l_discount = 0 THEN l_shipdate + INTERVAL 1 DAY END AS edited",
    "'pending' AS processing_status",
    "CAST(l_orderkey AS STRING) AS submission_id",
    "l_shipdate + INTERVAL 1 HOUR * (l_partkey % 72) AS first_seen_at",
    "CAST(l_linenumber AS BIGINT) AS ord",
]
# The stored comments: an id that is unique in the table, so that reads need no dedupe.
STORED_ID = (
    "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || "
    "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
)
STORED_COMMENTS = [f"'c' || {STORED_ID} AS id", f"{STORED_ID} AS reddit_id", *COMMENTS[2:]]
# First of all copies of a comment id, in this order of the raw columns.
FIRST_COPY = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]

SESSIONS = [
    "'sess-' || event_id AS id",
    "'task-' || (event_id % 97) AS task_id",
    "CASE event_id % 5 WHEN 0 THEN 'manual' WHEN 1 THEN 'reprocess' ELSE 'scheduled' END AS task_type",
    "CAST(user_id % 25 AS INTEGER) AS subreddit_id",
    "substring('hntrcs', CAST(event_id % 6 AS INTEGER) + 1, 1) AS category",
    "CAST(event_id % 100 AS INTEGER) AS n_results",
    "CASE WHEN event_id % 6 = 5 THEN 'kw' || (event_id % 11) END AS keywords",
    "CASE event_id % 6 WHEN 2 THEN 'day' WHEN 4 THEN 'fortnight' WHEN 5 THEN 'month' END AS time_filter",
    "CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'success' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'pending' END AS status",
    "ts AS started_at",
    "CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN ts + INTERVAL 1 SECOND * CAST(floor(value) AS BIGINT) END AS completed_at",
    "CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN CAST(floor(value) AS INTEGER) END AS duration_seconds",
    "CAST(user_id % 50 AS INTEGER) AS submissions_found",
    "CAST(user_id % 37 AS INTEGER) AS submissions_scraped",
    "CASE WHEN event_type <> 'view' THEN CAST(event_id % 200 AS INTEGER) END AS comments_scraped",
    "CASE WHEN event_type = 'error' THEN props END AS error_message",
]

QUEUE = [
    "'q-' || event_id AS id",
    "CASE event_id % 2 WHEN 0 THEN 'submission' ELSE 'comment' END AS content_type",
    "CASE event_id % 2 WHEN 0 THEN 's' || event_id ELSE 'c' || event_id || '-1' END AS content_id",
    "CASE event_id % 2 WHEN 0 THEN CAST(event_id AS STRING) ELSE event_id || '-1' END AS reddit_id",
    "CAST(event_id % 3 AS INTEGER) AS priority",
    "CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'processing' WHEN 'error' THEN 'failed' ELSE 'completed' END AS processing_status",
    "CASE WHEN user_id % 4 > 0 THEN 'worker-' || (user_id % 4) END AS processor_name",
    "ts AS queued_at",
    "CASE WHEN event_type <> 'click' THEN ts + INTERVAL 1 MINUTE END AS started_processing_at",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN ts + INTERVAL 2 MINUTE END AS completed_at",
    "CAST(event_id % 5 AS INTEGER) AS retry_count",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN props END AS processing_result",
]

QUEUE_LOG = [
    "'q-' || (event_id - event_id % 4) AS item_id",
    "event_id AS seq",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'complete' WHEN event_type = 'error' THEN 'note' ELSE 'claim' END AS action",
    "'worker-' || (user_id % 7) AS processor",
    "ts AS at",
    "CASE WHEN event_type = 'purchase' THEN props END AS result",
]

SESSION_LOG = [
    "'sess-' || (event_id - event_id % 5) AS session_id",
    "event_id AS seq",
    "ts AS at",
    "CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'pending' WHEN 'error' THEN 'failed' ELSE 'success' END AS status",
    "CASE WHEN event_type <> 'click' THEN CAST(user_id AS INTEGER) END AS submissions_found",
    "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 1000 AS INTEGER) END AS comments_scraped",
    "CASE WHEN event_type = 'error' THEN props END AS error_message",
]

METRICS = [
    "'m-' || event_id AS id",
    "'sess-' || (event_id - event_id % 5) AS session_id",
    "event_type AS metric_name",
    "'seconds' AS metric_unit",
    "value AS metric_value",
    "ts AS recorded_at",
]

# Turn t answers turn (t - 1) / 2. Every 7th thread has a reply to a missing
# comment, and every 11th (offset 3) has a circle of two replies.
THREADS = [
    "'t3_' || conv_id AS link_id",
    "CAST(conv_id * 1000 + turn AS STRING) AS reddit_id",
    """CASE WHEN turn = 0 THEN 't3_' || conv_id
        WHEN turn = 1 AND conv_id % 7 = 0 THEN 't1_missing' || conv_id
        WHEN turn = 2 AND conv_id % 11 = 3 THEN 't1_' || (conv_id * 1000 + 5)
        ELSE 't1_' || (conv_id * 1000 + CAST(floor((turn - 1) * 0.5) AS BIGINT)) END AS parent_id""",
    "turn AS ord",
    "role AS author",
    "text AS body",
]

OBJECTS = [
    """CASE page_id % 5 WHEN 0 THEN 'daily_scrapes' WHEN 1 THEN 'hourly_hot_scrapes' WHEN 2 THEN 'weekly_scrapes'
        WHEN 3 THEN 'manual_scrapes' ELSE 'other' END
        || regexp_replace(url, '^https?://[^/]+', '') || '/' || page_id || '.zip' AS key""",
    "CAST(length(html) AS BIGINT) AS size",
    "CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL 1 HOUR * (page_id % 240) AS last_modified",
    "CASE WHEN page_id % 6 > 0 THEN 'application/zip' END AS content_type",
]

ARCHIVES = [
    """CASE page_id % 5 WHEN 0 THEN 'daily_scrapes' WHEN 1 THEN 'hourly_hot_scrapes' WHEN 2 THEN 'weekly_scrapes'
        WHEN 3 THEN 'manual_scrapes' ELSE 'other' END
        || regexp_replace(url, '^https?://[^/]+', '') || '/' || page_id || '.zip' AS r2_object_key""",
    "CASE WHEN page_id % 3 > 0 THEN '{\"page\":' || page_id || '}' END AS upload_metadata",
]

CONFIGS = [
    "c_custkey AS config_id",
    "'NATION_' || c_nationkey AS name",
    "substring('hntrcs', CAST(c_custkey % 6 AS INTEGER) + 1, 1) AS category",
    "CASE WHEN c_custkey % 6 IN (2, 4, 5) THEN 'week' END AS time_filter",
    "CAST(c_custkey % 100 AS INTEGER) AS n_results",
    "CASE WHEN c_custkey % 6 = 5 THEN 'cash back ' || c_mktsegment END AS keywords",
    "CASE WHEN c_custkey % 9 > 0 THEN c_acctbal > 0 END AS enabled",
    "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS schedule",
    "c_custkey % 4 = 0 AS is_manual",
]

REQUESTS = [
    "c_custkey AS request_id",
    "'NATION_' || (c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 20 ELSE 0 END) AS name",
    "substring('hNtrcSXq', CAST(c_custkey % 8 AS INTEGER) + 1, 1) AS category",
    "CASE c_custkey % 7 WHEN 0 THEN '0' WHEN 1 THEN 'abc' WHEN 2 THEN '1_0' WHEN 3 THEN '+5' ELSE CAST(c_custkey AS STRING) END AS n_results",
    "CASE c_custkey % 5 WHEN 0 THEN 'day' WHEN 1 THEN 'Decade' WHEN 2 THEN 'ALL' END AS time_filter",
]

COMMENT_FILES = [
    "'scrapes/' || CAST(CAST(l_shipdate AS DATE) AS STRING) || '/comments/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '.json' AS path",
    "CAST(l_shipdate AS DATE) AS scrape_date",
    "CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'https://www.reddit.com/r/n/comments/' || l_orderkey || '/t/' END AS url",
    "'/r/n/comments/' || l_orderkey || '/t/' AS permalink",
]


def _select(expressions: list[str], source: str) -> str:
    return f"SELECT {', '.join(expressions)} FROM {source}"


_FIRST = (
    "(SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    + ", ".join(FIRST_COPY)
    + ") = 1)"
)

SQL_TABLES = {
    "subreddits": _select(SUBREDDITS, "nation"),
    "submissions": _select(SUBMISSIONS, "orders JOIN customer ON o_custkey = c_custkey"),
    "comments": _select(COMMENTS, _FIRST),
    "raw_comments": _select(COMMENTS, "lineitem"),
    "stored_comments": _select(STORED_COMMENTS, "lineitem"),
    "sessions": _select(SESSIONS, "events"),
    "queue": _select(QUEUE, "events"),
    "queue_log": _select(QUEUE_LOG, "events"),
    "session_log": _select(SESSION_LOG, "events"),
    "metrics": _select(METRICS, "events"),
    "threads": _select(THREADS, "conversations"),
    "objects": _select(OBJECTS, "pages"),
    "archives": _select(ARCHIVES, "pages"),
    "configs": _select(CONFIGS, "customer"),
    "requests": _select(REQUESTS, "customer"),
    "comment_files": _select(COMMENT_FILES, "lineitem"),
}


def with_tables(sql: str) -> str:
    """Prefix the bound tables a statement uses as common table expressions."""
    used = [t for t in SQL_TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", sql)]
    ctes = [f"{t} AS ({SQL_TABLES[t]})" for t in used]
    head = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    recursive = "RECURSIVE " if head and head.group(1) else ""
    if head:
        ctes.append(sql[head.end():])
        return f"WITH {recursive}" + ", ".join(ctes)
    return (f"WITH {', '.join(ctes)} " if ctes else "") + sql


class Tables:
    """The bound tables of one data folder. Everything is lazy."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def stored(self, name: str) -> DataFrame:
        return parquet_table(self.spark, self.folder, name)

    @cached_property
    def subreddits(self) -> DataFrame:
        return self.stored("nation").selectExpr(*SUBREDDITS)

    @cached_property
    def submissions(self) -> DataFrame:
        orders, customer = self.stored("orders"), self.stored("customer")
        return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).selectExpr(*SUBMISSIONS)

    @cached_property
    def posts(self) -> DataFrame:
        """Submissions without what needs the author's community."""
        return self.stored("orders").selectExpr(*[e for e in SUBMISSIONS if "c_nationkey" not in e])

    @cached_property
    def raw_comments(self) -> DataFrame:
        return self.stored("lineitem").selectExpr(*COMMENTS)

    @cached_property
    def stored_comments(self) -> DataFrame:
        """Comments as a load has left them: unique by id, filters and limits reach the scan."""
        return self.stored("lineitem").selectExpr(*STORED_COMMENTS)

    @cached_property
    def comments(self) -> DataFrame:
        """The raw feed with one row per comment id."""
        order = [F.asc(c) for c in FIRST_COPY]
        return keep_first(self.stored("lineitem"), ["l_orderkey", "l_linenumber"], order).selectExpr(*COMMENTS)

    def _bound(self, name: str, expressions: list[str]) -> DataFrame:
        return self.stored(name).selectExpr(*expressions)

    @cached_property
    def sessions(self) -> DataFrame:
        return self._bound("events", SESSIONS)

    @cached_property
    def queue(self) -> DataFrame:
        return self._bound("events", QUEUE)

    @cached_property
    def queue_log(self) -> DataFrame:
        return self._bound("events", QUEUE_LOG)

    @cached_property
    def session_log(self) -> DataFrame:
        return self._bound("events", SESSION_LOG)

    @cached_property
    def metrics(self) -> DataFrame:
        return self._bound("events", METRICS)

    @cached_property
    def threads(self) -> DataFrame:
        return self._bound("conversations", THREADS)

    @cached_property
    def objects(self) -> DataFrame:
        return self._bound("pages", OBJECTS)

    @cached_property
    def archives(self) -> DataFrame:
        return self._bound("pages", ARCHIVES)

    @cached_property
    def configs(self) -> DataFrame:
        return self._bound("customer", CONFIGS)

    @cached_property
    def requests(self) -> DataFrame:
        return self._bound("customer", REQUESTS)

    @cached_property
    def comment_files(self) -> DataFrame:
        return self._bound("lineitem", COMMENT_FILES)

    @cached_property
    def documents(self) -> DataFrame:
        return self.stored("documents")


def newest(table: DataFrame, time: str) -> Column:
    """The latest time of a table: stands for the clock."""
    return table.agg(F.max(time)).scalar()
