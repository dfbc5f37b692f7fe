"""Read questions: recent, top, search, author, queue, sessions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import like_pattern
from .stats import comments_of, comments_per_submission
from .views import in_subreddit, with_subreddit

# Length of a listing's time filter.
TIME_FILTER_SPAN = {
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 30 DAYS",
    "year": "INTERVAL 365 DAYS",
    "all": None,
}


def since(time: str, as_of: Column, span: str) -> Column:
    return F.col(time) >= as_of - F.expr(span)


def recent_submissions(
    submissions: DataFrame,
    subreddits: DataFrame,
    as_of: Column,
    days: int = 7,
    subreddit: str | None = None,
    limit: int = 100,
) -> DataFrame:
    rows = submissions.where(since("created_utc", as_of, f"INTERVAL {days} DAYS"))
    rows = in_subreddit(rows, subreddits, subreddit)
    return rows.orderBy(F.desc("created_utc"), F.asc("reddit_id")).limit(limit)


def top_submissions_by_score(
    submissions: DataFrame,
    subreddits: DataFrame,
    as_of: Column,
    days: int = 7,
    subreddit: str | None = None,
    limit: int = 50,
) -> DataFrame:
    rows = submissions.where(since("created_utc", as_of, f"INTERVAL {days} DAYS"))
    rows = in_subreddit(rows, subreddits, subreddit)
    return rows.orderBy(F.desc_nulls_first("score"), F.asc("reddit_id")).limit(limit)


def matches_any(keywords: Sequence[str], columns: Sequence[str], literal: bool = False) -> Column:
    """Any keyword in any of the columns, case-insensitive; no keyword is no filter."""
    tests = [F.col(c).ilike(like_pattern(k, literal)) for k in keywords for c in columns]
    return reduce(or_, tests) if tests else F.lit(True)


def keyword_search(
    submissions: DataFrame,
    subreddits: DataFrame,
    keywords: Sequence[str],
    subreddit: str | None = None,
    limit: int = 100,
    literal: bool = False,
) -> DataFrame:
    rows = submissions.where(matches_any(keywords, ["title", "selftext"], literal))
    rows = in_subreddit(rows, subreddits, subreddit)
    return rows.orderBy(F.desc_nulls_first("score"), F.asc("reddit_id")).limit(limit)


def title_search(
    submissions: DataFrame, subreddits: DataFrame, comments: DataFrame, term: str, literal: bool = False
) -> DataFrame:
    """Titles with the term by score, with community and comment count."""
    found = submissions.where(matches_any([term], ["title"], literal))
    counted = comments_per_submission(found, comments_of(found, comments))
    return with_subreddit(counted, subreddits).orderBy(F.desc_nulls_first("score"), F.asc("reddit_id"))


def by_author(content: DataFrame, author: str, limit: int = 100) -> DataFrame:
    rows = content.where(F.col("author") == author)
    return rows.orderBy(F.desc("created_utc"), F.asc("reddit_id")).limit(limit)


def author_activity(
    submissions: DataFrame, comments: DataFrame, author: str, content: str = "both", limit: int = 100
) -> DataFrame:
    """Newest ``limit`` submissions and comments of an author, one column telling which."""
    shape = ["reddit_id", "author", "created_utc", "score"]
    parts = []
    if content in ("submissions", "both"):
        parts.append(by_author(submissions.select(*shape), author, limit).withColumn("content_type", F.lit("submission")))
    if content in ("comments", "both"):
        parts.append(by_author(comments.select(*shape), author, limit).withColumn("content_type", F.lit("comment")))
    return reduce(DataFrame.unionByName, parts)


def point_lookup(table: DataFrame, reddit_id: str) -> DataFrame:
    return table.where(F.col("reddit_id") == reddit_id).limit(1)


def recent_posts(submissions: DataFrame, limit: int = 5) -> DataFrame:
    """Shown when an id is not found."""
    return submissions.orderBy(F.desc("first_seen_at"), F.asc("reddit_id")).limit(limit)


def post_or_recent(submissions: DataFrame, reddit_id: str, limit: int = 5) -> DataFrame:
    """The post, or the newest posts when there is none with this id."""
    match = submissions.where(F.col("reddit_id") == reddit_id)
    missing = match.limit(1).agg(F.count("*").alias("n")).select(F.col("n") == 0)
    return match.limit(1).unionByName(recent_posts(submissions.where(missing.scalar()), limit))


def pending_queue(
    queue: DataFrame, processor: str | None = None, content_type: str | None = None, limit: int = 100
) -> DataFrame:
    rows = queue.where(F.col("processing_status") == "pending")
    if processor:
        rows = rows.where(F.col("processor_name") == processor)
    if content_type:
        rows = rows.where(F.col("content_type") == content_type)
    order = [F.desc_nulls_first("priority"), F.asc_nulls_last("queued_at"), F.asc("id")]
    return rows.orderBy(*order).limit(limit)


def session_history(sessions: DataFrame, as_of: Column, days: int = 30, limit: int = 100) -> DataFrame:
    rows = sessions.where(since("started_at", as_of, f"INTERVAL {days} DAYS"))
    return rows.orderBy(F.desc("started_at"), F.asc("id")).limit(limit)


def latest(table: DataFrame, time: str, limit: int, key: str = "reddit_id") -> DataFrame:
    return table.orderBy(F.desc(time), F.asc(key)).limit(limit)


def exclude_deleted(content: DataFrame) -> DataFrame:
    """SQL inequality: rows without an author go too."""
    return content.where(F.col("author") != "[deleted]")


def listing_new(submissions: DataFrame, subreddits: DataFrame, subreddit: str, n: int) -> DataFrame:
    rows = in_subreddit(submissions, subreddits, subreddit)
    return rows.orderBy(F.desc("created_utc"), F.asc("reddit_id")).limit(n)


def within(submissions: DataFrame, as_of: Column, time_filter: str) -> DataFrame:
    span = TIME_FILTER_SPAN[time_filter]
    return submissions.where(since("created_utc", as_of, span)) if span else submissions


def listing_top(
    submissions: DataFrame, subreddits: DataFrame, subreddit: str, n: int, as_of: Column, time_filter: str = "all"
) -> DataFrame:
    rows = in_subreddit(within(submissions, as_of, time_filter), subreddits, subreddit)
    return rows.orderBy(F.desc_nulls_first("score"), F.asc("reddit_id")).limit(n)


def listing_search(
    submissions: DataFrame,
    subreddits: DataFrame,
    subreddit: str,
    keywords: str,
    as_of: Column,
    time_filter: str = "all",
    limit: int = 100,
) -> DataFrame:
    rows = within(submissions, as_of, time_filter)
    return keyword_search(rows, subreddits, keywords.split(), subreddit, limit)


def configs_by(configs: DataFrame, predicate: Column) -> DataFrame:
    """Enabled scheduled configs that satisfy a condition on their columns."""
    return enabled_configs(configs).where(predicate)


def enabled_configs(configs: DataFrame, manual: bool = False) -> DataFrame:
    """Enabled configs that have a schedule, or the enabled manual ones.

    A scheduled config is off unless enabled; a manual one is on unless disabled.
    """
    if manual:
        return configs.where(F.col("is_manual") & F.coalesce("enabled", F.lit(True)))
    return configs.where(~F.col("is_manual") & F.coalesce("enabled", F.lit(False)) & F.col("schedule").isNotNull())


def unique_subreddits(configs: DataFrame) -> DataFrame:
    return enabled_configs(configs).select("name").distinct()
