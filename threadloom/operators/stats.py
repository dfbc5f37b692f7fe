"""Aggregates per post, community, author and run, and per-group listings.

Counts over comments are aggregated before they are joined, so a join sees one
row per post or community, however many comments it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import null_to_zero, score_band
from .ranking import in_pages, number_rows, top_per_group


def comments_per_submission(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    counts = comments.groupBy(F.col("submission_id").alias("reddit_id")).agg(F.count("*").alias("comment_count"))
    joined = submissions.join(counts, "reddit_id", "left")
    return joined.withColumn("comment_count", null_to_zero("comment_count"))


def comments_of(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """The comments of a few posts, before anything is counted."""
    ids = submissions.select(F.col("reddit_id").alias("submission_id"))
    return comments.join(ids, "submission_id", "left_semi")


def submissions_with_comments(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Submissions that have at least one comment."""
    ids = comments.select(F.col("submission_id").alias("reddit_id")).distinct()
    return submissions.join(ids, "reddit_id", "left_semi")


def post_comment_stats(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Counts by score band and score range per post; zeros without comments."""
    score = F.col("score")
    stats = comments.groupBy(F.col("submission_id").alias("reddit_id")).agg(
        F.count("*").alias("total_comments"),
        F.count_if(score >= 10).alias("high_score_comments"),
        F.count_if((score >= 1) & (score < 10)).alias("medium_score_comments"),
        F.count_if(score < 1).alias("low_score_comments"),
        F.max("score").alias("highest_score"),
        F.min("score").alias("lowest_score"),
        F.avg("score").alias("average_score"),
    )
    names = [c for c in stats.columns if c != "reddit_id"]
    joined = submissions.select("reddit_id").join(stats, "reddit_id", "left")
    return joined.select("reddit_id", *[null_to_zero(c).alias(c) for c in names])


def subreddit_stats(
    subreddits: DataFrame,
    submissions: DataFrame,
    comments: DataFrame,
    as_of: Column,
    subreddit: str | None = None,
) -> DataFrame:
    """Activity of every community, or of one; empty communities keep zeros."""
    wanted = subreddits if subreddit is None else subreddits.where(F.col("name") == subreddit)
    posts = submissions.groupBy("subreddit_id").agg(
        F.count("*").alias("total_submissions"),
        F.avg("score").alias("avg_score"),
        F.max("score").alias("max_score"),
        F.count_if(F.col("created_utc") >= as_of - F.expr("INTERVAL 7 DAYS")).alias("recent_submissions_7d"),
    )
    # Distinct authors in two map-combined steps, apart from the plain sums.
    authors = (
        submissions.where(F.col("author").isNotNull())
        .select("subreddit_id", "author")
        .distinct()
        .groupBy("subreddit_id")
        .agg(F.count("*").alias("unique_authors"))
    )
    replies = _placed(comments, submissions).agg(
        F.sum("n").alias("total_comments"), (F.sum("total") / F.sum("scored")).alias("avg_comment_score")
    )
    base = wanted.select(F.col("id").alias("subreddit_id"), F.col("name").alias("subreddit"))
    joined = reduce(lambda a, b: a.join(b, "subreddit_id", "left"), [posts, authors, replies], base)
    names = [
        "total_submissions", "avg_score", "max_score", "unique_authors", "total_comments",
        "avg_comment_score", "recent_submissions_7d",
    ]
    return joined.select("subreddit", *[null_to_zero(c).alias(c) for c in names])


def _placed(comments: DataFrame, submissions: DataFrame):
    """Comments added up per post, then placed in the post's community: the join sees one row per post."""
    per_post = comments.groupBy("submission_id").agg(
        F.count("*").alias("n"), F.sum("score").alias("total"), F.count("score").alias("scored")
    )
    places = submissions.select(F.col("reddit_id").alias("submission_id"), "subreddit_id")
    return per_post.join(places, "submission_id").groupBy("subreddit_id")


def comments_per_subreddit(subreddits: DataFrame, submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments per community, largest first; communities without any stay with 0."""
    counts = _placed(comments, submissions).agg(F.sum("n").alias("comment_count"))
    joined = subreddits.join(counts, subreddits["id"] == counts["subreddit_id"], "left")
    return joined.select("name", null_to_zero("comment_count").alias("comment_count")).orderBy(F.desc("comment_count"), F.asc("name"))


def per_subreddit(subreddits: DataFrame, content: DataFrame, count: str) -> DataFrame:
    """Rows per community, largest first; communities without rows stay with 0."""
    counts = content.groupBy("subreddit_id").agg(F.count("*").alias(count))
    joined = subreddits.join(counts, subreddits["id"] == counts["subreddit_id"], "left")
    return joined.select("name", null_to_zero(count).alias(count)).orderBy(F.desc(count), F.asc("name"))


def ranked_listing(listing: DataFrame, count: str) -> DataFrame:
    """1-based positions in a listing."""
    return number_rows(listing, [], [F.desc(count), F.asc("name")])


def top_comment_authors(comments: DataFrame, limit: int = 5) -> DataFrame:
    named = comments.where(F.col("author") != "[deleted]")
    counts = named.groupBy("author").agg(F.count("*").alias("comment_count"))
    return counts.orderBy(F.desc("comment_count"), F.asc("author")).limit(limit)


def top_commenters_per_post(comments: DataFrame, k: int = 3) -> DataFrame:
    """Most active authors per post; a missing author counts as one, the deleted mark does not."""
    shown = comments.where(~F.col("author").eqNullSafe("[deleted]"))
    counts = shown.groupBy("submission_id", "author").agg(F.count("*").alias("comments"))
    return top_per_group(counts, ["submission_id"], [F.desc("comments"), F.asc_nulls_first("author")], k, "position")


def global_average_scores(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    one = submissions.agg(F.avg("score").alias("average_score")).withColumn("kind", F.lit("submissions"))
    two = comments.agg(F.avg("score").alias("average_score")).withColumn("kind", F.lit("comments"))
    return one.unionByName(two)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def latest_submissions_per_subreddit(submissions: DataFrame, comments: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` newest posts per community with their comment count; only their comments are counted."""
    top = top_per_group(submissions, ["subreddit_id"], [F.desc("first_seen_at"), F.asc("reddit_id")], k, "position")
    return comments_per_submission(top, comments_of(top, comments))


def top_comments_per_submission(comments: DataFrame, k: int) -> DataFrame:
    order = [F.desc_nulls_first("score"), F.asc("reddit_id")]
    return top_per_group(comments, ["submission_id"], order, k, "position")


def top_comments_with_total(comments: DataFrame, k: int = 5) -> DataFrame:
    """As above with the comment count of the post.

    The count is an aggregate of its own: a window count would pull all
    comments of a post into one task.
    """
    totals = comments.groupBy("submission_id").agg(F.count("*").alias("total_comments"))
    return top_comments_per_submission(comments, k).join(totals, "submission_id")


# How many comments a report shows per score band.
SHOWN_PER_BAND = {"high": 10, "medium": 5, "low": 3}


def banded_comment_preview(comments: DataFrame) -> DataFrame:
    """The earliest comments of every score band, 10, 5 or 3 of them."""
    banded = comments.withColumn("band", score_band("score"))
    most = max(SHOWN_PER_BAND.values())
    top = top_per_group(
        banded.where(F.col("band").isNotNull()),
        ["submission_id", "band"],
        [F.asc("created_utc"), F.asc("reddit_id")],
        most,
        "position",
    )
    shown = F.create_map(*[F.lit(v) for pair in SHOWN_PER_BAND.items() for v in pair])
    return top.where(F.col("position") <= shown[F.col("band")])


def comments_by_score(comments: DataFrame) -> DataFrame:
    """All comments of every post, best first, with their position."""
    return number_rows(comments, ["submission_id"], [F.desc_nulls_first("score"), F.asc("reddit_id")])


def comments_by_time(comments: DataFrame) -> DataFrame:
    """All comments of every post, oldest first."""
    return comments.orderBy("submission_id", "created_utc", "reddit_id")


def nested_comments(submissions: DataFrame, comments: DataFrame, fields: list[str], page_size: int) -> DataFrame:
    """Comments of every post as pages of an ordered array; posts without any stay, with page 0."""
    pages = in_pages(
        comments.select(*dict.fromkeys(["submission_id", "created_utc", "reddit_id", *fields])),
        ["submission_id"],
        [F.asc("created_utc"), F.asc("reddit_id")],
        F.struct(*fields),
        "comments",
        page_size,
    )
    joined = submissions.join(pages, submissions["reddit_id"] == pages["submission_id"], "left")
    return joined.withColumn("page", null_to_zero("page")).drop("submission_id")


# The comment attributes of the full post document.
POST_COMMENT_FIELDS = [
    "reddit_id", "author", "body", "created_utc", "score", "parent_id", "depth", "is_submitter",
    "is_stickied", "distinguished", "edited",
]
POST_FIELDS = [
    "reddit_id", "title", "url", "permalink", "author", "created_utc", "score", "upvote_ratio",
    "num_comments", "selftext", "link_flair_text", "is_nsfw", "is_spoiler", "is_stickied",
    "is_locked", "is_original_content",
]


def full_post(
    submissions: DataFrame, subreddits: DataFrame, comments: DataFrame, page_size: int = 500
) -> DataFrame:
    """Post, community, statistics and ordered comments of every post."""
    names = subreddits.select(F.col("id").alias("subreddit_id"), F.col("name").alias("subreddit"))
    stats = post_comment_stats(submissions, comments)
    posts = (
        submissions.select(*POST_FIELDS, "subreddit_id")
        .join(names, "subreddit_id", "left")
        .withColumn("subreddit", F.coalesce("subreddit", F.lit("Unknown")))
        .join(stats, "reddit_id")
    )
    return nested_comments(posts, comments, POST_COMMENT_FIELDS, page_size)
