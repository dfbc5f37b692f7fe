"""Output views of the canonical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import content_flags, iso_time
from ..functions.text import one_line, preview, preview_if_longer

SUBMISSION_TEXT = [
    "id", "reddit_id", "title", "url", "permalink", "selftext", "author",
]
SUBMISSION_REST = [
    "score", "upvote_ratio", "num_comments", "is_self", "is_nsfw", "is_spoiler", "is_stickied",
    "link_flair_text",
]


def with_subreddit(df: DataFrame, subreddits: DataFrame) -> DataFrame:
    """Left join to the community table; rows without one keep a null name.

    Catalyst broadcasts the community table while it is small and otherwise
    shuffles, where adaptive execution splits a dominant community.
    """
    names = subreddits.select(F.col("id").alias("subreddit_id"), F.col("name").alias("subreddit"))
    return df.join(names, "subreddit_id", "left")


def in_subreddit(df: DataFrame, subreddits: DataFrame, name: str | None) -> DataFrame:
    """Rows of one named community; all rows when no name is given."""
    if name is None:
        return df
    wanted = subreddits.where(F.col("name") == name).select(F.col("id").alias("subreddit_id"))
    return df.join(wanted, "subreddit_id")


def submission_view(submissions: DataFrame, subreddits: DataFrame) -> DataFrame:
    """The 19 columns of the read API."""
    return with_subreddit(submissions, subreddits).select(
        *SUBMISSION_TEXT,
        iso_time("created_utc").alias("created_utc"),
        *SUBMISSION_REST,
        "subreddit",
        "processing_status",
        iso_time("first_seen_at").alias("first_seen_at"),
    )


def comment_view(comments: DataFrame) -> DataFrame:
    """The 13 columns of the read API."""
    return comments.select(
        "id", "reddit_id", "body", "author",
        iso_time("created_utc").alias("created_utc"),
        "score", "parent_id", "link_id", "depth", "is_submitter", "is_stickied",
        "processing_status", "submission_id",
    )


def session_view(sessions: DataFrame, subreddits: DataFrame) -> DataFrame:
    """The 16 columns of the read API."""
    return with_subreddit(sessions, subreddits).select(
        "id", "task_id", "task_type", "subreddit", "category", "n_results", "keywords",
        "time_filter", "status",
        iso_time("started_at").alias("started_at"),
        iso_time("completed_at").alias("completed_at"),
        "duration_seconds", "submissions_found", "submissions_scraped", "comments_scraped",
        "error_message",
    )


def queue_view(queue: DataFrame) -> DataFrame:
    """The 12 columns of the read API."""
    return queue.select(
        "id", "content_type", "content_id", "reddit_id", "priority", "processing_status",
        "processor_name",
        iso_time("queued_at").alias("queued_at"),
        iso_time("started_processing_at").alias("started_processing_at"),
        iso_time("completed_at").alias("completed_at"),
        "retry_count", "processing_result",
    )


def previews(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """The shortened texts the reports print, with the id of their record."""
    titles = submissions.select(
        "reddit_id",
        F.lit("title").alias("kind"),
        preview("title", 60).alias("short"),
        preview_if_longer("selftext", 500).alias("text"),
    )
    bodies = comments.select(
        "reddit_id",
        F.lit("body").alias("kind"),
        preview(one_line("body"), 100).alias("short"),
        preview_if_longer("body", 200).alias("text"),
    )
    return titles.unionByName(bodies)


def flag_list(submissions: DataFrame) -> DataFrame:
    return submissions.select("reddit_id", F.array_join(content_flags(), ", ").alias("flags"))


# Attributes a live feed shows, by kind of record.
SHOWN = {
    "submission": [
        "author", "created_utc", "link_flair_text", "nsfw", "selftext", "spoiler", "title", "url",
    ],
    "comment": ["author", "body", "created_utc", "is_submitter"],
}
SHOWN_OF_PARENT = [
    "author", "created_utc", "link_flair_text", "nsfw", "num_comments", "score", "title",
    "upvote_ratio", "url",
]


def display_fields(feed: DataFrame, keys: list[str], item: str = "item") -> DataFrame:
    """Attribute/value rows of a feed of VARIANT records.

    A comment also shows attributes of its submission, prefixed. A record
    without an attribute gives no row for it.
    """
    record = F.col(item)
    kind = F.try_variant_get(record, "$.type", "string")

    def rows(names: list[str], path: str, prefix: str) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(prefix + n).alias("attribute"),
                    F.try_variant_get(record, f"{path}.{n}", "string").alias("data"),
                    F.try_variant_get(record, f"{path}.{n}", "variant").isNotNull().alias("present"),
                )
                for n in names
            ]
        )

    shown = F.when(kind == "submission", rows(SHOWN["submission"], "$", "")).when(
        kind == "comment",
        F.concat(rows(SHOWN["comment"], "$", ""), rows(SHOWN_OF_PARENT, "$.submission", "submission_")),
    )
    return (
        feed.select(*keys, kind.alias("type"), F.inline(shown))
        .where("present")
        .drop("present")
        .orderBy(*keys, "attribute")
    )
