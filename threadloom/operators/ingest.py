"""Loads: dedupe, parent resolution, upserts, and the queue and session logs.

Rows are never updated in place. Every change is an event in an append-only
log, and the current state is a fold over the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import bare_id
from ..session import materialize
from .ranking import keep_first


def new_rows(batch: DataFrame, stored: DataFrame, order: Sequence[Column], key: str = "reddit_id") -> DataFrame:
    """Rows whose key is not stored yet, the first of each key in the batch.

    Copies go first, map side, so a key that fills a third of the batch is one
    row when it meets the stored keys.
    """
    first = keep_first(batch, [key], order)
    return first.join(stored.select(key), key, "left_anti")


def unstored(batch: DataFrame, stored: DataFrame, key: str = "reddit_id") -> DataFrame:
    """Rows whose key is not stored yet, copies included.

    Only keys meet the stored ones, so a load that mostly repeats earlier ones moves the few new rows.
    """
    keys = batch.select(key).distinct().join(stored.select(key), key, "left_anti")
    new = materialize(keys.withColumnRenamed(key, "__new"), "new-keys")
    return batch.join(new, batch[key].eqNullSafe(new["__new"]), "left_semi")


def comment_to_submission(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Take over the post and its community; comments of unknown posts go."""
    posts = submissions.select(
        F.col("reddit_id").alias("post"), F.col("id").alias("submission_row"), "subreddit_id"
    )
    keyed = comments.withColumn("post", bare_id("link_id"))
    return keyed.join(posts, "post").drop("post")


def comments_without_submission(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    posts = submissions.select(F.col("reddit_id").alias("post"))
    return comments.withColumn("post", bare_id("link_id")).join(posts, "post", "left_anti").drop("post")


def get_or_create_subreddits(known: DataFrame, requested: DataFrame) -> DataFrame:
    """Known communities plus one row per new name; new metadata fills known rows.

    ``requested`` has ``name``, metadata columns and ``seq``, the order of the
    requests: the last value that is not null wins, field by field. The id of a new
    community is a hash of its name, so a replay gives the same id.
    """
    fields = ["display_name", "description", "subscribers"]
    wanted = requested.groupBy("name").agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f"new_{f}") for f in fields]
    )
    joined = known.join(wanted, "name", "full_outer")
    created = F.col("id").isNull()
    values = {f: F.coalesce(F.col(f"new_{f}"), F.col(f)) for f in fields}
    values["display_name"] = F.coalesce("new_display_name", "display_name", F.when(created, F.col("name")))
    return joined.select(
        F.coalesce(F.col("id").cast("string"), F.sha2("name", 256)).alias("id"),
        "name",
        *[values[f].alias(f) for f in fields],
        created.alias("created"),
    )


def upsert_subreddit_metadata(known: DataFrame, updates: DataFrame, fields: Sequence[str], as_of: Column) -> DataFrame:
    """Overwrite with non-null changed values; stamp the rows that changed.

    ``updates`` has one row per name and the same ``fields``.
    """
    new = updates.select("name", *[F.col(f).alias(f"new_{f}") for f in fields])
    joined = known.join(new, "name", "left")
    changes = [F.col(f"new_{f}").isNotNull() & ~F.col(f"new_{f}").eqNullSafe(F.col(f)) for f in fields]
    changed = changes[0]
    for c in changes[1:]:
        changed = changed | c
    other = [c for c in known.columns if c not in [*fields, "last_scraped_at", "name"]]
    return joined.select(
        "name",
        *other,
        *[F.coalesce(f"new_{f}", f).alias(f) for f in fields],
        F.when(changed, as_of).otherwise(F.col("last_scraped_at")).alias("last_scraped_at"),
    )


def session_state(log: DataFrame) -> DataFrame:
    """Current state of every session from its event log.

    Log: ``session_id, seq, at, status`` and result fields, null where an event
    says nothing. ``seq`` orders the events of a session.
    """
    ended = F.col("status").isin("success", "failed")
    seq = F.col("seq")

    def last(value: Column) -> Column:
        return F.max_by(value, F.when(value.isNotNull(), seq))

    folded = log.groupBy("session_id").agg(
        F.max_by("status", "seq").alias("status"),
        F.max(F.when(F.col("status") == "running", F.col("at"))).alias("started_at"),
        F.max(F.when(ended, F.col("at"))).alias("completed_at"),
        last(F.col("submissions_found")).alias("submissions_found"),
        last(F.col("comments_scraped")).alias("comments_scraped"),
        last(F.col("error_message")).alias("error_message"),
        F.count("*").alias("events"),
    )
    micros = F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return folded.withColumn("duration_seconds", (micros / 1_000_000).cast("int"))


# Queue priority by kind of content.
PRIORITY = {"submission": 1, "comment": 0}


def enqueue(new: DataFrame, content_type: str, as_of: Column, processor: str | None = None) -> DataFrame:
    """One pending queue row per new item; the id is a hash, so a replay adds nothing."""
    return new.select(
        F.sha2(F.concat_ws(":", F.lit(content_type), "reddit_id"), 256).alias("id"),
        F.lit(content_type).alias("content_type"),
        F.col("id").alias("content_id"),
        "reddit_id",
        F.lit(PRIORITY[content_type]).alias("priority"),
        F.lit("pending").alias("processing_status"),
        F.lit(processor).cast("string").alias("processor_name"),
        as_of.alias("queued_at"),
    )


def claim_if_pending(queue: DataFrame, log: DataFrame) -> DataFrame:
    """Every claim with its outcome: only the first change of a pending item wins.

    Queue: ``id, processing_status``. Log: ``item_id, seq, action, processor``.
    The first change is one aggregated row per item before it meets the claims.
    """
    first = log.where(F.col("action").isin("claim", "complete")).groupBy("item_id").agg(F.min("seq").alias("first_seq"))
    pending = queue.where(F.col("processing_status") == "pending").select(F.col("id").alias("item_id"))
    winner = first.join(pending, "item_id").select("item_id", F.col("first_seq").alias("seq"), F.lit(True).alias("claimed"))
    claims = log.where(F.col("action") == "claim").select("item_id", "seq", "processor")
    return claims.join(winner, ["item_id", "seq"], "left").withColumn("claimed", F.coalesce("claimed", F.lit(False)))


def claim_unconditional(queue: DataFrame, log: DataFrame) -> DataFrame:
    """Owner of every claimed item when each claim overwrites the one before."""
    owner = (
        log.where(F.col("action") == "claim")
        .groupBy("item_id")
        .agg(F.max_by("processor", "seq").alias("processor_name"), F.max("at").alias("started_processing_at"))
    )
    return queue.select(F.col("id").alias("item_id")).join(owner, "item_id")


def complete_items(queue: DataFrame, log: DataFrame) -> DataFrame:
    """Completed items; the newest non-null result wins over the stored one."""
    result = F.col("result")
    done = (
        log.where(F.col("action") == "complete")
        .groupBy("item_id")
        .agg(
            F.max("at").alias("completed_at"),
            F.max_by(result, F.when(result.isNotNull(), F.col("seq"))).alias("new_result"),
        )
    )
    stored = queue.select(F.col("id").alias("item_id"), "processing_result")
    return stored.join(done, "item_id").select(
        "item_id",
        F.lit("completed").alias("processing_status"),
        "completed_at",
        F.coalesce("new_result", "processing_result").alias("processing_result"),
    )


def queue_with_content(queue: DataFrame, submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Queue items with the record they point at."""
    posts = submissions.select(
        F.lit("submission").alias("content_type"), "reddit_id", F.col("title").alias("text"), "author", "score"
    )
    replies = comments.select(
        F.lit("comment").alias("content_type"), "reddit_id", F.col("body").alias("text"), "author", "score"
    )
    return queue.join(posts.unionByName(replies), ["content_type", "reddit_id"], "left")


def queue_health(queue: DataFrame, as_of: Column, max_retries: int = 3) -> DataFrame:
    """Items, oldest age and exhausted retries by status and processor."""
    waiting = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("queued_at").cast("timestamp"))
    return queue.groupBy("processing_status", "processor_name").agg(
        F.count("*").alias("items"),
        F.max(F.floor(waiting / 1_000_000)).alias("oldest_seconds"),
        F.count_if(F.col("retry_count") >= max_retries).alias("exhausted"),
    )


def expired(queue: DataFrame, metrics: DataFrame, sessions: DataFrame, as_of: Column) -> DataFrame:
    """Rows past their suggested retention."""

    def before(time: str, span: str) -> Column:
        return F.col(time) < as_of - F.expr(span)

    done = F.col("processing_status") == "completed"
    parts = [
        queue.where(done & before("completed_at", "INTERVAL 30 DAYS")).select(F.lit("processing_queue").alias("table_name"), "id"),
        metrics.where(before("recorded_at", "INTERVAL 90 DAYS")).select(F.lit("task_metrics").alias("table_name"), "id"),
        sessions.where(before("started_at", "INTERVAL 365 DAYS")).select(F.lit("scrape_sessions").alias("table_name"), "id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ingest_batch(
    submission_docs: DataFrame,
    comment_docs: DataFrame,
    stored_submissions: DataFrame,
    stored_comments: DataFrame,
    as_of: Column,
    order: Sequence[str] = ("created_utc",),
    comment_order: Sequence[str] | None = None,
    session_id: str = "load",
) -> dict[str, DataFrame]:
    """A whole load: new submissions, their new comments, queue rows, rejects, totals, session events.

    Inputs carry ``reddit_id, id`` and, for comments, ``link_id``; submissions
    also ``subreddit_id``. Each input is deduped and looked up once, into a table
    that all parts read, so they hold the same copies: ties in ``order`` are broken by
    the row's content. Nothing is stored here, so a caller can write every
    part under its own batch id and repeat it safely.
    """
    by = lambda df, columns: [*[F.asc(c) for c in columns], F.xxhash64(*df.columns)]
    submissions = new_rows(submission_docs, stored_submissions, by(submission_docs, order))
    submissions = materialize(submissions, "load-submissions")
    known = ["reddit_id", "id", "subreddit_id"]
    posts = stored_submissions.select(*known).unionByName(submissions.select(*known))
    posts = posts.select(F.col("reddit_id").alias("post"), F.col("id").alias("submission_row"), "subreddit_id")
    comment_order = order if comment_order is None else comment_order
    first = new_rows(comment_docs, stored_comments, by(comment_docs, comment_order)).withColumn("post", bare_id("link_id"))
    placed = materialize(first.join(posts, "post", "left").drop("post"), "load-comments")
    comments = placed.where("submission_row IS NOT NULL")
    rejected = placed.where("submission_row IS NULL").drop("submission_row", "subreddit_id")
    queue = enqueue(submissions, "submission", as_of).unionByName(enqueue(comments, "comment", as_of))
    totals = submission_docs.agg(F.count("*").alias("submissions_found")).select(
        "submissions_found",
        submissions.agg(F.count("*")).scalar().alias("submissions_scraped"),
        comments.agg(F.count("*")).scalar().alias("comments_scraped"),
    )
    at = as_of.cast("timestamp")
    nothing, words = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    names = ["session_id", "seq", "at", "status", "submissions_found", "comments_scraped", "error_message"]
    event = lambda *values: F.struct(*[v.alias(n) for v, n in zip(values, names[1:], strict=True)])
    began = event(F.lit(1), at, F.lit("running"), nothing, nothing, words)
    lost = rejected.agg(F.count("*")).scalar()
    note = F.when(lost > 0, F.concat(lost.cast("string"), F.lit(" comments without a submission")))
    ended = event(F.lit(2), at, F.lit("success"), F.col("submissions_found"), F.col("comments_scraped"), note)
    events = totals.select(F.lit(session_id), F.inline(F.array(began, ended))).toDF(*names)
    return {
        "submissions": submissions, "comments": comments, "queue": queue, "rejected": rejected, "totals": totals, "events": events,
    }
