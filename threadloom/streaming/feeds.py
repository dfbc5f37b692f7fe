"""Live feeds: selection, storage, statistics, incremental load, word counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.scalars import bare_id, duration_hms
from ..operators.ingest import enqueue
from ..operators.ranking import keep_first
from ..operators.words import mixed_words
from ..session import is_folder, materialize
from ..sinks.writers import overwrite_batch

# State of joins and dedupes: on the executors' disks, with its changes in the checkpoint.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A commit writes the changes of its batch; whole snapshots of the state follow in the background.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# One store a task for both sides of a join, not four, each with its own commit.
JOIN_FORMAT = "spark.sql.streaming.join.stateFormatVersion"

# To count its rows, a store looks every key up before it writes it; without, progress reports give no total.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"

MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _reader(spark: SparkSession, schema, files_per_trigger: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def parquet_feed(
    spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Files that arrive in a folder; at most ``files_per_trigger`` of them, or about ``bytes_per_trigger``, per micro-batch.

    Every batch of a stateful stream opens and commits all its state, so a limit in bytes suits it better than one in files,
    however small they are.
    """
    reader = _reader(spark, schema, files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.option("pathGlobFilter", pattern).parquet(folder)


def table_feed(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """The files of a stored table as a feed, be the table one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    if is_folder(spark, path):
        return parquet_feed(spark, path, "*", schema)
    return parquet_feed(spark, folder, f"{name}.parquet", schema)


def json_feed(
    spark: SparkSession, folder: str, schema: str, clean: str | None = None, archive: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Documents that arrive in a folder; processed files can be archived or deleted."""
    reader = _reader(spark, schema, files_per_trigger)
    if clean:
        reader = reader.option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.json(folder)


def only(feed: DataFrame, kind: str) -> DataFrame:
    """Submissions or comments of a feed."""
    return feed.where(F.col("type") == kind)


def skip_existing(feed: DataFrame, start: Column) -> DataFrame:
    """Items created after the stream began."""
    return feed.where(F.col("created_utc") >= start)


def by_entity(feed: DataFrame, subreddit: str | None = None, redditor: str | None = None) -> DataFrame:
    """One community's or one author's items; the community wins when both are given."""
    if subreddit is not None:
        return feed.where(F.col("subreddit") == subreddit)
    if redditor is not None:
        return feed.where(F.col("author") == redditor)
    return feed


def append_to(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store every item once; the checkpoint survives a restart."""
    return (
        feed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def show(feed: DataFrame, checkpoint: str, counts: str, rows: int = 20) -> StreamingQuery:
    """Display the first rows of each micro-batch; how many it has is stored below ``counts`` under its id.

    Progress reports keep the last hundred batches only, so they cannot tell the total.
    """

    def display(batch: DataFrame, batch_id: int) -> None:
        if rows:
            batch.show(rows)
        overwrite_batch(batch.agg(F.count("*").alias("shown")), counts, batch_id)

    return (
        feed.writeStream.foreachBatch(display)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def session_stats(items: DataFrame, keys: list[str], at: str = "seen_at") -> DataFrame:
    """First and last sight, number of items and duration per stream."""
    stats = items.groupBy(*keys).agg(
        F.min(at).alias("stream_start"), F.max(at).alias("stream_end"), F.count("*").alias("items")
    )
    micros = F.unix_micros(F.col("stream_end").cast("timestamp")) - F.unix_micros(F.col("stream_start").cast("timestamp"))
    return stats.withColumn("stream_duration", duration_hms(F.floor(micros / 1_000_000)))


def session_windows(feed: DataFrame, keys: list[str], at: str, gap: str, late: str) -> DataFrame:
    """Bursts of activity per key: a window ends ``gap`` after its last item by event time.

    Items may come up to ``late`` after the newest one. In append output a window comes out once, when the watermark
    has passed its end; a window that is still open stays in the state.
    """
    windows = feed.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("session")).agg(
        F.max(at).alias("stream_end"), F.count("*").alias("items")
    )
    micros = F.unix_micros("stream_end") - F.unix_micros("session.start")
    return windows.select(
        *keys, F.col("session.start").alias("stream_start"), "stream_end", "items",
        duration_hms(F.floor(micros / 1_000_000)).alias("stream_duration"),
    )


def store_session_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store the windows that have ended. Items of one key are merged before the shuffle, so a busy key is a few rows in its task."""
    spark = windows.sparkSession
    before = {name: spark.conf.get(name, None) for name in (STATE_STORE, MERGE_SESSIONS)}
    spark.conf.set(STATE_STORE, ROCKSDB)
    spark.conf.set(MERGE_SESSIONS, "true")
    try:
        return append_to(windows, path, checkpoint)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class LateRows(StreamingQueryListener):
    """Counts what stateful steps dropped as too late, over all batches; items merged before the shuffle count once."""

    def __init__(self) -> None:
        self.dropped = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped += sum(step.numRowsDroppedByWatermark for step in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        pass


def store_word_counts(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Word frequencies of every micro-batch under its own folder, without state.

    The sum over the batches is the current total; a repeated batch replaces
    its own share.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch(mixed_words(batch), path, batch_id)

    return (
        feed.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def total_counts(stored: DataFrame) -> DataFrame:
    return stored.groupBy("word").agg(F.sum("frequency").alias("frequency"))


def store_new_rows(
    path: str, order: list[Column], shape: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``load`` for :func:`ingest_stream`: rows whose id no earlier batch stored.

    Every batch has its own folder and looks at earlier folders only, so a
    repeated batch finds the same rows new and replaces its own folder. ``shape`` turns what
    arrived into what is stored, ``reddit_id`` included, once copies and known rows are gone.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        new = _unseen(batch, path, batch_id, order)
        overwrite_batch(shape(new) if shape else new, path, batch_id)

    return load


def _unseen(batch: DataFrame, path: str, batch_id: int, order: list[Column]) -> DataFrame:
    """Rows whose id is below ``path`` in no earlier batch, the first of each id."""
    candidates = keep_first(batch, ["reddit_id"], order)
    if batch_id <= 0:
        return candidates
    candidates = materialize(candidates, "candidates")
    stored = batch.sparkSession.read.schema("reddit_id STRING, batch INT").parquet(path).where(F.col("batch") < batch_id)
    # The ids of a batch are few next to all stored ones: they filter the stored side in place.
    seen = stored.select("reddit_id").join(candidates.select("reddit_id"), "reddit_id", "left_semi")
    return candidates.join(seen, "reddit_id", "left_anti")


def ingest_stream(
    feed: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, watermark: tuple[str, str] | None = None
) -> StreamingQuery:
    """Load arriving documents batch by batch.

    ``load`` does the exact dedupe against stored rows and must be repeatable
    for a batch id. With a ``watermark`` (column, delay), copies that arrive
    close together are dropped before it, with bounded state; the column must
    be the arrival time, which is never late, so that no other row is dropped.
    """
    if watermark:
        feed = feed.withWatermark(*watermark).dropDuplicatesWithinWatermark(["reddit_id"])
    return (
        feed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def comments_with_posts(posts: DataFrame, comments: DataFrame, at: str = "arrived", wait: str = "1 day") -> DataFrame:
    """The stream of comments, each with ``submission_row`` and ``subreddit_id`` of its post.

    A stream-stream outer join: a comment waits for a post that arrives up to ``wait`` later (or
    finds one that arrived up to ``wait`` before), and comes out with nulls once the watermark says that none
    can come. Copies of a post or comment within ``wait`` count once. ``at`` is the arrival time; state on
    either side is bounded by what arrives within ``wait``.
    """
    known = posts.withWatermark(at, wait).dropDuplicatesWithinWatermark(["reddit_id"]).select(
        F.col("reddit_id").alias("__post"), F.col("id").alias("submission_row"), "subreddit_id", F.col(at).alias("__post_at")
    )
    asked = comments.withWatermark(at, wait).dropDuplicatesWithinWatermark(["reddit_id"]).withColumn("__link", bare_id("link_id"))
    span = F.expr(f"INTERVAL {wait}")
    near = F.col("__post_at").between(F.col(at) - span, F.col(at) + span)
    joined = asked.join(known, (F.col("__link") == F.col("__post")) & near, "left_outer")
    return joined.drop("__link", "__post", "__post_at")


def ingest_with_parents(
    posts: DataFrame, comments: DataFrame, folder: str, checkpoint: str, as_of: Column, order: list[Column],
    at: str = "arrived", wait: str = "1 day",
) -> StreamingQuery:
    """Load posts and comments that arrive in any order.

    Below ``folder``, each batch writes ``submissions``, ``comments``, ``rejected`` and their ``queue`` rows into folders of its
    own, so a repeated batch replaces itself. Posts are stored first. Comments come from ``comments_with_posts``; one whose wait
    has ended may still belong to a post that an earlier load stored, else it is rejected. Ids that any
    earlier batch stored are left out. A restart goes on from ``checkpoint``, waiting comments included.
    """
    spark = posts.sparkSession
    stored = f"{folder}/submissions"

    def load_posts(batch: DataFrame, batch_id: int) -> None:
        new = materialize(_unseen(batch, stored, batch_id, order), "posts")
        overwrite_batch(new, stored, batch_id)
        overwrite_batch(enqueue(new, "submission", as_of), f"{folder}/queue/submissions", batch_id)

    def load_comments(batch: DataFrame, batch_id: int) -> None:
        new = materialize(_unseen(batch, f"{folder}/comments", batch_id, order), "arrived")
        kind = posts.schema["subreddit_id"].dataType.simpleString()
        earlier = batch.sparkSession.read.schema(f"reddit_id STRING, id STRING, subreddit_id {kind}").parquet(stored)
        earlier = earlier.select(F.col("reddit_id").alias("__post"), F.col("id").alias("__row"), F.col("subreddit_id").alias("__subreddit"))
        waited = new.where("submission_row IS NULL").withColumn("__link", bare_id("link_id"))
        waited = waited.join(earlier, F.col("__link") == F.col("__post"), "left").withColumns(
            {"submission_row": F.col("__row"), "subreddit_id": F.col("__subreddit")}
        )
        placed = materialize(new.where("submission_row IS NOT NULL").unionByName(waited.select(new.columns)), "placed")
        found = placed.where("submission_row IS NOT NULL")
        overwrite_batch(found, f"{folder}/comments", batch_id)
        overwrite_batch(placed.where("submission_row IS NULL").drop("submission_row", "subreddit_id"), f"{folder}/rejected", batch_id)
        overwrite_batch(enqueue(found, "comment", as_of), f"{folder}/queue/comments", batch_id)

    # A folder to look posts up in, even before the first one has come.
    overwrite_batch(spark.createDataFrame([], posts.schema), stored, -1)
    ingest_stream(posts, load_posts, f"{checkpoint}/submissions").awaitTermination()
    settings = {STATE_STORE: ROCKSDB, CHANGELOG: "true", JOIN_FORMAT: "3", COUNT_ROWS: "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return ingest_stream(comments_with_posts(posts, comments, at, wait), load_comments, f"{checkpoint}/comments")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
