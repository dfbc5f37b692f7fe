"""File and object inventories, archive manifests, run and session rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import compression_ratio, key_schedule, key_second_part, null_to_zero, post_id_from_url, size_mb
from .ranking import in_pages, top_per_group


def object_inventory(objects: DataFrame, as_of: Column, prefix: str = "", days: int = 7) -> DataFrame:
    """Objects by prefix and age, newest first."""
    rows = objects.where(F.col("key").startswith(prefix) & (F.col("last_modified") >= as_of - F.expr(f"INTERVAL {days} DAYS")))
    return rows.select("key", "size", "last_modified", size_mb("size").alias("size_mb")).orderBy(
        F.desc("last_modified"), F.asc("key")
    )


def recent_uploads(objects: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    rows = objects.where(F.col("last_modified") > as_of - F.expr(f"INTERVAL {hours} HOURS"))
    return rows.select("key", "size", "last_modified", size_mb("size").alias("size_mb"))


def object_metadata(objects: DataFrame, archives: DataFrame) -> DataFrame:
    """Objects with the metadata their upload recorded; an object without any stays."""
    stored = archives.select(F.col("r2_object_key").alias("key"), "upload_metadata")
    joined = objects.join(stored, "key", "left")
    return joined.select(
        "key",
        null_to_zero("size").alias("content_length"),
        "last_modified",
        F.coalesce("upload_metadata", F.lit("{}")).alias("metadata"),
        F.coalesce("content_type", F.lit("unknown")).alias("content_type"),
    )


# Prefixes of the four kinds of run.
RUN_PREFIXES = ["daily_scrapes", "hourly_hot_scrapes", "weekly_scrapes", "manual_scrapes"]


def scrape_pattern_report(objects: DataFrame, as_of: Column, shown: int = 10, days: int = 7) -> DataFrame:
    """Per run prefix: the newest files and how many more there are."""
    recent = object_inventory(objects, as_of, "", days)
    tests = [F.when(F.col("key").startswith(p), F.lit(p)) for p in RUN_PREFIXES]
    labelled = recent.withColumn("prefix", F.coalesce(*tests)).where("prefix IS NOT NULL")
    totals = labelled.groupBy("prefix").agg(F.count("*").alias("files"))
    newest = top_per_group(labelled, ["prefix"], [F.desc("last_modified"), F.asc("key")], shown, "position")
    more = F.greatest(F.col("files") - shown, F.lit(0))
    return newest.join(totals, "prefix").withColumn("more_files", more)


def naming_conflicts(objects: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Objects that share schedule and second key part with another, one row each.

    The groups are counted first; the objects then meet one row per group.
    """
    recent = object_inventory(objects, as_of, "", days).where(F.size(F.split("key", "/")) >= 2)
    group = F.concat_ws("_", key_schedule("key"), key_second_part("key"))
    keyed = recent.select(group.alias("conflict_group"), "key", "last_modified")
    shared = keyed.groupBy("conflict_group").agg(F.count("*").alias("files")).where("files > 1")
    return keyed.join(shared, "conflict_group")


def tree_listing(files: DataFrame) -> DataFrame:
    """Files of every date folder in tree order: folders before files, names in lower case."""
    parts = F.split("relative_path", "/")
    order = F.transform(
        parts, lambda p, i: F.struct((i == F.size(parts) - 1).alias("is_file"), F.lower(p).alias("name"))
    )
    return files.withColumn("depth", F.size(parts) - 1).orderBy("scrape_date", order, "relative_path")


def files_by_folder(files: DataFrame) -> DataFrame:
    """File count and bytes by date and kind."""
    return (
        files.groupBy("scrape_date", "scrape_type")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .orderBy("scrape_date", F.lower("scrape_type"))
    )


def locate_comment_file(posts: DataFrame, files: DataFrame, as_of: Column, days: int = 3) -> DataFrame:
    """Newest comment file of every post within ``days``.

    Ids are cut out of URL and permalink once, so this is one equi-join for all
    posts. Files: ``path, scrape_date, url, permalink``.
    """
    recent = files.where(F.col("scrape_date") > F.date_sub(as_of.cast("date"), days))
    ids = F.array_distinct(F.array(post_id_from_url("url"), post_id_from_url("permalink")))
    keyed = recent.select("path", "scrape_date", F.explode(ids).alias("reddit_id")).where("reddit_id <> ''")
    newest = top_per_group(keyed, ["reddit_id"], [F.desc("scrape_date"), F.asc("path")], 1)
    return posts.select("reddit_id").join(newest, "reddit_id")


def comment_files_containing(files: DataFrame, post_id: str) -> DataFrame:
    """All files whose URL or permalink contains the id anywhere (the loose match)."""
    return files.where(F.col("url").contains(post_id) | F.col("permalink").contains(post_id))


def archive_manifest(files: DataFrame, packed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per archive: files, bytes, communities, packed bytes, ratio, and the metadata document.

    ``files`` has ``length`` and ``subreddit``, ``packed`` has ``packed_bytes``, both with ``keys``.
    """
    names = F.array_join(F.sort_array(F.collect_set("subreddit")), ",")
    totals = files.groupBy(*keys).agg(
        F.count("*").alias("file_count"), F.sum("length").alias("original_size_bytes"), names.alias("subreddits")
    )
    sizes = packed.groupBy(*keys).agg(F.sum("packed_bytes").alias("compressed_size_bytes"))
    joined = totals.join(sizes, keys, "left")
    return joined.withColumn(
        "compression_ratio", compression_ratio("original_size_bytes", "compressed_size_bytes")
    ).withColumn("metadata", F.to_json(F.struct("file_count", "original_size_bytes", "subreddits")))


def archive_record(manifests: DataFrame, as_of: Column) -> DataFrame:
    """Manifest to archive table row."""
    metadata = F.to_json(F.struct("file_count", "original_size_bytes", "subreddits"))
    return manifests.select(
        F.sha2("r2_object_key", 256).alias("id"),
        F.element_at(F.split("r2_object_key", "/"), -1).alias("filename"),
        "archive_type",
        "r2_object_key",
        "original_size_bytes",
        "compressed_size_bytes",
        as_of.alias("uploaded_at"),
        F.coalesce("subreddits", F.lit("")).alias("subreddits_included"),
        null_to_zero("total_submissions").alias("total_submissions"),
        null_to_zero("total_comments_scraped").alias("total_comments"),
        F.lit(True).alias("is_uploaded"),
        metadata.alias("upload_metadata"),
    )


def run_totals(runs: DataFrame, keys: list[str], page_size: int = 500) -> DataFrame:
    """Outcome counts and sums per run, and the communities that succeeded.

    The names are distinct and joined in pages of ``page_size``, so the text
    stays bounded; a run with fewer names is one row with page 0.
    """
    totals = runs.groupBy(*keys).agg(
        F.count("*").alias("configs_processed"),
        F.count_if(F.col("status") == "success").alias("successful_scrapes"),
        F.count_if(F.col("status") == "skipped").alias("skipped_scrapes"),
        F.sum(null_to_zero("submissions_found")).alias("total_submissions"),
        F.sum(null_to_zero("comments_scraped")).alias("total_comments_scraped"),
    )
    names = runs.where(F.col("status") == "success").select(*keys, "subreddit").where("subreddit IS NOT NULL").distinct()
    pages = in_pages(names, keys, [F.asc("subreddit")], F.col("subreddit"), "names", page_size)
    return totals.join(pages, keys, "left").select(
        *totals.columns,
        null_to_zero("page").alias("page"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("subreddits"),
    )


def active_scrape_stats(sessions: DataFrame, subreddits: DataFrame) -> DataFrame:
    """Per community: sessions, successes, last success, totals, mean duration."""
    success = F.col("status") == "success"
    stats = sessions.groupBy("subreddit_id").agg(
        F.count("*").alias("total_sessions"),
        F.count_if(success).alias("successful_sessions"),
        F.max(F.when(success, F.col("completed_at"))).alias("last_successful_scrape"),
        F.sum(null_to_zero("submissions_scraped")).alias("total_submissions"),
        F.sum(null_to_zero("comments_scraped")).alias("total_comments"),
        F.avg("duration_seconds").alias("avg_session_duration"),
    )
    names = subreddits.select(F.col("id").alias("subreddit_id"), F.col("name").alias("subreddit_name"))
    return names.join(stats, "subreddit_id").drop("subreddit_id")


def task_metric_rollup(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("session_id", "metric_name", "metric_unit").agg(
        F.count("*").alias("samples"),
        F.avg("metric_value").alias("average"),
        F.min("metric_value").alias("lowest"),
        F.max("metric_value").alias("highest"),
    )
