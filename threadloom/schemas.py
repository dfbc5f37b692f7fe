"""Schemas of scrape documents and canonical tables (DDL)."""

from __future__ import annotations

# Field names and types of the scrape documents.
SUBMISSION_DOC = """
author STRING, created_utc STRING, distinguished STRING, edited VARIANT, id STRING,
is_original_content BOOLEAN, is_self BOOLEAN, link_flair_text STRING, locked BOOLEAN, name STRING,
nsfw BOOLEAN, num_comments INT, permalink STRING, score INT, selftext STRING, spoiler BOOLEAN,
stickied BOOLEAN, title STRING, upvote_ratio DOUBLE, url STRING
"""

COMMENT_DOC = """
author STRING, body STRING, body_html STRING, created_utc STRING, distinguished STRING,
edited VARIANT, id STRING, is_submitter BOOLEAN, link_id STRING, parent_id STRING, score INT,
stickied BOOLEAN
"""

RULE = """
created_utc DOUBLE, description STRING, kind STRING, priority INT, short_name STRING,
violation_reason STRING
"""

SUBREDDIT_SETTINGS = "subreddit STRING, category STRING, n_results_or_keywords STRING, time_filter STRING"

SUBREDDIT_FILE = f"""
scrape_settings STRUCT<{SUBREDDIT_SETTINGS.replace(' STRING', ': STRING')}>,
data ARRAY<VARIANT>,
subreddit_rules STRUCT<rules: ARRAY<STRUCT<created_utc: DOUBLE, description: STRING, kind: STRING,
  priority: INT, short_name: STRING, violation_reason: STRING>>, post_requirements: VARIANT>
"""

COMMENTS_FILE = """
scrape_settings STRUCT<n_results: VARIANT, style: STRING, url: STRING>,
data STRUCT<submission_metadata: VARIANT, comments: ARRAY<VARIANT>>
"""

REDDITOR_FILE = """
scrape_settings STRUCT<redditor: STRING, n_results: VARIANT>,
data STRUCT<information: VARIANT, interactions: MAP<STRING, ARRAY<VARIANT>>>
"""

LIVESTREAM_FILE = """
livestream_settings STRUCT<included_reddit_objects: STRING, subreddit: STRING, redditor: STRING>,
livestream_metadata STRUCT<stream_duration: STRING, stream_end: STRING, stream_start: STRING>,
data ARRAY<VARIANT>
"""

# Canonical tables.
TABLES = {
    "subreddits": """
        id INT, name STRING, display_name STRING, description STRING, subscribers BIGINT,
        created_utc TIMESTAMP, is_active BOOLEAN, first_scraped_at TIMESTAMP,
        last_scraped_at TIMESTAMP, total_scrapes INT
    """,
    "scrape_sessions": """
        id STRING, session_name STRING, task_id STRING, task_type STRING, config_id INT,
        subreddit_id INT, category STRING, n_results INT, keywords STRING, time_filter STRING,
        status STRING, started_at TIMESTAMP, completed_at TIMESTAMP, duration_seconds INT,
        submissions_found INT, submissions_scraped INT, comments_scraped INT,
        total_content_items INT, scrape_file_path STRING, archive_path STRING,
        r2_object_key STRING, file_format STRING, scrape_options VARIANT, error_message STRING,
        retry_count INT
    """,
    "submissions": """
        id STRING, reddit_id STRING, title STRING, url STRING, permalink STRING, selftext STRING,
        selftext_html STRING, author STRING, author_flair STRING, created_utc TIMESTAMP, score INT,
        upvote_ratio DOUBLE, num_comments INT, is_self BOOLEAN, is_original_content BOOLEAN,
        is_nsfw BOOLEAN, is_spoiler BOOLEAN, is_stickied BOOLEAN, is_locked BOOLEAN,
        distinguished STRING, link_flair_text STRING, link_flair_css_class STRING,
        thumbnail STRING, media_metadata VARIANT, gallery_data VARIANT, subreddit_id INT,
        scrape_session_id STRING, processing_status STRING, processed_at TIMESTAMP,
        processing_metadata VARIANT, first_seen_at TIMESTAMP, last_updated_at TIMESTAMP
    """,
    "comments": """
        id STRING, reddit_id STRING, body STRING, body_html STRING, author STRING,
        author_flair STRING, created_utc TIMESTAMP, score INT, parent_id STRING, link_id STRING,
        depth INT, is_submitter BOOLEAN, is_stickied BOOLEAN, distinguished STRING,
        edited TIMESTAMP, submission_id STRING, subreddit_id INT, processing_status STRING,
        processed_at TIMESTAMP, processing_metadata VARIANT, first_seen_at TIMESTAMP,
        last_updated_at TIMESTAMP
    """,
    "archives": """
        id STRING, filename STRING, archive_type STRING, file_path STRING, r2_object_key STRING,
        original_size_bytes BIGINT, compressed_size_bytes BIGINT, compression_ratio DOUBLE,
        compression_level INT, file_count INT, created_at TIMESTAMP, uploaded_at TIMESTAMP,
        subreddits_included STRING, date_range_start TIMESTAMP, date_range_end TIMESTAMP,
        total_submissions INT, total_comments INT, upload_metadata VARIANT, is_uploaded BOOLEAN,
        is_deleted_locally BOOLEAN
    """,
    "processing_queue": """
        id STRING, content_type STRING, content_id STRING, reddit_id STRING, priority INT,
        processing_status STRING, processor_name STRING, queued_at TIMESTAMP,
        started_processing_at TIMESTAMP, completed_at TIMESTAMP, retry_count INT,
        max_retries INT, processing_result VARIANT, error_message STRING
    """,
    "task_metrics": """
        id STRING, session_id STRING, metric_name STRING, metric_value DOUBLE,
        metric_unit STRING, recorded_at TIMESTAMP, task_metadata VARIANT
    """,
}
