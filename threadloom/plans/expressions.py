"""Registered queries: every scalar expression over a whole stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars as S
from ..functions import text as X
from .bindings import Tables
from .files_feeds import clock
from .reading import iso
from .registry import query
from .threads_words import BLANKS


@query("clean_word", f"SELECT doc_id, trim(translate(text, '{X.BLANKED}', '{BLANKS}'), '{X.EDGE_SPACE}') AS word FROM documents")
def clean_word(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.clean_word("text").alias("word"))


@query("tokenize", "SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS pieces FROM documents")
def tokenize(t: Tables) -> DataFrame:
    pieces = F.array_remove(X.raw_tokens("text"), "")
    return t.documents.select("doc_id", F.size(pieces).cast("bigint").alias("pieces"))


@query("url_to_reddit_id", """SELECT url, regexp_extract(url, '(?:^|/)comments/([^/]*)', 1) AS post_id FROM submissions
    UNION ALL SELECT url, regexp_extract(url, '(?:^|/)comments/([^/]*)', 1) FROM pages""")
def url_to_reddit_id(t: Tables) -> DataFrame:
    urls = t.submissions.select("url").unionByName(t.stored("pages").select("url"))
    return urls.select("url", S.post_id_from_url("url").alias("post_id"))


@query("parent_suffix", "SELECT reddit_id, split_part(parent_id, '_', -1) AS parent FROM raw_comments")
def parent_suffix(t: Tables) -> DataFrame:
    return t.raw_comments.select("reddit_id", S.bare_id("parent_id").alias("parent"))


@query("author_label", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'u/' || c_name ELSE '[deleted]' END AS author FROM customer")
def author_label(t: Tables) -> DataFrame:
    name = F.when(F.col("c_acctbal") > 0, F.col("c_name"))
    return t.stored("customer").select("c_custkey", S.author_label(name).alias("author"))


@query("edited_split", """SELECT event_id, event_type <> 'view' AS edited_flag,
    CASE WHEN event_type <> 'view' THEN CAST(ts AS STRING) END AS edited_at FROM events""")
def edited_split(t: Tables) -> DataFrame:
    text = F.concat(F.lit('"'), F.col("ts").cast("string"), F.lit('"'))
    edited = F.parse_json(F.when(F.col("event_type") == "view", F.lit("false")).otherwise(text))
    return t.stored("events").select("event_id", S.edited_flag(edited).alias("edited_flag"), S.edited_at(edited).alias("edited_at"))


@query("epoch_to_time", f"SELECT o_orderkey, {clock('o_orderkey * 1000')} AS time FROM orders")
def epoch_to_time(t: Tables) -> DataFrame:
    seconds = F.col("o_orderkey") * 1000 + 0.9
    return t.stored("orders").select("o_orderkey", S.epoch_to_time(seconds).alias("time"))


@query("parse_iso_time", f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {iso('ts')} END AS time FROM events")
def parse_iso_time(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("no time")).otherwise(F.col("ts").cast("string"))
    return t.stored("events").select("event_id", S.iso_time(S.parse_time(text)).alias("time"))


@query("category_code", """SELECT request_id, lower(category) AS code, CASE lower(category) WHEN 'h' THEN 'hot' WHEN 'n' THEN 'new'
    WHEN 't' THEN 'top' WHEN 'r' THEN 'rising' WHEN 'c' THEN 'controversial' WHEN 's' THEN 'search' ELSE lower(category) END AS name FROM requests""")
def category_code(t: Tables) -> DataFrame:
    return t.requests.select("request_id", S.category_code("category").alias("code"), S.category_name("category").alias("name"))


@query("session_duration", """SELECT id, CAST(floor((epoch_us(completed_at) - epoch_us(started_at)) / 1000000) AS INTEGER) AS seconds FROM sessions""")
def session_duration(t: Tables) -> DataFrame:
    return t.sessions.select("id", S.seconds_between("started_at", "completed_at").alias("seconds"))


@query("duration_hms", """SELECT o_orderkey, lpad(CAST(o_orderkey * 7 // 3600 % 24 AS STRING), 2, '0') || ':' ||
    lpad(CAST(o_orderkey * 7 // 60 % 60 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0') AS duration FROM orders""")
def duration_hms(t: Tables) -> DataFrame:
    return t.stored("orders").select("o_orderkey", S.duration_hms(F.col("o_orderkey") * 7).alias("duration"))


@query("size_mb", "SELECT key, round(size / 1048576, 2) AS mb FROM objects")
def size_mb(t: Tables) -> DataFrame:
    return t.objects.select("key", S.size_mb("size").alias("mb"))


@query("compression_ratio", """SELECT page_id, round(CASE WHEN length(html) > 0 THEN (1 - length(url) / length(html)) * 100 ELSE 0 END, 6) AS ratio FROM pages""")
def compression_ratio(t: Tables) -> DataFrame:
    ratio = S.compression_ratio(F.length("html"), F.length("url"))
    return t.stored("pages").select("page_id", F.round(ratio, 6).alias("ratio"))


@query("object_key_parts", "SELECT key, replace(split_part(key, '/', 1), '_scrapes', '') AS schedule, split_part(key, '/', 2) AS part FROM objects")
def object_key_parts(t: Tables) -> DataFrame:
    return t.objects.select("key", S.key_schedule("key").alias("schedule"), S.key_second_part("key").alias("part"))


DATE_TEXT = """CASE o_orderstatus WHEN 'P' THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/')
    WHEN 'O' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') END"""


@query("normalize_date", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day FROM orders")
def normalize_date(t: Tables) -> DataFrame:
    return t.stored("orders").select("o_orderkey", S.normalize_date(F.expr(DATE_TEXT)).alias("day"))


@query("null_to_zero", "SELECT id, coalesce(comments_scraped, 0) AS comments_scraped FROM sessions")
def null_to_zero(t: Tables) -> DataFrame:
    return t.sessions.select("id", S.null_to_zero("comments_scraped").alias("comments_scraped"))


@query("truncate_name", f"""SELECT doc_id, CASE WHEN length(text) > 50 THEN substring(text, 1, 48) || '--' ELSE text END AS name,
    translate(text, '{X.FORBIDDEN_IN_NAMES}', '{"_" * len(X.FORBIDDEN_IN_NAMES)}') AS safe FROM documents""")
def truncate_name(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.truncate_name("text").alias("name"), X.safe_name("text").alias("safe"))


@query("score_band", """SELECT reddit_id, score, CASE WHEN score >= 10 THEN 'high' WHEN score >= 1 THEN 'medium' ELSE 'low' END AS band FROM raw_comments""")
def score_band(t: Tables) -> DataFrame:
    return t.raw_comments.select("reddit_id", "score", S.score_band("score").alias("band"))


@query("is_reply", "SELECT reddit_id, parent_id <> 't3_' || submission_id AS is_reply FROM raw_comments")
def is_reply(t: Tables) -> DataFrame:
    return t.raw_comments.select("reddit_id", S.is_reply("parent_id", "submission_id").alias("is_reply"))


@query("json_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, replace(props, ' ', '') AS document FROM events")
def json_fields(t: Tables) -> DataFrame:
    fields = F.parse_json("props")
    return t.stored("events").select("event_id", F.variant_get(fields, "$.k", "bigint").alias("k"), F.to_json(fields).alias("document"))


@query("drop_unserializable_keys", "SELECT config_id, 'category=' || category || ',name=' || name AS config FROM configs")
def drop_unserializable_keys(t: Tables) -> DataFrame:
    keys = ["category", "name", "schedule"]
    config = F.create_map(*[c for k in keys for c in (F.lit(k), F.col(k))])
    kept = F.transform(F.map_entries(S.without_schedule(config)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return t.configs.select("config_id", F.array_join(kept, ",").alias("config"))
