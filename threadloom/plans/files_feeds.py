"""Registered queries: documents, files, sinks and streams.

Every one derives its documents from the stored tables with Spark, writes them
below the shared folder and reads them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import iso_time, post_url
from ..operators import ingest, inventory, normalize, stats, threads, views, words
from ..operators.ranking import in_pages, keep_first
from ..schemas import LIVESTREAM_FILE, SUBREDDIT_FILE
from ..session import scratch_path
from ..sinks import writers
from ..sources import documents, files
from ..streaming import feeds
from .bindings import FIRST_COPY, Tables
from .loading import arrivals, comment_rows, raw_batch
from .reading import FULL_POST, full_post_text, iso
from .registry import query
from .threads_words import MIXED, TREE_FILE, counted, feed, walk

# Records of one scrape document; ids are dense, so a block bounds the list.
PER_DOCUMENT = 50


def _listed(rows: DataFrame, keys: list[Column], item: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.collect_list(item).alias("items"))


# --- scrape documents ------------------------------------------------------


def submission_item(*extra: Column) -> Column:
    return F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("/r/"), "source", F.lit("/comments/"), "doc_id", F.lit("/")).alias("permalink"),
        F.col("text").alias("selftext"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        (F.col("n_chars") % 100).cast("int").alias("score"),
        *extra,
    )


def write_submission_scrapes(t: Tables) -> str:
    """Wrapped documents, bare records and broken lines, by language."""
    path = scratch_path(t.spark, "subreddits")
    texts = t.documents
    block = F.floor(F.col("doc_id") / PER_DOCUMENT)
    wrapped = _listed(
        texts.where(~F.col("lang").isin("de", "es")), [F.col("source"), block.alias("block")], submission_item()
    )
    items = F.transform("items", lambda i: F.parse_json(F.to_json(i)))
    docs = wrapped.select(
        F.struct(F.col("source").alias("subreddit"), F.lit("top").alias("category")).alias("scrape_settings"),
        F.concat(items, F.array(F.parse_json(F.lit('"no record"')))).alias("data"),
    )
    writers.write_json(docs, f"{path}/wrapped")
    writers.write_json(texts.where("lang = 'de'").select(submission_item().alias("d")).select("d.*"), f"{path}/bare")
    broken = F.concat(F.lit('{"scrape_settings": '), F.to_json(F.struct("doc_id")))
    texts.where("lang = 'es'").select(broken.alias("value")).write.text(f"{path}/broken")
    return path


SCRAPED = """SELECT CAST(doc_id AS STRING) AS id, CASE WHEN lang <> 'de' THEN source END AS subreddit, lang || ' ' || source AS title,
    text AS selftext, CAST(n_chars % 100 AS INTEGER) AS score FROM documents WHERE lang <> 'es'"""


@query("scan_submission_scrapes", SCRAPED)
def scan_submission_scrapes(t: Tables) -> DataFrame:
    rows = documents.submission_scrapes(t.spark, write_submission_scrapes(t), multi_line=False)
    return rows.select("id", "subreddit", "title", "selftext", "score")


@query("corrupt_documents", """SELECT '{"scrape_settings": {"doc_id":' || doc_id || '}' AS document, true AS unread
    FROM documents WHERE lang = 'es'""")
def corrupt_documents(t: Tables) -> DataFrame:
    rows = documents.corrupt_documents(t.spark, write_submission_scrapes(t), SUBREDDIT_FILE, multi_line=False)
    return rows.select(F.col("_corrupt_record").alias("document"), "unread")


@query("extract_submission_urls", """SELECT 'https://www.reddit.com/r/' || source || '/comments/' || doc_id || '/' AS url
    FROM documents WHERE lang <> 'es'""")
def extract_submission_urls(t: Tables) -> DataFrame:
    rows = documents.submission_scrapes(t.spark, write_submission_scrapes(t), multi_line=False)
    return rows.select(post_url("permalink").alias("url"))


@query("load_submission_row", """SELECT CAST(doc_id AS STRING) AS reddit_id, lang || ' ' || source AS title, text AS selftext,
    '[deleted]' AS author, CAST(n_chars % 100 AS INTEGER) AS score, 0 AS num_comments, false AS is_nsfw FROM documents WHERE lang <> 'es'""")
def load_submission_row(t: Tables) -> DataFrame:
    rows = normalize.submission_row(documents.submission_scrapes(t.spark, write_submission_scrapes(t), multi_line=False))
    return rows.select("reddit_id", "title", "selftext", "author", "score", "num_comments", "is_nsfw")


def write_comment_scrapes(t: Tables) -> str:
    path = scratch_path(t.spark, "comments")
    item = F.struct(
        F.col("reddit_id").alias("id"), "body", "author", "parent_id", "link_id",
        F.lit("2024-05-06 07:08:09").alias("created_utc"),
        F.when(F.col("ord") % 2 == 0, F.parse_json(F.lit("false"))).otherwise(F.parse_json(F.lit('"2024-05-07 00:00:00"'))).alias("edited"),
    )
    grouped = _listed(t.threads, [F.col("link_id"), F.floor(F.col("ord") / PER_DOCUMENT).alias("block")], item)
    docs = grouped.select(
        F.struct(F.lit("raw").alias("style"), F.concat(F.lit("https://www.reddit.com/r/x/comments/"), "link_id").alias("url")).alias("scrape_settings"),
        F.struct(F.col("items").alias("comments")).alias("data"),
    )
    writers.write_json(docs, path)
    return path


@query("scan_comment_scrapes", """SELECT reddit_id AS id, body, author, parent_id, 'https://www.reddit.com/r/x/comments/' || link_id AS url
    FROM threads""")
def scan_comment_scrapes(t: Tables) -> DataFrame:
    rows = documents.comment_scrapes(t.spark, write_comment_scrapes(t), multi_line=False)
    return rows.select("id", "body", "author", "parent_id", "url")


@query("load_comment_row", """SELECT reddit_id, body, author, 0 AS score, '2024-05-06T07:08:09' AS created_utc, parent_id, link_id,
    ord % 2 = 1 AS edited_flag, CASE WHEN ord % 2 = 1 THEN '2024-05-07T00:00:00' END AS edited_at FROM threads""")
def load_comment_row(t: Tables) -> DataFrame:
    rows = normalize.comment_row(documents.comment_scrapes(t.spark, write_comment_scrapes(t), multi_line=False))
    return rows.select(
        "reddit_id", "body", "author", "score", iso_time("created_utc").alias("created_utc"), "parent_id", "link_id",
        "edited_flag", iso_time("edited_at").alias("edited_at"),
    )


def write_nested_scrapes(t: Tables) -> str:
    """One nested comment document a thread."""
    path = scratch_path(t.spark, "nested")
    lines = threads.thread_tree_json(t.threads, ["id", "author", "body", "parent_id", "link_id"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "fragment"))), lambda x: x["fragment"]), "")
    docs = lines.groupBy("link").agg(F.from_json(text, "array<variant>").alias("comments")).select(
        F.struct(F.lit("structured").alias("style"), F.concat(F.lit("https://www.reddit.com/r/x/comments/"), "link").alias("url")).alias("scrape_settings"),
        F.struct("comments").alias("data"),
    )
    writers.write_json(docs, path)
    return path


@query("load_nested_comments", walk("threads", """SELECT n.reddit_id, n.parent_id, w.depth, n.author, n.body, 's' || w.link AS submission_row
    FROM walk w JOIN nodes n USING (link, id)"""))
def load_nested_comments(t: Tables) -> DataFrame:
    """Nested files loaded whole: replies of every level with their depth, under the post they belong to."""
    rows = normalize.comment_row(documents.nested_comment_scrapes(t.spark, write_nested_scrapes(t), multi_line=False))
    rows = rows.withColumn("id", F.col("reddit_id"))
    link = F.split("link_id", "_")[1]
    posts = t.threads.select(link.alias("reddit_id"), F.concat(F.lit("s"), link).alias("id"), F.lit(1).alias("subreddit_id"), F.lit(0).alias("created_utc")).distinct()
    loaded = ingest.ingest_batch(posts, rows, posts.limit(0), rows.limit(0), F.lit("2024-05-06").cast("timestamp"), comment_order=["depth"])
    comments = loaded["comments"]
    return comments.select("reddit_id", "parent_id", F.col("depth").cast("bigint").alias("depth"), "author", "body", "submission_row")


def write_redditor_scrapes(t: Tables) -> str:
    """User turns as comments, assistant turns as submissions, saved items forbidden."""
    path = scratch_path(t.spark, "redditors")
    record = F.when(
        F.col("author") == "assistant",
        F.to_json(F.struct(F.lit("submission").alias("type"), F.col("body").alias("selftext"), F.col("author").alias("title"))),
    ).otherwise(F.to_json(F.struct(F.lit("comment").alias("type"), "body")))
    item = F.struct("author", F.parse_json(record).alias("record"))
    grouped = _listed(t.threads, [F.col("link_id"), F.floor(F.col("ord") / PER_DOCUMENT).alias("block")], item)

    def records(*roles: str) -> Column:
        return F.transform(F.filter("items", lambda i: i["author"].isin(*roles)), lambda i: i["record"])

    forbidden = F.array(F.parse_json(F.lit('"FORBIDDEN"')))
    lists = F.create_map(
        F.lit("comments"), records("user"), F.lit("submissions"), records("assistant"),
        F.lit("hot"), records("system"), F.lit("saved"), forbidden,
    )
    docs = grouped.select(
        F.struct(F.concat(F.lit("u/"), "link_id").alias("redditor")).alias("scrape_settings"),
        F.struct(lists.alias("interactions")).alias("data"),
    )
    writers.write_json(docs, path)
    return path


CATEGORY = "CASE author WHEN 'user' THEN 'comments' WHEN 'assistant' THEN 'submissions' ELSE 'hot' END"
KIND = "CASE author WHEN 'assistant' THEN 'submission' ELSE 'comment' END"


@query("scan_redditor_scrapes", f"SELECT 'u/' || link_id AS redditor, {CATEGORY} AS category, {KIND} AS type, body AS text FROM threads")
def scan_redditor_scrapes(t: Tables) -> DataFrame:
    rows = documents.redditor_scrapes(t.spark, write_redditor_scrapes(t), multi_line=False)
    text = F.coalesce(F.try_variant_get("item", "$.selftext", "string"), F.try_variant_get("item", "$.body", "string"))
    return rows.select("redditor", "category", F.try_variant_get("item", "$.type", "string").alias("type"), text.alias("text"))


@query("label_interactions", f"""SELECT 'u/' || link_id AS redditor, {CATEGORY} AS category, {KIND} AS type, false AS forbidden FROM threads
    UNION ALL SELECT DISTINCT 'u/' || link_id, 'saved', NULL, true FROM threads""")
def label_interactions(t: Tables) -> DataFrame:
    docs = documents.redditor_documents(t.spark, write_redditor_scrapes(t), multi_line=False)
    return normalize.label_interactions(docs, ["redditor"]).select("redditor", "category", "type", "forbidden")


@query("interactions_union", "SELECT 'u/' || link_id AS redditor, count(*) AS items FROM threads GROUP BY 1")
def interactions_union(t: Tables) -> DataFrame:
    rows = documents.redditor_scrapes(t.spark, write_redditor_scrapes(t), multi_line=False)
    return rows.groupBy("redditor").agg(F.count("*").alias("items"))


@query("word_freq_redditors", counted(
    "(SELECT CASE author WHEN 'assistant' THEN body || ' ' || author ELSE body END AS text FROM threads)"))
def word_freq_redditors(t: Tables) -> DataFrame:
    rows = documents.redditor_scrapes(t.spark, write_redditor_scrapes(t), multi_line=False)
    return words.mixed_words(rows)


def write_livestream(t: Tables) -> str:
    path = scratch_path(t.spark, "livestream")
    grouped = _listed(
        feed(t).where(F.schema_of_variant("item").startswith("OBJECT")),
        [F.col("source"), F.floor(F.col("doc_id") / PER_DOCUMENT).alias("block")],
        F.col("item"),
    )
    docs = grouped.select(
        F.struct(F.lit("comments").alias("included_reddit_objects"), F.col("source").alias("subreddit")).alias("livestream_settings"),
        F.col("items").alias("data"),
    )
    writers.write_json(docs, path)
    return path


@query("scan_livestream_file", """SELECT source, CASE lang WHEN 'en' THEN 'submission' WHEN 'fr' THEN 'comment' END AS type, text
    FROM documents WHERE lang <> 'de'""")
def scan_livestream_file(t: Tables) -> DataFrame:
    rows = documents.livestream_scrapes(t.spark, write_livestream(t), multi_line=False)
    text = F.coalesce(F.try_variant_get("item", "$.selftext", "string"), F.try_variant_get("item", "$.body", "string"))
    return rows.select("source", F.try_variant_get("item", "$.type", "string").alias("type"), text.alias("text"))


@query("word_freq_livestream", counted(MIXED))
def word_freq_livestream(t: Tables) -> DataFrame:
    return words.mixed_words(documents.livestream_scrapes(t.spark, write_livestream(t), multi_line=False))


@query("scan_analytics_file", "SELECT source, count(*) AS items FROM documents WHERE lang <> 'de' GROUP BY 1")
def scan_analytics_file(t: Tables) -> DataFrame:
    docs = documents.analytics_files(t.spark, write_livestream(t), multi_line=False)
    listed = F.size(F.try_variant_get("document", "$.data", "array<variant>")).cast("bigint")
    source = F.try_variant_get("document", "$.livestream_settings.subreddit", "string")
    return docs.select(source.alias("source"), listed.alias("n")).groupBy("source").agg(F.sum("n").alias("items"))


PATHS = """(SELECT page_id, CASE page_id % 4 WHEN 0 THEN '../scrapes/2024-01-0' || (1 + page_id % 7) || '/subreddits/' WHEN 1 THEN 'scrapes/2024-02-02/comments/deep/'
      WHEN 2 THEN '/data/scrapes/2024-01-01/analytics/frequencies/' ELSE 'scrapes/2024-03-03/redditors/' END
      || page_id || CASE page_id % 3 WHEN 0 THEN '.csv' ELSE '.json' END AS path FROM pages)"""


@query("route_by_path", f"""SELECT path, regexp_extract(path, 'scrapes/([^/]+)/', 1) AS scrape_date,
      regexp_extract(path, 'scrapes/[^/]+/([^/]+)/', 1) AS scrape_type,
      regexp_replace(path, 'scrapes/([^/]+)/(.*)/[^/]+$', 'scrapes/\\1/analytics/frequencies/\\2') AS analytics_dir
    FROM {PATHS} WHERE path LIKE '%.json' AND path NOT LIKE '%/analytics/%'""")
def route_by_path(t: Tables) -> DataFrame:
    paths = t.stored("pages").selectExpr(
        """CASE page_id % 4 WHEN 0 THEN '../scrapes/2024-01-0' || (1 + page_id % 7) || '/subreddits/' WHEN 1 THEN 'scrapes/2024-02-02/comments/deep/'
        WHEN 2 THEN '/data/scrapes/2024-01-01/analytics/frequencies/' ELSE 'scrapes/2024-03-03/redditors/' END
        || page_id || CASE page_id % 3 WHEN 0 THEN '.csv' ELSE '.json' END AS path"""
    )
    return files.route_by_path(paths).withColumn("analytics_dir", files.analytics_dir("path", "frequencies"))


# --- record shapes ---------------------------------------------------------


def raw_submissions(t: Tables) -> DataFrame:
    """Posts as the site's client hands them over: bare author name, epoch times, mixed edit field."""
    return t.stored("orders").selectExpr(
        "CASE WHEN o_custkey % 50 > 0 THEN CAST(o_custkey AS STRING) END AS author_name",
        "CAST(o_orderkey AS DOUBLE) * 1000 + 0.5 AS created_utc",
        "CAST(NULL AS STRING) AS distinguished",
        "parse_json(CASE WHEN o_orderkey % 3 = 0 THEN 'false' ELSE CAST(o_orderkey * 1000 + 77 AS STRING) || '.0' END) AS edited",
        "CAST(o_orderkey AS STRING) AS id",
        "o_orderkey % 19 = 0 AS is_original_content", "true AS is_self", "o_orderpriority AS link_flair_text",
        "false AS locked", "'t3_' || o_orderkey AS name", "o_orderkey % 7 = 0 AS over_18",
        "CAST(o_orderkey % 50 AS INTEGER) AS num_comments", "'/p/' || o_orderkey AS permalink",
        "CAST(floor(o_totalprice) AS INTEGER) AS score", "o_orderstatus AS selftext", "false AS spoiler",
        "false AS stickied", "o_orderpriority AS title", "0.5D AS upvote_ratio", "'/p/' || o_orderkey AS url",
    )


def clock(seconds: str) -> str:
    return f"strftime(make_timestamp(CAST(({seconds}) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


@query("normalize_submission", f"""SELECT CASE WHEN o_custkey % 50 > 0 THEN 'u/' || o_custkey ELSE '[deleted]' END AS author,
    {clock('o_orderkey * 1000')} AS created_utc,
    CASE WHEN o_orderkey % 3 = 0 THEN 'false' ELSE {clock('o_orderkey * 1000 + 77')} END AS edited,
    CAST(NULL AS STRING) AS distinguished, CAST(o_orderkey AS STRING) AS id, o_orderkey % 19 = 0 AS is_original_content, true AS is_self,
    o_orderpriority AS link_flair_text, false AS locked, 't3_' || o_orderkey AS name, o_orderkey % 7 = 0 AS nsfw,
    CAST(o_orderkey % 50 AS INTEGER) AS num_comments, '/p/' || o_orderkey AS permalink, CAST(floor(o_totalprice) AS INTEGER) AS score,
    o_orderstatus AS selftext, false AS spoiler, false AS stickied, o_orderpriority AS title, CAST(0.5 AS DOUBLE) AS upvote_ratio,
    '/p/' || o_orderkey AS url FROM orders""")
def normalize_submission(t: Tables) -> DataFrame:
    return normalize.submission_record(raw_submissions(t))


@query("normalize_comment", f"""SELECT CASE WHEN l_suppkey % 20 > 0 THEN 'u/' || l_suppkey ELSE '[deleted]' END AS author,
    l_returnflag AS body, '<p>' || l_returnflag AS body_html, {clock('l_partkey * 1000')} AS created_utc,
    CASE WHEN l_tax = 0.08 THEN 'moderator' END AS distinguished,
    CASE WHEN l_discount = 0 THEN 'false' ELSE {clock('l_partkey * 1000 + 77')} END AS edited,
    l_orderkey || '-' || l_linenumber AS id, l_suppkey % 10 = 1 AS is_submitter, 't3_' || l_orderkey AS link_id,
    't1_' || l_linenumber AS parent_id, CAST(l_quantity AS INTEGER) - 25 AS score, l_linenumber = 7 AS stickied,
    l_orderkey AS submission_id, 't5_' || l_suppkey AS subreddit_id, 'comment' AS type FROM lineitem""")
def normalize_comment(t: Tables) -> DataFrame:
    raw = t.stored("lineitem").selectExpr(
        "CASE WHEN l_suppkey % 20 > 0 THEN CAST(l_suppkey AS STRING) END AS author_name", "l_returnflag AS body",
        "'<p>' || l_returnflag AS body_html", "CAST(l_partkey * 1000 AS DOUBLE) AS created_utc",
        "CASE WHEN l_tax = 0.08 THEN 'moderator' END AS distinguished",
        "parse_json(CASE WHEN l_discount = 0 THEN 'false' ELSE CAST(l_partkey * 1000 + 77 AS STRING) END) AS edited",
        "l_orderkey || '-' || l_linenumber AS id", "l_suppkey % 10 = 1 AS is_submitter", "'t3_' || l_orderkey AS link_id",
        "'t1_' || l_linenumber AS parent_id", "CAST(l_quantity AS INTEGER) - 25 AS score", "l_linenumber = 7 AS stickied",
        "named_struct('id', l_orderkey) AS submission", "'t5_' || l_suppkey AS subreddit_id",
    )
    rows = normalize.comment_record(raw, include_all=True)
    return rows.withColumn("submission_id", F.col("submission.id")).drop("submission")


RAW_SUBREDDIT = [
    "c_custkey % 2 = 0 AS can_assign_link_flair", "c_custkey % 5 = 0 AS can_assign_user_flair", "CAST(c_custkey * 60 AS DOUBLE) AS created_utc",
    "c_mktsegment AS description", "'<p>' || c_mktsegment AS description_html", "c_name AS display_name", "CAST(c_custkey AS STRING) AS id",
    "'t5_' || c_custkey AS name", "c_custkey % 3 = 0 AS over18", "lower(c_mktsegment) AS public_description",
    "c_custkey % 7 > 0 AS spoilers_enabled", "CAST(c_custkey AS BIGINT) AS subscribers", "c_custkey % 11 = 0 AS user_is_banned",
    "c_custkey % 13 = 0 AS user_is_moderator", "c_custkey % 17 = 0 AS user_is_subscriber",
]


@query("normalize_subreddit", f"""SELECT c_custkey % 2 = 0 AS can_assign_link_flair, c_custkey % 5 = 0 AS can_assign_user_flair,
    {clock('c_custkey * 60')} AS created_utc, c_mktsegment AS description, '<p>' || c_mktsegment AS description_html, c_name AS display_name,
    CAST(c_custkey AS STRING) AS id, 't5_' || c_custkey AS name, c_custkey % 3 = 0 AS nsfw, lower(c_mktsegment) AS public_description,
    c_custkey % 7 > 0 AS spoilers_enabled, c_custkey AS subscribers, c_custkey % 11 = 0 AS user_is_banned,
    c_custkey % 13 = 0 AS user_is_moderator, c_custkey % 17 = 0 AS user_is_subscriber FROM customer""")
def normalize_subreddit(t: Tables) -> DataFrame:
    return normalize.subreddit_record(t.stored("customer").selectExpr(*RAW_SUBREDDIT))


@query("normalize_multireddit", f"""SELECT 'm' || c_custkey AS name, {clock('c_custkey * 60')} AS created_utc, c_custkey % 4 = 0 AS nsfw,
    c_name || '/' || (c_custkey % 3 = 0) AS nested FROM customer""")
def normalize_multireddit(t: Tables) -> DataFrame:
    nested = F.struct(*[F.expr(e) for e in RAW_SUBREDDIT])
    raw = t.stored("customer").select(
        F.lit(False).alias("can_edit"), F.lit(None).cast("string").alias("copied_from"),
        (F.col("c_custkey") * 60).cast("double").alias("created_utc"), F.lit("").alias("description_html"),
        F.lit("").alias("description_md"), F.col("c_name").alias("display_name"),
        F.concat(F.lit("m"), "c_custkey").alias("name"), (F.col("c_custkey") % 4 == 0).alias("over_18"),
        F.array(nested).alias("subreddits"), F.lit("public").alias("visibility"),
    )
    rows = normalize.multireddit_record(raw)
    inner = F.transform("subreddits", lambda s: F.concat_ws("/", s["display_name"], s["nsfw"].cast("string")))
    return rows.select("name", "created_utc", "nsfw", F.array_join(inner, ",").alias("nested"))


# Fields of a profile that is not suspended, as the SQL gives their text; the trophy's and the community's are below.
PROFILE = {
    "comment_karma": "c_custkey % 10", "created_utc": clock("c_custkey * 60"), "fullname": "'t2_' || c_custkey",
    "has_verified_email": "c_custkey % 3 = 0", "icon_img": "''", "id": "c_custkey", "is_employee": "c_custkey % 5 = 0",
    "is_friend": "c_custkey % 7 = 0", "is_mod": "c_custkey % 11 = 0", "is_gold": "c_custkey % 13 = 0", "link_karma": "c_custkey",
}
TROPHY = {
    "award_id": "NULL", "description": "'for ' || c_name", "icon_40": "'a'", "icon_70": "'b'", "name": "c_mktsegment", "url": "NULL",
}
OWN = {name.replace("over18", "nsfw"): e for e, name in (field.split(" AS ") for field in RAW_SUBREDDIT if "CAST(" not in field)}
OWN |= {"id": "c_custkey", "subscribers": "c_custkey", "created_utc": "c_custkey * 60"}


@query("redditor_information", f"""SELECT c_name AS name, CASE WHEN c_acctbal < 0 THEN 'true' END AS is_suspended,
    {', '.join(f"CASE WHEN c_acctbal >= 0 THEN CAST({e} AS STRING) END AS {n}" for n, e in PROFILE.items())},
    {', '.join(f"CASE WHEN c_acctbal >= 0 AND c_custkey % 2 = 0 THEN CAST({e} AS STRING) END AS trophy_{n}" for n, e in TROPHY.items())},
    {', '.join(f"CASE WHEN c_acctbal >= 0 THEN CAST({e} AS STRING) END AS subreddit_{n}" for n, e in OWN.items() if n != 'created_utc')},
    CASE WHEN c_acctbal >= 0 THEN c_custkey * 60 END AS subreddit_created_utc FROM customer""")
def redditor_information(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    trophy = F.struct(*[F.expr(e).cast("string").alias(n) for n, e in TROPHY.items()])
    # A few MB of accounts are one split of a file; the documents they grow into are work for all tasks.
    accounts = t.stored("customer").repartition("c_custkey")
    raw = accounts.select(
        F.when(F.col("c_acctbal") < 0, True).alias("is_suspended"), F.col("c_name").alias("name"),
        (key * 60).cast("double").alias("created_utc"),
        *[F.expr(e).alias(n) for n, e in PROFILE.items() if n != "created_utc"],
        F.struct(*[F.expr(e) for e in RAW_SUBREDDIT]).alias("subreddit"),
        F.when(key % 2 == 0, F.array(trophy)).otherwise(F.array().cast("array<" + _TROPHY + ">")).alias("trophies"),
    )
    info = normalize.redditor_information(raw)
    texts = lambda names: ", ".join(f"{n} STRING" for n in names)
    document = f"is_suspended STRING, {texts(PROFILE)}, trophies ARRAY<STRUCT<{texts(TROPHY)}>>, subreddit STRUCT<{texts(OWN)}>"
    # Every document is parsed once for all its fields.
    parsed = info.select("name", F.from_json("information", document).alias("d"))
    fields = {n: F.col(f"d.{n}") for n in ["is_suspended", *PROFILE]}
    fields |= {f"trophy_{n}": F.get(F.col("d.trophies"), F.lit(0))[n] for n in TROPHY}
    fields |= {f"subreddit_{n}": F.col(f"d.subreddit.{n}") for n in OWN}
    rows = parsed.select("name", *[c.alias(n) for n, c in fields.items()])
    return rows.withColumn("subreddit_created_utc", F.col("subreddit_created_utc").cast("double").cast("bigint"))


_TROPHY = "struct<award_id: string, description: string, icon_40: string, icon_70: string, name: string, url: string>"


@query("submission_metadata", f"""SELECT CASE WHEN o_custkey % 50 > 0 THEN 'u/' || o_custkey ELSE '[deleted]' END AS author,
    {clock('o_orderkey * 1000')} AS created_utc, CAST(NULL AS STRING) AS distinguished,
    CASE WHEN o_orderkey % 3 = 0 THEN 'false' ELSE {clock('o_orderkey * 1000 + 77')} END AS edited,
    o_orderkey % 19 = 0 AS is_original_content, true AS is_self, o_orderpriority AS link_flair_text, false AS locked,
    o_orderkey % 7 = 0 AS nsfw, CAST(o_orderkey % 50 AS INTEGER) AS num_comments, '/p/' || o_orderkey AS permalink,
    CAST(floor(o_totalprice) AS INTEGER) AS score, o_orderstatus AS selftext, false AS spoiler, false AS stickied,
    'n' || o_custkey AS subreddit, o_orderpriority AS title, CAST(0.5 AS DOUBLE) AS upvote_ratio,
    CASE WHEN o_orderkey % 5 = 0 THEN 'g' || o_orderkey END AS gallery_data FROM orders""")
def submission_metadata(t: Tables) -> DataFrame:
    docs = normalize.submission_record(raw_submissions(t)).withColumn(
        "subreddit", F.concat(F.lit("n"), F.coalesce(F.substring("author", 3, 20), F.lit("")))
    )
    gallery = F.when(F.col("id").cast("bigint") % 5 == 0, F.concat(F.lit("g"), "id"))
    # The community name needs the customer key, which a deleted author hides.
    keys = t.stored("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("n"), "o_custkey").alias("subreddit"))
    return normalize.submission_metadata(docs.drop("subreddit").join(keys, "id").withColumn("gallery_data", gallery))


@query("subreddit_rules", f"""SELECT c_name AS subreddit, {clock('c_custkey * 60')} AS created_utc, 'link' AS kind, p AS priority,
    'Rule ' || p AS short_name FROM customer, (VALUES (0), (1)) AS v(p)""")
def subreddit_rules(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "rules")
    rule = F.array(*[
        F.struct(
            (F.col("c_custkey") * 60).cast("double").alias("created_utc"), F.col("c_mktsegment").alias("description"),
            F.lit("link").alias("kind"), F.lit(p).alias("priority"), F.lit(f"Rule {p}").alias("short_name"),
            F.lit(None).cast("string").alias("violation_reason"),
        )
        for p in (0, 1)
    ])
    docs = t.stored("customer").select(
        F.struct(F.col("c_name").alias("subreddit")).alias("scrape_settings"), F.struct(rule.alias("rules")).alias("subreddit_rules")
    )
    writers.write_json(docs, path)
    rows = normalize.rules(documents.read_json(t.spark, path, SUBREDDIT_FILE, multi_line=False))
    return rows.select("subreddit", "created_utc", "kind", "priority", "short_name")


@query("rows_to_columns", """SELECT title, (rn - 1) // 100 AS page, string_agg(reddit_id, ' ' ORDER BY rn) AS reddit_id,
      string_agg(CAST(score AS STRING), ' ' ORDER BY rn) AS score
    FROM (SELECT title, reddit_id, score, row_number() OVER (PARTITION BY title ORDER BY score DESC, reddit_id) AS rn FROM submissions) GROUP BY 1, 2""")
def rows_to_columns(t: Tables) -> DataFrame:
    rows = t.posts.select("title", "reddit_id", "score")
    lists = normalize.columns_to_lists(rows, ["title"], [F.desc("score"), F.asc("reddit_id")], page_size=100)
    return lists.select("title", "page", F.array_join("reddit_id", " ").alias("reddit_id"), F.array_join("score", " ").alias("score"))


def display_feed(t: Tables) -> DataFrame:
    """Comments with the attributes of their post, and posts of their own, by language."""
    post = F.struct(F.col("source").alias("title"), F.col("lang").alias("author"), F.col("n_chars").cast("int").alias("score"))
    comment = F.struct(F.lit("comment").alias("type"), F.col("text").alias("body"), F.lit(False).alias("is_submitter"), post.alias("submission"))
    submission = F.struct(F.lit("submission").alias("type"), F.col("text").alias("selftext"), F.col("source").alias("title"), F.col("n_chars").alias("score"))
    item = F.when(F.col("lang") == "en", F.to_json(submission)).otherwise(F.to_json(comment))
    return t.documents.select("doc_id", F.parse_json(item).alias("item"))


@query("stream_display_fields", """
    SELECT doc_id, 'submission' AS type, 'selftext' AS attribute, text AS data FROM documents WHERE lang = 'en'
    UNION ALL SELECT doc_id, 'submission', 'title', source FROM documents WHERE lang = 'en'
    UNION ALL SELECT doc_id, 'comment', 'body', text FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'comment', 'is_submitter', 'false' FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'comment', 'submission_title', source FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'comment', 'submission_author', lang FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, 'comment', 'submission_score', CAST(n_chars AS STRING) FROM documents WHERE lang <> 'en'""")
def stream_display_fields(t: Tables) -> DataFrame:
    return views.display_fields(display_feed(t), ["doc_id"])


# --- sinks and files -------------------------------------------------------

TEXTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"
TEXT_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@query("sink_json", TEXTS)
def sink_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    writers.write_json(t.documents, path)
    return t.spark.read.schema(TEXT_SCHEMA).json(path)


@query("sink_csv", TEXTS)
def sink_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.documents, path)
    reader = t.spark.read.schema(TEXT_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"')
    return reader.option("lineSep", "\n").csv(path)


@query("sink_structured_comments", walk("threads", TREE_FILE))
def sink_structured_comments(t: Tables) -> DataFrame:
    """Lines of the written tree documents."""
    path = scratch_path(t.spark, "structured")
    writers.write_structured_comments(threads.tree_fragments(t.threads, ["id", "author", "body"]), path)
    return t.spark.read.text(path)


def write_layout(t: Tables) -> str:
    path = scratch_path(t.spark, "scrapes")
    docs = t.documents.select(
        F.col("lang").alias("scrape_date"), F.col("source").alias("scrape_type"), "doc_id", "text"
    )
    writers.write_partitioned(docs, path)
    return path


@query("sink_partitioned_layout", "SELECT lang AS scrape_date, source AS scrape_type, doc_id, text FROM documents")
def sink_partitioned_layout(t: Tables) -> DataFrame:
    return t.spark.read.schema("doc_id BIGINT, text STRING, scrape_date STRING, scrape_type STRING").json(write_layout(t))


@query("file_inventory", "SELECT DISTINCT lang AS scrape_date, source AS scrape_type, true AS has_files, true AS complete FROM documents")
def file_inventory(t: Tables) -> DataFrame:
    """The bytes listed for each date and kind are those of the lines in its files."""
    path = write_layout(t)
    listed = inventory.files_by_folder(files.dated_files(t.spark, path))
    lines = t.spark.read.text(path).groupBy("scrape_date", "scrape_type").agg(F.sum(F.octet_length("value") + 1).alias("written"))
    return listed.join(lines, ["scrape_date", "scrape_type"]).select(
        "scrape_date", "scrape_type", (F.col("files") > 0).alias("has_files"), (F.col("bytes") == F.col("written")).alias("complete")
    )


# Names of written files are random, so the listings are compared by their folders and endings.
FOLDERS = "SELECT DISTINCT lang AS scrape_date, 'scrape_type=' || source AS folder, 'json' AS ending FROM documents"


@query("file_tree", FOLDERS)
def file_tree(t: Tables) -> DataFrame:
    listed = inventory.tree_listing(files.dated_files(t.spark, write_layout(t)))
    folder, ending = F.regexp_extract("relative_path", "^([^/]+)/", 1), F.regexp_extract("relative_path", r"\.([a-z]+)$", 1)
    named = listed.select("scrape_date", folder.alias("folder"), ending.alias("ending"))
    return named.where("folder <> '' AND ending <> ''").distinct()


@query("scan_files_over_size", """SELECT lang AS scrape_date, source AS scrape_type, true AS over FROM documents
    GROUP BY 1, 2 HAVING max(strlen(text)) > 100""")
def scan_files_over_size(t: Tables) -> DataFrame:
    over = files.files_over_size(t.spark, write_layout(t))
    named = over.select(
        F.regexp_extract("path", r"scrape_date=([^/]+)", 1).alias("scrape_date"),
        F.regexp_extract("path", r"scrape_type=([^/]+)", 1).alias("scrape_type"), (F.col("length") > 100).alias("over"),
    )
    return named.distinct()


@query("sink_frequencies", counted("(SELECT text FROM documents)").replace("SELECT word, count(*) AS frequency", "SELECT word AS words, count(*) AS frequencies", 1))
def sink_frequencies(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "frequencies")
    writers.write_frequencies_csv(words.count_words(t.documents, ["text"]), path)
    reader = t.spark.read.schema("words STRING, frequencies BIGINT").option("header", True).option("multiLine", True)
    return reader.option("escape", '"').option("lineSep", "\n").csv(path)


@query("sink_frequencies_json", counted("(SELECT source AS raw_file, text FROM documents)", "raw_file"))
def sink_frequencies_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "frequencies-json")
    counts = words.words_by_file(t.documents.select(F.col("source").alias("file"), "text"))
    order = [F.desc("frequency"), F.asc("word")]
    pages = in_pages(counts, ["file"], order, F.struct("word", "frequency"), "entries", page_size=5000)
    writers.write_json(writers.frequency_documents(pages), path)
    stored = t.spark.read.schema("raw_file STRING, page BIGINT, data MAP<STRING, BIGINT>").json(path)
    return stored.select("raw_file", F.explode("data").alias("word", "frequency"))


@query("sink_tables", "SELECT reddit_id, author, score FROM comments")
def sink_tables(t: Tables) -> DataFrame:
    """Two loads of the same rows store every row once."""
    path = scratch_path(t.spark, "stored")
    batch = arrivals(t.stored("lineitem"))
    order = [F.asc(c) for c in FIRST_COPY]
    writers.append_table(comment_rows(keep_first(batch, ["reddit_id"], order)), path)
    stored = t.spark.read.schema(comment_rows(batch).schema).parquet(path)
    writers.append_table(comment_rows(keep_first(ingest.unstored(batch, stored), ["reddit_id"], order)), path)
    return t.spark.read.schema(stored.schema).parquet(path).select("reddit_id", "author", "score")


@query("sink_post_json", FULL_POST)
def sink_post_json(t: Tables) -> DataFrame:
    """Full posts written as documents and read back, statistics and comments included."""
    path = scratch_path(t.spark, "posts")
    pages = stats.full_post(t.submissions, t.subreddits, t.stored_comments, page_size=4)
    writers.write_json(pages, path, compression="gzip")
    return full_post_text(t.spark.read.schema(pages.schema).json(path))


ARCHIVED = """SELECT lang AS scrape_date, count(*) AS file_count, CAST(sum(n_chars) AS BIGINT) AS original_size_bytes,
    string_agg(DISTINCT source, ',' ORDER BY source) AS subreddits FROM documents GROUP BY 1"""
METADATA = """'{"file_count":' || file_count || ',"original_size_bytes":' || original_size_bytes || ',"subreddits":"' || subreddits || '"}'"""


def packed_manifest(t: Tables) -> DataFrame:
    """Documents stand for files; they are packed as columnar files per date."""
    path = scratch_path(t.spark, "archive")
    docs = t.documents.withColumnRenamed("lang", "scrape_date")
    writers.pack(docs, path, ["scrape_date"])
    packed = files.dated_files(t.spark, path).select("scrape_date", F.col("length").alias("packed_bytes"))
    sizes = docs.select("scrape_date", F.col("source").alias("subreddit"), F.col("n_chars").alias("length"))
    return inventory.archive_manifest(sizes, packed, ["scrape_date"])


@query("archive_manifest", f"SELECT *, true AS packed, true AS ratio_fits, {METADATA} AS metadata FROM ({ARCHIVED})")
def archive_manifest(t: Tables) -> DataFrame:
    whole, small = F.col("original_size_bytes"), F.col("compressed_size_bytes")
    fits = F.abs(F.col("compression_ratio") - (1 - small / whole) * 100) < 0.01
    return packed_manifest(t).select(
        "scrape_date", "file_count", "original_size_bytes", "subreddits", (small > 0).alias("packed"), fits.alias("ratio_fits"), "metadata"
    )


@query("archive_record", f"""SELECT sha256(key) AS id, split_part(key, '/', -1) AS filename, 'daily' AS archive_type, key AS r2_object_key,
      original_size_bytes, true AS is_packed, subreddits AS subreddits_included, 0 AS total_submissions, 0 AS total_comments,
      true AS is_uploaded, {METADATA} AS upload_metadata
    FROM (SELECT *, 'daily_scrapes/' || scrape_date || '/all.zip' AS key FROM ({ARCHIVED}))""")
def archive_record(t: Tables) -> DataFrame:
    """The record of each packed archive, made from its manifest."""
    manifests = packed_manifest(t).select(
        F.concat(F.lit("daily_scrapes/"), "scrape_date", F.lit("/all.zip")).alias("r2_object_key"),
        F.lit("daily").alias("archive_type"), "original_size_bytes", "compressed_size_bytes", "file_count", "subreddits",
        F.lit(None).cast("int").alias("total_submissions"), F.lit(None).cast("int").alias("total_comments_scraped"),
    )
    rows = inventory.archive_record(manifests, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return rows.select(
        "id", "filename", "archive_type", "r2_object_key", "original_size_bytes", (F.col("compressed_size_bytes") > 0).alias("is_packed"),
        "subreddits_included", "total_submissions", "total_comments", "is_uploaded", "upload_metadata",
    )


# --- streams ---------------------------------------------------------------

FEED = [
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'submission' ELSE 'comment' END AS type",
    "CAST(event_id AS STRING) AS reddit_id", "'n' || (user_id % 25) AS subreddit", "'u/' || user_id AS author",
    "ts AS created_utc", "props AS body",
]
LIVE = f"(SELECT {', '.join(FEED)} FROM events)"


def live(t: Tables) -> DataFrame:
    schema = t.stored("events").schema
    return feeds.table_feed(t.spark, t.folder, "events", schema).selectExpr(*FEED)


def stored_feed(t: Tables, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is available and read what it stored."""
    path, checkpoint = scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-checkpoint")
    feeds.append_to(stream, path, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path)


@query("stream_submissions", f"SELECT reddit_id, author FROM {LIVE} WHERE type = 'submission'")
def stream_submissions(t: Tables) -> DataFrame:
    return stored_feed(t, feeds.only(live(t), "submission"), "live").select("reddit_id", "author")


@query("stream_comments", f"SELECT reddit_id, body FROM {LIVE} WHERE type = 'comment'")
def stream_comments(t: Tables) -> DataFrame:
    return stored_feed(t, feeds.only(live(t), "comment"), "live").select("reddit_id", "body")


@query("stream_skip_existing", f"SELECT reddit_id FROM {LIVE} WHERE created_utc >= TIMESTAMP '2024-01-15 00:00:00'")
def stream_skip_existing(t: Tables) -> DataFrame:
    start = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return stored_feed(t, feeds.skip_existing(live(t), start), "live").select("reddit_id")


@query("stream_by_entity", f"""SELECT 'subreddit' AS entity, reddit_id FROM {LIVE} WHERE subreddit = 'n3'
    UNION ALL SELECT 'redditor', reddit_id FROM {LIVE} WHERE author = 'u/7'""")
def stream_by_entity(t: Tables) -> DataFrame:
    one = stored_feed(t, feeds.by_entity(live(t), subreddit="n3"), "live").select(F.lit("subreddit").alias("entity"), "reddit_id")
    two = stored_feed(t, feeds.by_entity(live(t), redditor="u/7"), "live").select(F.lit("redditor").alias("entity"), "reddit_id")
    return one.unionByName(two)


@query("sink_stream_append", f"SELECT type, reddit_id, subreddit, author, {iso('created_utc')} AS created_utc, body FROM {LIVE}")
def sink_stream_append(t: Tables) -> DataFrame:
    return stored_feed(t, live(t), "live").withColumn("created_utc", iso_time("created_utc"))


@query("sink_stream_console", "SELECT count(*) AS shown FROM events")
def sink_stream_console(t: Tables) -> DataFrame:
    counts = scratch_path(t.spark, "console-counts")
    feeds.show(live(t), scratch_path(t.spark, "console-checkpoint"), counts, rows=0).awaitTermination()
    return t.spark.read.schema("shown BIGINT").parquet(counts).agg(F.sum("shown").alias("shown"))


@query("stream_session_stats", f"""SELECT type, subreddit, {iso('min(created_utc)')} AS stream_start, {iso('max(created_utc)')} AS stream_end,
      count(*) AS items, strftime(make_timestamp((epoch_us(max(created_utc)) - epoch_us(min(created_utc))) // 1000000 % 86400 * 1000000), '%H:%M:%S') AS stream_duration
    FROM {LIVE} GROUP BY 1, 2""")
def stream_session_stats(t: Tables) -> DataFrame:
    stored = stored_feed(t, live(t), "live")
    rows = feeds.session_stats(stored, ["type", "subreddit"], "created_utc")
    return rows.withColumn("stream_start", iso_time("stream_start")).withColumn("stream_end", iso_time("stream_end"))


@query("stream_session_windows", f"""
    WITH items AS (SELECT type, subreddit, created_utc AS seen, CASE WHEN created_utc > lag(created_utc) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS starts
      FROM {LIVE} WINDOW w AS (PARTITION BY type, subreddit ORDER BY created_utc)),
    numbered AS (SELECT *, sum(starts) OVER (PARTITION BY type, subreddit ORDER BY seen) AS burst FROM items),
    bursts AS (SELECT type, subreddit, min(seen) AS a, max(seen) AS b, count(*) AS items FROM numbered GROUP BY type, subreddit, burst)
    SELECT type, subreddit, {iso('a')} AS stream_start, {iso('b')} AS stream_end, items,
      strftime(make_timestamp((epoch_us(b) - epoch_us(a)) // 1000000 % 86400 * 1000000), '%H:%M:%S') AS stream_duration
    FROM bursts WHERE b + INTERVAL 2 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE""")
def stream_session_windows(t: Tables) -> DataFrame:
    """Bursts of the live feed by community; the feed lands in three parts, with a restart before each."""
    landing, path, checkpoint = (scratch_path(t.spark, name) for name in ("live-landing", "bursts", "bursts-checkpoint"))
    items = t.stored("events").selectExpr(*FEED).withColumn("created_utc", F.col("created_utc").cast("timestamp"))
    for part in ("created_utc < '2024-01-11'", "created_utc >= '2024-01-11' AND created_utc < '2024-01-21'", "created_utc >= '2024-01-21'"):
        items.where(part).hint("rebalance").write.mode("append").parquet(landing)
        arriving = feeds.parquet_feed(t.spark, landing, "*.parquet", items.schema)
        windows = feeds.session_windows(arriving, ["type", "subreddit"], "created_utc", "2 hours", "10 minutes")
        feeds.store_session_windows(windows, path, checkpoint).awaitTermination()
    rows = t.spark.read.schema(windows.schema).parquet(path)
    return rows.withColumn("stream_start", iso_time("stream_start")).withColumn("stream_end", iso_time("stream_end"))


@query("stream_word_counts", counted(MIXED))
def stream_word_counts(t: Tables) -> DataFrame:
    schema = t.stored("documents").schema
    texts = feeds.table_feed(t.spark, t.folder, "documents", schema)
    submission = F.struct(F.lit("submission").alias("type"), F.col("text").alias("selftext"), F.concat_ws(" ", "lang", "source").alias("title"))
    comment = F.struct(F.lit("comment").alias("type"), F.col("text").alias("body"))
    item = F.when(F.col("lang") == "en", F.to_json(submission)).when(F.col("lang") == "fr", F.to_json(comment)).otherwise(F.lit('"FORBIDDEN"'))
    arriving = texts.select(F.parse_json(item).alias("item"))
    path, checkpoint = scratch_path(t.spark, "counts"), scratch_path(t.spark, "counts-checkpoint")
    feeds.store_word_counts(arriving, path, checkpoint).awaitTermination()
    return feeds.total_counts(t.spark.read.schema("word STRING, frequency BIGINT").parquet(path))


@query("stream_incremental_ingest", "SELECT reddit_id, author, score FROM comments")
def stream_incremental_ingest(t: Tables) -> DataFrame:
    schema = t.stored("lineitem").schema
    arriving = arrivals(feeds.table_feed(t.spark, t.folder, "lineitem", schema))
    path, checkpoint = scratch_path(t.spark, "ingested"), scratch_path(t.spark, "ingested-checkpoint")
    load = feeds.store_new_rows(path, [F.asc(c) for c in FIRST_COPY], comment_rows)
    feeds.ingest_stream(arriving, load, checkpoint).awaitTermination()
    return t.spark.read.schema("reddit_id STRING, author STRING, score INT").parquet(path).select("reddit_id", "author", "score")


def land_hour(rows: DataFrame, hour: Column, k: int, path: str) -> None:
    """The rows of hour ``k``, in files that have just arrived."""
    arrived = F.lit(f"2024-01-01 {k:02d}:00:00").cast("timestamp")
    rows.where(hour == k).withColumn("arrived", arrived).hint("rebalance").write.mode("append").parquet(path)


@query("stream_ingest_parents", """WITH known AS (SELECT * FROM submissions WHERE processing_status <> 'pending')
    SELECT 'submissions' AS part, reddit_id, id AS submission_row, subreddit_id FROM known
    UNION ALL SELECT 'comments', c.reddit_id, k.id, k.subreddit_id FROM comments c JOIN known k ON c.submission_id = k.reddit_id
    UNION ALL SELECT 'queue', k.reddit_id, k.id, NULL FROM known k
    UNION ALL SELECT 'queue', c.reddit_id, c.id, NULL FROM comments c JOIN known k ON c.submission_id = k.reddit_id""")
def stream_ingest_parents(t: Tables) -> DataFrame:
    """Posts and comments that arrive hour by hour, a post before, with or after its comments; pending posts never come.

    The load is started again for each hour and goes on from its checkpoint.
    """
    landing, folder, checkpoint = (scratch_path(t.spark, name) for name in ("landing", "loaded", "loaded-checkpoint"))
    posts = t.submissions.where("processing_status <> 'pending'").select("reddit_id", "id", "subreddit_id")
    comments = raw_batch(t).select("reddit_id", "id", "link_id", "ord")
    as_of = F.lit("2024-02-01").cast("timestamp")
    for k in range(3):
        land_hour(posts, F.col("reddit_id").cast("bigint") % 3, k, f"{landing}/posts")
        land_hour(comments, (F.split("reddit_id", "-")[0].cast("bigint") + F.col("ord")) % 3, k, f"{landing}/comments")
        arriving = [
            feeds.parquet_feed(t.spark, f"{landing}/{name}", "*.parquet", t.spark.read.parquet(f"{landing}/{name}").schema, bytes_per_trigger=512 << 20)
            for name in ("posts", "comments")
        ]
        feeds.ingest_with_parents(*arriving, folder, checkpoint, as_of, [F.asc("id")]).awaitTermination()
    read = lambda name, schema: t.spark.read.schema(schema).parquet(f"{folder}/{name}")
    subreddit = posts.schema["subreddit_id"].dataType.simpleString()
    stored = read("submissions", f"reddit_id string, id string, subreddit_id {subreddit}")
    placed = read("comments", f"reddit_id string, submission_row string, subreddit_id {subreddit}")
    parts = [
        stored.selectExpr("'submissions' AS part", "reddit_id", "id AS submission_row", "subreddit_id"),
        placed.selectExpr("'comments'", "reddit_id", "submission_row", "subreddit_id"),
    ]
    for name in ("submissions", "comments"):
        queued = read(f"queue/{name}", "reddit_id string, content_id string")
        parts.append(queued.selectExpr("'queue'", "reddit_id", "content_id", f"CAST(NULL AS {subreddit})"))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("cleanup_processed_files", """SELECT source, count(*) AS items FROM documents WHERE lang <> 'de' GROUP BY 1""")
def cleanup_processed_files(t: Tables) -> DataFrame:
    landing = write_livestream(t)
    arriving = feeds.json_feed(t.spark, landing, LIVESTREAM_FILE, clean="archive", archive=scratch_path(t.spark, "processed"))
    items = arriving.select(F.col("livestream_settings.subreddit").alias("source"), F.size("data").alias("n"))
    stored = stored_feed(t, items, "cleaned")
    return stored.groupBy("source").agg(F.sum("n").alias("items"))
