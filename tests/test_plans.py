"""Plans: no pairwise joins, pushed filters, limits before the shuffle, split hot keys."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadloom.operators import enrich, reads, stats
from threadloom.plans.bindings import Tables
from threadloom.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no stored tables")

# Lazy queries: their plan is whole, nothing runs while they are built.
LAZY = [
    "recent_submissions", "keyword_search", "title_search", "subreddit_stats", "post_comment_stats", "full_post",
    "top5_comments_per_submission", "banded_comment_preview", "ingest_batch", "entity_mentions", "benefit_mentions", "mixed_type_filter",
    "naming_conflicts", "locate_comment_file", "queue_with_content", "session_log_to_state", "claim_item_if_pending",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
def test_literal_cutoff_reaches_the_scan(spark):
    t = Tables(spark, FOLDER)
    rows = reads.recent_submissions(t.posts, t.subreddits, F.lit("2001-08-01").cast("timestamp_ntz"))
    text = plan(rows.select("reddit_id"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)
    assert "TakeOrderedAndProject" in text


@needs_tables
def test_comment_statistics_read_few_columns_and_combine_early(spark):
    t = Tables(spark, FOLDER)
    text = plan(stats.post_comment_stats(t.posts, t.raw_comments))
    assert "partial_max(score" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


@needs_tables
def test_profiles_are_parsed_once_in_many_tasks(spark):
    text = plan(QUERIES["redditor_information"](spark, FOLDER))
    assert "get_json_object" not in text and "Exchange hashpartitioning(c_custkey" in text


@needs_tables
def test_thread_links_come_from_the_raw_feed(spark):
    from threadloom.plans.threads_words import LINKS

    t = Tables(spark, FOLDER)
    links = t.raw_comments.select(*LINKS)
    assert set(map(tuple, links.collect())) == set(map(tuple, t.comments.select(*LINKS).collect()))
    # No copies are told apart by the other columns on the way to the threads.
    assert "l_shipdate" not in plan(links)


def test_runs_are_built_only_where_an_alias_goes_on(spark):
    posts = spark.createDataFrame([(1, "The North Sea Gold card. Gold!")], "post_id int, body string")
    names = spark.createDataFrame([("card", "north sea gold"), ("other", "gold")], "canonical string, alias string")
    text = plan(enrich.entity_mentions(posts, names))
    # No run for each word, places meet the dictionary by a long, and no filter cuts a sentence into words a second time.
    assert "explode(transform(__words" not in text
    assert re.search(r"\[__at2#\d+L\]", text)
    assert not re.search(r"Filter .*split\(sentence", text)


def test_hot_key_is_split_in_a_join(spark):
    """A third of the rows under one key: adaptive execution cuts that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
        rows = spark.range(0, 200000, 1, 16).select(key.alias("subreddit_id"), F.rand(1).alias("x"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        names = spark.range(500).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"))
        from threadloom.operators.views import with_subreddit

        joined = with_subreddit(rows, names)
        assert joined.select(F.count("subreddit"), F.max("pad")).first()[0] == 200000
        stored = joined.select("subreddit", "x", "pad")
        stored.write.format("noop").mode("overwrite").save()
        executed = joined.toArrow()
        assert executed.num_rows == 200000
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
