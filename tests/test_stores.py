"""Stores made for one kind of read: trigram blocks, buckets of ids, Bloom filters."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import ingest, reads, substring_index
from threadloom.sinks import writers
from threadloom.sources.tables import append_bucketed

SHAPE = "id int, title string, body string"
FIELDS = ["title", "body"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def posts(spark):
    pick = random.Random(7)
    word = lambda: "".join(pick.choice("abİßΣé%_\\") for _ in range(pick.randint(1, 6)))
    rows = [(i, " ".join(word() for _ in range(3)), " ".join(word() for _ in range(8))) for i in range(400)]
    rows += [(400, None, ""), (401, "", None), (402, "ab", "x" * 4095 + "needle" + "y" * 9000), (403, "one😀two", "NEEDLE at 100%")]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "store")
    substring_index.write_indexed(posts(spark).coalesce(4), path, FIELDS, blocks=16)
    return path


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_candidates_hold_every_hit(spark, indexed):
    pick = random.Random(8)
    terms = ["needle", "e😀t", "100%", "n_edl", "", "a", "ab", "\\%", "ß%a", "missing term", "ΣAB"]
    terms += ["".join(pick.choice("abİßΣé%_\\ ") for _ in range(pick.randint(3, 5))) for _ in range(12)]
    whole = posts(spark).cache()
    for term in terms:
        for literal in (False, True):
            keywords = [term, "needle"] if len(term) % 2 else [term]
            test = reads.matches_any(keywords, FIELDS, literal)
            found = substring_index.candidates(spark, indexed, SHAPE, keywords, FIELDS, literal)
            assert ids(found.where(test)) == ids(whole.where(test)), (term, literal)


def test_only_candidate_blocks_are_read(spark, indexed):
    found = substring_index.candidates(spark, indexed, SHAPE, ["needle"], FIELDS)
    assert found.count() < 200 and {402, 403} <= set(ids(found))
    assert "dynamicpruning" in plan(found)
    title = substring_index.candidates(spark, indexed, SHAPE, ["needle"], ["title"])
    assert title.count() == 0
    assert substring_index.candidates(spark, indexed, SHAPE, ["ne"], FIELDS).count() == 404
    assert substring_index.candidates(spark, indexed, SHAPE, [], FIELDS).count() == 404


def test_postings_hold_each_block_once(spark, indexed):
    postings = spark.read.parquet(f"{indexed}/postings")
    assert postings.count() == postings.distinct().count() > 0


def test_index_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    substring_index.write_indexed(spark.createDataFrame([], SHAPE), path, FIELDS)
    assert substring_index.candidates(spark, path, SHAPE, ["needle"], FIELDS).count() == 0


def test_stored_buckets_are_not_exchanged(spark, tmp_path):
    shape = "reddit_id string, id string, subreddit_id int, link_id string"
    row = lambda i: (f"r{i}", f"s{i}", i % 5, f"t3_r{i % 40}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("DROP TABLE IF EXISTS stored_for_test")
    try:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = str(tmp_path / "stored")
        append_bucketed(spark.createDataFrame([row(i) for i in range(20)], shape), "stored_for_test", path, "reddit_id", buckets)
        stored = append_bucketed(spark.createDataFrame([row(i) for i in range(20, 30)], shape), "stored_for_test", path, "reddit_id", buckets)
        batch = spark.createDataFrame([row(i) for i in [*range(25, 60), *range(55, 60)]], shape)
        new = ingest.new_rows(batch, stored, [F.asc("id")])
        assert plan(new).count("Exchange hashpartitioning") == 1
        assert sorted(r["reddit_id"] for r in new.collect()) == sorted(f"r{i}" for i in range(30, 60))
        placed = ingest.comment_to_submission(batch.drop("subreddit_id"), stored)
        assert plan(placed).count("Exchange hashpartitioning") == 1
        assert placed.count() == sum(i % 40 < 30 for i in [*range(25, 60), *range(55, 60)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS stored_for_test")


def test_point_reads_skip_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("reddit_id"), F.format_string("u%07d", "id").alias("author"))
    path, size = str(tmp_path / "lookup"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1MB")
    try:
        writers.write_lookup(rows, path, "author", {"reddit_id": 50_000})
    finally:
        spark.conf.unset(size)
    stored = spark.read.parquet(path)

    def scanned(df):
        executed = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
        return executed.collectLeaves().head().metrics().get("numOutputRows").get().value()

    known = rows.first()
    by_id = stored.where(F.col("reddit_id") == known["reddit_id"])
    assert by_id.count() == 1 and by_id.first()["author"] == known["author"]
    assert scanned(stored) == 200_000
    assert scanned(stored.where(F.col("reddit_id") == "8" + "0" * 63)) == 0
    assert 0 < scanned(stored.where(F.col("author") == "u0000007")) < 100_000
    assert reads.by_author(stored.withColumn("created_utc", F.lit(1)), "u0000007").count() == 1


def test_upsert_rewrites_touched_folders_only(spark, tmp_path):
    path, shape = str(tmp_path / "table"), "id string, n int, day string"
    rows = [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, "z"), ("e", None, None), ("f", 6, None)]
    spark.createDataFrame(rows, shape).write.partitionBy("day").parquet(path)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    stored = lambda: sorted(map(tuple, spark.read.schema(shape).parquet(path).collect()), key=str)
    before = files()
    # One as it is, one changed, one that moves and leaves its folder empty, one new, one without a day.
    given = spark.createDataFrame([("c", 3, "y"), ("a", 9, "x"), ("d", 4, "x"), ("g", 7, "w"), ("e", 5, None)], shape)
    assert writers.upsert_rows(given, path, "id", "day") == 4
    after = sorted([("a", 9, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, "x"), ("e", 5, None), ("f", 6, None), ("g", 7, "w")], key=str)
    assert stored() == after
    assert {f for f in before if "day=y" in f} == {f for f in files() if "day=y" in f and files()[f] == before.get(f)}
    assert not (tmp_path / "table" / "day=z").exists()
    unchanged = files()
    assert writers.upsert_rows(given, path, "id", "day") == 0
    assert writers.upsert_rows(given.limit(0), path, "id", "day") == 0
    assert files() == unchanged
