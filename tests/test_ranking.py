"""Positions, pages and top-k with one group that holds a third of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from threadloom.operators import ranking
from threadloom.operators.ranking import in_pages, keep_first, number_rows, top_per_group


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small test data would otherwise end up in one slice."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def skewed(spark, n=6000):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}", rnd.randint(0, 5), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, score int, id bigint").repartition(16)


def test_number_rows_is_exact(spark):
    rows, df = skewed(spark)
    groups = defaultdict(list)
    for k, score, i in rows:
        groups[k].append((-score, i))
    expected = {(k, i): p for k, items in groups.items() for p, (_, i) in enumerate(sorted(items), 1)}
    numbered = number_rows(df, ["k"], [F.desc("score"), F.asc("id")])
    assert {(r["k"], r["id"]): r["position"] for r in numbered.collect()} == expected


def test_number_rows_splits_the_hot_group(spark):
    _, df = skewed(spark)
    spread = df.repartitionByRange("k", F.desc("score"), F.asc("id")).where("k = 'hot'")
    assert spread.select(F.spark_partition_id()).distinct().count() > 1


def test_number_rows_without_keys(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 7919 % 1000)
    numbered = number_rows(df, [], [F.asc("v")])
    assert {(r["v"], r["position"]) for r in numbered.collect()} == {(i, i + 1) for i in range(1000)}


def test_null_keys_are_a_group(spark):
    rows = [(None if i % 2 else "k", i) for i in range(400)]
    numbered = number_rows(spark.createDataFrame(rows, "k string, id bigint"), ["k"], [F.asc("id")])
    assert {(r["id"], r["position"]) for r in numbered.collect()} == {(i, i // 2 + 1) for i in range(400)}


def test_pages_are_whole_ordered_and_bounded(spark):
    rows, df = skewed(spark)
    pages = in_pages(df, ["k"], [F.asc("id")], F.col("id"), "ids", page_size=100).collect()
    assert max(len(p["ids"]) for p in pages) == 100
    joined = defaultdict(list)
    for p in sorted(pages, key=lambda p: (p["k"], p["page"])):
        joined[p["k"]] += p["ids"]
    expected = defaultdict(list)
    for k, _, i in rows:
        expected[k].append(i)
    assert dict(joined) == dict(expected)


def test_pages_of_small_groups_take_one_shuffle_of_the_rows(spark):
    _, df = skewed(spark)
    pages = in_pages(df, ["k"], [F.asc("id")], F.col("id"), "ids", page_size=100)
    text = pages._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in text


def test_pages_of_large_small_and_null_groups(spark, monkeypatch):
    monkeypatch.setattr(ranking, "WHOLE", 50)
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 40}", i) for i in range(1200)]
    df = spark.createDataFrame(rows, "k string, id bigint").repartition(8)
    pages = in_pages(df, ["k"], [F.desc("id")], F.col("id"), "ids", page_size=30).collect()
    found = {(p["k"], p["page"]): p["ids"] for p in pages}
    groups = defaultdict(list)
    for k, i in sorted(rows, key=lambda r: -r[1]):
        groups[k].append(i)
    expected = {(k, at // 30): ids[at : at + 30] for k, ids in groups.items() for at in range(0, len(ids), 30)}
    assert len(pages) == len(found) and found == expected


def test_top_per_group_limits_before_the_shuffle(spark):
    rows, df = skewed(spark)
    top = top_per_group(df, ["k"], [F.desc("score"), F.asc("id")], 2)
    plan = top._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    best = sorted((-s, i) for k, s, i in rows if k == "hot")[:2]
    assert sorted((-r["score"], r["id"]) for r in top.where("k = 'hot'").collect()) == best


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert sorted(map(tuple, keep_first(df, ["k"], [F.asc("v")]).collect())) == [("a", 1), ("b", 3)]


def test_ties_fall_alike_on_both_sides_of_the_threshold(spark):
    rows = spark.range(3000).select(F.lit("g").alias("k"), (F.col("id") % 3).alias("score"), F.col("id"))
    few = top_per_group(rows, ["k"], [F.desc("score")], 900, "position")
    many = top_per_group(rows, ["k"], [F.desc("score")], 1500, "position").where("position <= 900")
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()}
