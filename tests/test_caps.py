"""Nothing is lost at sizes beyond the usual ones."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from threadloom.operators import enrich, ingest, ranking, threads, words
from threadloom.sources import documents
from threadloom.streaming import feeds


def test_alias_of_six_words(spark):
    posts = spark.createDataFrame([(1, "I like the North Sea Gold Reader Plus Card, and cards.")], "post_id int, body string")
    names = spark.createDataFrame(
        [("card", "north sea gold reader plus card"), ("other", "gold"), ("none", "no such words at all here")], "canonical string, alias string"
    )
    found = {(r["canonical"], r["form"]) for r in enrich.mentions(posts, names).collect()}
    assert found == {("card", "North Sea Gold Reader Plus Card"), ("other", "Gold")}
    assert enrich.mentions(posts, names.limit(0)).count() == 0


def test_aliases_of_any_size_against_plain_search(spark):
    rng = random.Random(4)
    spoken = rng.choices(["a", "B", "b", "c", "É", "x9"], k=4000)
    posts = [(1, " ".join(spoken)), (2, "a, b! A b. c-c\nb"), (3, ""), (4, None)]
    names = {tuple(w.lower() for w in spoken[i : i + n]) for n in (1, 2, 3, 4, 5, 7, 9, 30) for i in rng.sample(range(3900), 3)}
    names |= {("a", "b", "c", "d"), ("nowhere",)}
    aliases = spark.createDataFrame([(f"n{k % 7}", " ".join(n).upper()) for k, n in enumerate(sorted(names))], "canonical string, alias string")
    expected = set()
    for post, sentence, words in ((1, 0, spoken), (2, 0, ["a", "b"]), (2, 1, ["A", "b"]), (2, 2, ["c", "c"]), (2, 3, ["b"])):
        for k, name in enumerate(sorted(names)):
            for i in range(len(words) - len(name) + 1):
                if tuple(w.lower() for w in words[i : i + len(name)]) == name:
                    expected.add((post, sentence, f"n{k % 7}", " ".join(words[i : i + len(name)])))
    frame = spark.createDataFrame(posts, "post_id int, body string")
    found = [tuple(r) for r in enrich.mentions(frame, aliases).collect()]
    assert set(found) == expected and len(found) == len(expected)
    counted = {(r["canonical"], r["form"], r["post_id"]): r["sentences"] for r in enrich.entity_mentions(frame, aliases).collect()}
    per_form = Counter((c, form, post) for post, _, c, form in expected)
    assert counted == dict(per_form)


def test_only_sentences_beside_a_perk_are_searched_for_entities(spark, monkeypatch):
    searched, search = [], enrich._forms
    monkeypatch.setattr(enrich, "_forms", lambda *args: searched.append(args[0]) or search(*args))
    told = ["A Gold card."] * 40
    told[0] = told[20] = "Gold: Lounge access, lounge."
    posts = [(1, " ".join(told)), (2, "Gold. Gold card."), (3, "Miles\nNone. Gold"), (3, "Silver"), (3, "Silver\nGold"), (None, "Gold lounge"), (4, None)]
    names = spark.createDataFrame([("card", "gold card"), ("metal", "gold"), ("metal", "silver")], "canonical string, alias string")
    perks = spark.createDataFrame([("rest", "lounge access"), ("air", "lounge"), ("air", "miles")], "benefit string, keyword string")
    found = [tuple(r) for r in enrich.benefit_mentions(spark.createDataFrame(posts, "post_id int, body string"), names, perks).collect()]
    expected = {(1, n, "metal", b) for n in (0, 1, 19, 20, 21) for b in ("rest", "air")}
    expected |= {(1, n, "card", b) for n in (1, 19, 21) for b in ("rest", "air")}
    # Rows of one post id are one post.
    expected |= {(3, n, "metal", "air") for n in (0, 1)}
    assert set(found) == expected and len(found) == len(expected)
    # Of post 1 five sentences, of post 3 all but the last of its first row.
    assert searched[-1].count() == 5 + 5


def test_positions_beyond_32_bits(spark):
    rows = [(1 << 40, "b a"), ((1 << 40) + 1, "a c"), (5_000_000_000, "c d")]
    found = words.words_by_frequency(spark.createDataFrame(rows, "at bigint, text string"), ["text"], "at").collect()
    assert [r["word"] for r in found] == ["c", "a", "d", "b"]
    assert int(found[0]["first_at"]) == 5_000_000_000 * 2**31


def test_bare_lists_keep_every_object(spark, tmp_path):
    lists = {
        "mistyped": [{"id": "a", "score": 1}, {"id": "b", "score": "many"}, {"id": "c", "score": 3}],
        "marked": ["FORBIDDEN", {"id": "d"}, {"id": "e"}, 7, None],
        "nameless": [{"title": "no id"}],
    }
    for name, items in lists.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(items, indent=2))
    (tmp_path / "wrapped.json").write_text(json.dumps({"scrape_settings": {"subreddit": "s"}, "data": [{"id": "w"}, "x"]}, indent=2))
    (tmp_path / "broken.json").write_text('{"scrape_settings": {')
    found = documents.submission_scrapes(spark, str(tmp_path)).collect()
    assert sorted((r["id"] or "", r["score"]) for r in found) == [
        ("", None), ("a", 1), ("b", None), ("c", 3), ("d", None), ("e", None), ("w", None),
    ]
    assert {r["id"]: (r["subreddit"], r["pos"]) for r in found}["w"] == ("s", 0)
    assert {r["id"]: r["pos"] for r in found}["e"] == 2


def test_wrapped_files_beyond_one_variant(spark, tmp_path):
    # 135 MiB of items in one file, more than Spark allows for one VARIANT.
    filler = "x" * (5 << 20)
    items = [{"id": f"i{k}", "selftext": filler} for k in range(27)]
    (tmp_path / "large.json").write_text(json.dumps({"scrape_settings": {"subreddit": "s"}, "data": items}))
    (tmp_path / "wide.json").write_text(json.dumps({"data": [{"id": "w"}]}), encoding="utf-16")
    (tmp_path / "record.json").write_text(json.dumps({"id": "alone"}))
    (tmp_path / "other.json").write_text(json.dumps({"data": {"id": "no list"}}))
    found = documents.submission_scrapes(spark, str(tmp_path)).select("id", "subreddit", "pos", F.length("selftext").alias("n")).collect()
    expected = [("alone", None, None, None), *((f"i{k}", "s", k, 5 << 20) for k in range(27)), ("w", None, 0, None)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_large_top_k_needs_no_group_in_one_task(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), (F.col("id") % 50).alias("score"), F.col("id"))
    top = ranking.top_per_group(rows, ["k"], [F.desc("score"), F.asc("id")], 1001, "position")
    expected = sorted(((-(i % 50), i) for i in range(5000)))[:1001]
    assert [(-r["score"], r["id"]) for r in top.orderBy("position").collect()] == expected
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_console_counts_more_than_a_hundred_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(105):
        (landing / f"{k}.json").write_text('{"a": 1}\n')
    feed = feeds.json_feed(spark, str(landing), "a int", files_per_trigger=1)
    feeds.show(feed, str(tmp_path / "checkpoint"), str(tmp_path / "counts"), rows=0).awaitTermination()
    counts = spark.read.schema("shown bigint, batch int").parquet(str(tmp_path / "counts"))
    assert counts.agg(F.sum("shown"), F.count("*")).first() == (105, 105)


def test_repeated_comment_id_multiplies_nothing(spark):
    rows = [("a", "t3_p", "t3_p", 1), ("b", "t1_a", "t3_p", 2), ("b", "t1_a", "t3_p", 3), ("c", "t1_b", "t3_p", 4)]
    comments = spark.createDataFrame(rows, "reddit_id string, parent_id string, link_id string, ord bigint")
    placed = threads.thread_depth(comments).collect()
    assert sorted((r["id"], r["depth"]) for r in placed) == [("a", 0), ("b", 1), ("c", 2)]


def test_last_value_of_a_request_wins(spark):
    known = spark.createDataFrame([(1, "x", "x", None, 5)], "id int, name string, display_name string, description string, subscribers bigint")
    asked = spark.createDataFrame(
        [("x", None, "new", 1000, 1), ("x", None, "old", 900, 2), ("x", None, None, None, 3)],
        "name string, display_name string, description string, subscribers bigint, seq int",
    )
    row = ingest.get_or_create_subreddits(known, asked).first()
    assert (row["description"], row["subscribers"], row["created"]) == ("old", 900, False)


def test_reads_of_stored_comments_have_no_window(spark):
    from threadloom.plans.catalog import QUERIES

    for name in ("author_comments", "latest_comments", "api_comment_view"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan, name
