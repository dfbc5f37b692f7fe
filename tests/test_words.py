"""Word frequencies on small literal inputs."""

from pyspark.sql import functions as F

from threadloom.operators import words


def as_dict(df):
    return {r["word"]: r["frequency"] for r in df.collect()}


def test_submissions_count_both_fields(spark):
    rows = [("This is a test selftext", "This is a test title")] * 2
    counts = as_dict(words.submission_words(spark.createDataFrame(rows, "selftext string, title string")))
    assert counts == {"This": 4, "is": 4, "a": 4, "test": 4, "selftext": 2, "title": 2}


def test_null_field_and_case_and_newline(spark):
    rows = [(None, "Word word\nword (word)")]
    counts = as_dict(words.submission_words(spark.createDataFrame(rows, "selftext string, title string")))
    assert counts == {"Word": 1, "word\nword": 1, "word": 1}


def test_pieces_that_clean_to_the_same_word_add_up(spark):
    df = spark.createDataFrame([("(word) word. word, [word] a.b",)], "body string")
    assert as_dict(words.comment_words(df)) == {"word": 4, "a b": 1}


def test_mixed_feed_skips_strings_and_untyped(spark):
    items = [
        '{"type": "submission", "selftext": "This is selftext", "title": "This is a title"}',
        '{"type": "comment", "body": "This body"}',
        '"FORBIDDEN"',
        '{"body": "FORBIDDEN"}',
        '{"type": "comment"}',
    ]
    feed = spark.createDataFrame([(i,) for i in items], "j string").select(F.parse_json("j").alias("item"))
    counts = as_dict(words.mixed_words(feed))
    assert counts == {"This": 3, "is": 2, "a": 1, "selftext": 1, "title": 1, "body": 1}


def test_sum_of_counts_is_number_of_words(spark):
    df = spark.createDataFrame([(f"a b{i % 7} c{i} ",) for i in range(500)], "body string")
    counts = words.comment_words(df)
    assert counts.agg(F.sum("frequency")).first()[0] == 1500


def test_ties_keep_first_appearance(spark):
    rows = [("f", 0, "b a b"), ("f", 1, "c a d"), ("g", 0, "z")]
    df = spark.createDataFrame(rows, "file string, position bigint, text string")
    ordered = words.words_by_frequency(df, ["text"], "position", by=["file"]).collect()
    assert [(r["file"], r["word"], r["frequency"]) for r in ordered] == [
        ("f", "b", 2), ("f", "a", 2), ("f", "c", 1), ("f", "d", 1), ("g", "z", 1),
    ]


def test_cloud_weights(spark):
    df = spark.createDataFrame([("f", "a", 4), ("f", "b", 2), ("f", "c", 1), ("g", "a", 1)], "file string, word string, frequency bigint")
    rows = words.cloud_weights(df, ["file"], top=2).collect()
    assert sorted((r["file"], r["word"], r["weight"]) for r in rows) == [("f", "a", 1.0), ("f", "b", 0.5), ("g", "a", 1.0)]
