"""Scalar expressions on literal inputs."""

import pytest
from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.functions import text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("[t(e)s,t:i;n.}g{a<s>t`r]ing", "t e s t i n  g a s t r ing"),
        ("\x1c　 plain \n", "plain"),
        ("(.)", ""),
        ("line\nbreak", "line\nbreak"),
    ],
)
def test_clean_word(spark, given, expected):
    assert value(spark, X.clean_word(F.lit(given))) == expected
    assert "".join(" " if c in X.BLANKED else c for c in given).strip() == expected


def test_edge_space_is_what_python_strips():
    spaces = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(X.EDGE_SPACE) == spaces


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://www.reddit.com/r/x/comments/abc123/title/", "abc123"),
        ("comments/abc", "abc"),
        ("https://www.reddit.com/r/x/comments", ""),
        ("https://www.reddit.com/r/mycomments/abc", ""),
        ("/r/x/comments/", ""),
    ],
)
def test_post_id_from_url(spark, url, expected):
    assert value(spark, S.post_id_from_url(F.lit(url))) == expected


def test_ids_and_labels(spark):
    assert value(spark, S.bare_id(F.lit("t1_abc"))) == "abc"
    assert value(spark, S.bare_id(F.lit("abc"))) == "abc"
    assert value(spark, S.author_label(F.lit("x"))) == "u/x"
    assert value(spark, S.author_label(F.lit(None).cast("string"))) == "[deleted]"
    assert value(spark, S.is_reply(F.lit("t1_b"), F.lit("a"))) is True
    assert value(spark, S.is_reply(F.lit("t3_a"), F.lit("a"))) is False


def test_times(spark):
    assert value(spark, S.epoch_to_time(F.lit(1592291124.0))) == "2020-06-16 07:05:24"
    assert value(spark, S.duration_hms(F.lit(3661))) == "01:01:01"
    assert value(spark, S.duration_hms(F.lit(86400 + 59))) == "00:00:59"
    ts = F.lit("2024-01-01 00:00:07.179575").cast("timestamp")
    assert value(spark, S.iso_time(ts)) == "2024-01-01T00:00:07.179575"
    assert value(spark, S.iso_time(F.lit("2024-01-01").cast("timestamp"))) == "2024-01-01T00:00:00"
    assert value(spark, S.parse_time(F.lit("no time"))) is None
    assert value(spark, S.seconds_between(F.lit("2024-01-01 00:00:00"), F.lit("2024-01-01 00:02:00.9"))) == 120


@pytest.mark.parametrize(
    "given, flag, at",
    [("false", False, None), ('"2020-06-16 07:05:24"', True, "2020-06-16 07:05:24"), ("true", True, None)],
)
def test_edited(spark, given, flag, at):
    edited = F.parse_json(F.lit(given))
    assert value(spark, S.edited_flag(edited)) is flag
    assert value(spark, S.edited_at(edited)) == at


def test_codes_sizes_dates(spark):
    assert value(spark, S.category_code(F.lit("T"))) == "t"
    assert value(spark, S.category_name(F.lit("R"))) == "rising"
    assert value(spark, S.category_name(F.lit("x"))) == "x"
    assert value(spark, S.size_mb(F.lit(1572864))) == 1.5
    assert value(spark, S.compression_ratio(F.lit(200), F.lit(50))) == 75.0
    assert value(spark, S.compression_ratio(F.lit(0), F.lit(50))) == 0.0
    assert value(spark, S.key_schedule(F.lit("daily_scrapes/x/y.zip"))) == "daily"
    assert value(spark, S.key_second_part(F.lit("daily_scrapes/x/y.zip"))) == "x"
    assert value(spark, S.key_second_part(F.lit("alone"))) is None
    assert value(spark, S.normalize_date(F.lit("2024/01/02"))) == "2024-01-02"
    assert value(spark, S.normalize_date(F.lit("20240102"))) is None
    assert [value(spark, S.score_band(F.lit(n))) for n in (10, 9, 1, 0, -3)] == ["high", "medium", "medium", "low", "low"]
    assert value(spark, S.null_to_zero(F.lit(None).cast("int"))) == 0


def test_config_maps_and_signatures(spark):
    config = F.create_map(F.lit("name"), F.lit("a"), F.lit("schedule"), F.lit("daily"))
    assert value(spark, S.without_schedule(config)) == {"name": "a"}
    rows = spark.createDataFrame([("a", None), ("a", "")], "name string, keywords string")
    hashes = [r["h"] for r in rows.select(S.short_hash(S.config_text("name", "keywords")).alias("h")).collect()]
    assert len(hashes[0]) == 8 and hashes[0] == hashes[1]


def test_previews_and_names(spark):
    assert value(spark, X.preview(F.lit("abc"), 2)) == "ab..."
    assert value(spark, X.preview_if_longer(F.lit("abc"), 3)) == "abc"
    assert value(spark, X.preview_if_longer(F.lit("abcd"), 3)) == "abc..."
    assert value(spark, X.one_line(F.lit("a\nb"))) == "a b"
    assert value(spark, X.truncate_name(F.lit("x" * 51))) == "x" * 48 + "--"
    assert value(spark, X.truncate_name(F.lit("x" * 50))) == "x" * 50
    assert value(spark, X.safe_name(F.lit('a/b\\c?"d"'))) == "a_b_c__d_"
    assert value(spark, X.mask_numbers(F.lit("card 1234567890, mail a.b@c.org, call +91 98765 43210, 123456"))) == (
        "card ••••, mail , call , 123456"
    )


@pytest.mark.parametrize(
    "term, literal, expected",
    [("a%b_", False, "%a%b_%"), ("a\\b", False, "%ab%"), ("a\\%b", False, "%a\\%b%"), ("x\\", False, "%x%"), ("a%\\", True, "%a\\%\\\\%")],
)
def test_like_pattern(term, literal, expected):
    assert X.like_pattern(term, literal) == expected
