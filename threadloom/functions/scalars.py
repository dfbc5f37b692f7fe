"""Identifiers, times, sizes, codes and flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

SITE = "https://www.reddit.com"
DELETED = "[deleted]"

# Listing categories by code.
CATEGORY_NAMES = {
    "h": "hot",
    "n": "new",
    "t": "top",
    "r": "rising",
    "c": "controversial",
    "s": "search",
}
# Categories that take a time filter, and the filters.
FILTERABLE = ["c", "s", "t"]
TIME_FILTERS = ["all", "day", "hour", "month", "week", "year"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def post_id_from_url(url: Column | str) -> Column:
    """The path part after the first ``comments`` that has a successor, else ''."""
    return F.regexp_extract(_col(url), r"(?:^|/)comments/([^/]*)", 1)


def bare_id(fullname: Column | str) -> Column:
    """``t1_abc`` -> ``abc``."""
    return F.element_at(F.split(_col(fullname), "_"), -1)


def post_url(permalink: Column | str) -> Column:
    return F.concat(F.lit(SITE), _col(permalink))


def author_label(name: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit("u/"), _col(name)), F.lit(DELETED))


def edited_at(edited: Column | str) -> Column:
    """Time text of an edit; null when the field says false."""
    text = F.try_variant_get(_col(edited), "$", "string")
    return F.when(~F.lower(text).isin("false", "true"), text)


def edited_flag(edited: Column | str) -> Column:
    text = F.try_variant_get(_col(edited), "$", "string")
    return F.coalesce(F.lower(text) != "false", F.lit(False))


def epoch_to_time(seconds: Column | str) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in the session zone (UTC)."""
    return F.from_unixtime(_col(seconds).cast("bigint"), "yyyy-MM-dd HH:mm:ss")


def parse_time(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text))


def iso_time(ts: Column | str) -> Column:
    """ISO text; the fraction shows only when there is one."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def category_code(category: Column | str) -> Column:
    return F.lower(_col(category))


def category_name(category: Column | str) -> Column:
    code = category_code(category)
    named = F.create_map(*[F.lit(v) for pair in CATEGORY_NAMES.items() for v in pair])
    return F.coalesce(F.try_element_at(named, code), code)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, cut toward zero."""
    start, end = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000).cast("int")


def duration_hms(seconds: Column | str) -> Column:
    """``HH:MM:SS``; wraps after a day."""
    s = F.pmod(_col(seconds).cast("bigint"), F.lit(86400))
    parts = [F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def size_mb(size: Column | str) -> Column:
    return F.round(_col(size) / (1024 * 1024), 2)


def compression_ratio(original: Column | str, packed: Column | str) -> Column:
    original, packed = _col(original), _col(packed)
    return F.when(original > 0, (1 - packed / original) * 100).otherwise(F.lit(0.0))


def key_schedule(key: Column | str) -> Column:
    """First part of an object key without its ``_scrapes`` ending."""
    return F.replace(F.split(_col(key), "/")[0], F.lit("_scrapes"), F.lit(""))


def key_second_part(key: Column | str) -> Column:
    return F.try_element_at(F.split(_col(key), "/"), F.lit(2))


def short_hash(text: Column | str) -> Column:
    return F.substring(F.md5(_col(text)), 1, 8)


def config_text(*fields: str) -> Column:
    """One config as canonical text; a missing field is an empty part."""
    return F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])


def normalize_date(text: Column | str) -> Column:
    """Dashes for slashes; null when there is no separator or under ten characters."""
    text = _col(text)
    valid = text.rlike("[-/]") & (F.length(text) >= 10)
    return F.when(valid, F.translate(text, "/", "-"))


def null_to_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def score_band(score: Column | str) -> Column:
    score = _col(score)
    return (
        F.when(score >= 10, "high").when(score >= 1, "medium").when(score < 1, "low")
    )


def is_reply(parent_id: Column | str, post_id: Column | str) -> Column:
    return _col(parent_id) != F.concat(F.lit("t3_"), _col(post_id))


def without_schedule(config: Column | str) -> Column:
    """A config map without the entry that cannot be serialised."""
    return F.map_filter(_col(config), lambda key, _: key != "schedule")


# Flag labels in display order.
FLAG_LABELS = {
    "is_nsfw": "NSFW",
    "is_spoiler": "SPOILER",
    "is_stickied": "STICKIED",
    "is_locked": "LOCKED",
    "is_original_content": "OC",
}


def content_flags(labels: Mapping[str, str] = FLAG_LABELS) -> Column:
    """Labels of the flags that are set."""
    return F.array_compact(F.array(*[F.when(F.col(c), F.lit(v)) for c, v in labels.items()]))
