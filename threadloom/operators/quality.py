"""Checks on scrape requests, entities, settings and stored values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import CATEGORY_NAMES, FILTERABLE, TIME_FILTERS, config_text, short_hash

# Allowed values of the enumerated columns.
ENUMS = {
    "task_type": ["scheduled", "manual"],
    "category": list(CATEGORY_NAMES),
    "time_filter": TIME_FILTERS,
    "status": ["success", "failed", "skipped", "pending", "running"],
    "processing_status": ["pending", "processing", "completed", "failed", "skipped"],
}

# Characters that make a result count invalid.
BAD_COUNT = r"[@_!#$%^&*()<>?/\\|}{~:+`=]"


def _violations(requests: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per request and broken rule, in one pass without a shuffle."""
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return requests.select("request_id", F.explode(broken).alias("violation"))


def _whole_number(text: str) -> Column:
    """What a whole number looks like: sign, digits, single underscores inside, blanks around."""
    return F.col(text).rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")


def _is_zero(text: str) -> Column:
    return F.col(text).rlike(r"^\s*[+-]?0+(_0+)*\s*$")


def subreddit_request_violations(requests: DataFrame) -> DataFrame:
    """Requests: ``request_id, category, n_results, time_filter``."""
    code = F.lower("category")
    known = code.isin(list(CATEGORY_NAMES))
    has_filter = F.col("time_filter").isNotNull()
    takes_filter = code.isin(FILTERABLE)
    counted = known & (code != "s")
    return _violations(
        requests,
        {
            "invalid category": ~known,
            "time filter not available": known & has_filter & ~takes_filter,
            "invalid time filter": known & has_filter & takes_filter & ~F.lower("time_filter").isin(TIME_FILTERS),
            "invalid result count": counted & (~_whole_number("n_results") | _is_zero("n_results")),
        },
    )


def redditor_request_violations(requests: DataFrame) -> DataFrame:
    """Requests: ``request_id, n_results``; letters, symbols and zero are refused."""
    bad = F.col("n_results").rlike(r"\p{L}") | F.col("n_results").rlike(BAD_COUNT)
    return _violations(requests, {"invalid result count": bad | ~_whole_number("n_results") | _is_zero("n_results")})


def comment_request_violations(requests: DataFrame) -> DataFrame:
    """As for redditors, but zero asks for all comments."""
    bad = F.col("n_results").rlike(r"\p{L}") | F.col("n_results").rlike(BAD_COUNT)
    return _violations(requests, {"invalid result count": bad})


def default_time_filter(requests: DataFrame) -> DataFrame:
    """The given filter, ``all`` where the category takes one, else null."""
    default = F.when(F.lower("category").isin(FILTERABLE), F.lit("all"))
    return requests.withColumn("time_filter", F.coalesce("time_filter", default))


def validate_entities(requested: DataFrame, known: DataFrame, key: str = "name") -> DataFrame:
    """Every requested name with the verdict; names asked for twice come twice."""
    ids = known.select(key).distinct().withColumn("valid", F.lit(True))
    return requested.join(ids, key, "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


def except_known(requested: DataFrame, known: DataFrame, key: str = "name") -> DataFrame:
    return requested.join(known.select(key).distinct(), key, "left_anti")


def settings_for_valid(requests: DataFrame, known: DataFrame) -> DataFrame:
    """All settings of every valid community name."""
    return default_time_filter(requests).join(known.select("name").distinct(), "name", "left_semi")


def last_setting_for_valid(requests: DataFrame, known: DataFrame) -> DataFrame:
    """One setting per valid name: the last one asked for."""
    last = requests.groupBy("name").agg(F.max_by("n_results", "request_id").alias("n_results"))
    return last.join(known.select("name").distinct(), "name", "left_semi")


def enum_violations(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values outside their enumeration; the row itself is kept elsewhere."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & ~F.col(c).isin(ENUMS[c]),
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")),
                )
                for c in columns
            ]
        )
    )
    return table.select(F.col(key).alias("row_id"), F.inline(found))


# The longest list of names that stands as it is.
LONGEST_NAMES = 50


def config_sets(configs: DataFrame, keys: list[str], name: str = "name", fields: tuple[str, ...] = ("name", "category", "time_filter", "n_results", "keywords")) -> DataFrame:
    """Each run's set of configs: a signature that no order of them changes, and its subjects, hashed where the list is long.

    ``keys`` name a run, whose configs are few.
    """
    texts = F.sort_array(F.collect_list(config_text(*fields)))
    names = F.array_join(F.sort_array(F.collect_set(name)), "_")
    sets = configs.groupBy(*keys).agg(short_hash(F.array_join(texts, "\n")).alias("signature"), names.alias("__names"), F.count("*").alias("configs"))
    subjects = F.when(F.length("__names") > LONGEST_NAMES, F.concat(F.lit("multi_"), short_hash("__names"))).otherwise(F.col("__names"))
    return sets.select(*keys, "signature", subjects.alias("subjects"), "configs")
