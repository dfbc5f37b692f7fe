"""Word frequencies over submissions, comments and mixed feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import clean_word, raw_tokens
from .ranking import top_per_group


def count_words(df: DataFrame, fields: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    """Frequencies per word (and per ``by``).

    Equal pieces are counted first and cleaned once per distinct piece: the
    per-occurrence work is a split and a map-side hash count, and what moves
    between tasks is distinct pieces, however frequent a word is.
    """
    pieces = df.select(*by, F.explode(raw_tokens(*fields)).alias("piece")).where("piece <> ''")
    counted = pieces.groupBy(*by, "piece").agg(F.count("*").alias("n"))
    cleaned = counted.select(*by, clean_word("piece").alias("word"), "n").where("word <> ''")
    return cleaned.groupBy(*by, "word").agg(F.sum("n").alias("frequency"))


def submission_words(submissions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return count_words(submissions, ["selftext", "title"], by)


def comment_words(comments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return count_words(comments, ["body"], by)


def record_text(record: Column, kind: str) -> list[Column]:
    """The counted text fields of a VARIANT record of the given ``type``."""
    fields = {"submission": ["selftext", "title"], "comment": ["body"]}[kind]
    this_kind = F.try_variant_get(record, "$.type", "string") == kind
    return [
        F.when(this_kind, F.try_variant_get(record, f"$.{field}", "string")) for field in fields
    ]


def only_records(items: DataFrame, item: str = "item") -> DataFrame:
    """Objects with a known ``type``; strings such as the forbidden marker go."""
    kind = F.try_variant_get(F.col(item), "$.type", "string")
    is_object = F.schema_of_variant(F.col(item)).startswith("OBJECT")
    return items.where(is_object & kind.isin("submission", "comment"))


def mixed_words(items: DataFrame, item: str = "item", by: Sequence[str] = ()) -> DataFrame:
    """Submissions and comments in one feed of VARIANT records."""
    record = F.col(item)
    fields = record_text(record, "submission") + record_text(record, "comment")
    return count_words(only_records(items, item), fields, by)


def words_by_file(texts: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """All files of a call in one job."""
    return count_words(texts, [text], by=[file])


def words_by_frequency(
    df: DataFrame, fields: Sequence[Column | str], position: str, by: Sequence[str] = ()
) -> DataFrame:
    """Frequencies, most frequent first, ties by first appearance.

    ``position`` numbers the documents of one group, in any bigint. A token index
    is below 2**31, so document and index fit one decimal: the minimum stays a hash
    aggregate, where a struct would force a sort of every token.
    """
    base = F.col(position).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)")
    pieces = df.select(*by, base.alias("base"), F.posexplode(raw_tokens(*fields)).alias("index", "piece"))
    seen = pieces.where("piece <> ''").groupBy(*by, "piece").agg(
        F.count("*").alias("n"), F.min((F.col("base") + F.col("index")).cast("decimal(38,0)")).alias("at")
    )
    counted = (
        seen.select(*by, clean_word("piece").alias("word"), "n", "at")
        .where("word <> ''")
        .groupBy(*by, "word")
        .agg(F.sum("n").alias("frequency"), F.min("at").alias("first_at"))
    )
    return counted.orderBy(*by, F.desc("frequency"), F.asc("first_at"))


def cloud_weights(frequencies: DataFrame, by: Sequence[str], top: int = 200) -> DataFrame:
    """The ``top`` words of each file with their weight relative to the largest."""
    ranked = top_per_group(frequencies, by, [F.desc("frequency"), F.asc("word")], top, "position")
    # At most ``top`` rows per file are left, the largest among them.
    largest = F.max("frequency").over(Window.partitionBy(*by))
    return ranked.withColumn("weight", F.col("frequency") / largest)
