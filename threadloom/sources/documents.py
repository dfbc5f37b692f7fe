"""Scrape documents as DataFrames.

One document per file is read with ``multi_line=True``, as the collector
writes it. Documents stored one per line are read with ``multi_line=False``,
which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.threads import flatten_nested
from ..schemas import COMMENT_DOC, COMMENTS_FILE, LIVESTREAM_FILE, REDDITOR_FILE, SUBMISSION_DOC

BAD = "_corrupt_record STRING"


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """JSON documents with their file path; broken ones keep their text in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, {BAD}")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )


def _fields(ddl: str) -> list[tuple[str, str]]:
    pairs = [part.split() for part in ddl.replace("\n", " ").split(",")]
    return [(name, kind.lower()) for name, kind in pairs]


def record_columns(item: Column, ddl: str) -> list[Column]:
    """The fields of a VARIANT record as typed columns; a field of another type is null."""
    return [F.try_variant_get(item, f"$.{name}", kind).alias(name) for name, kind in _fields(ddl)]


def _decoded(value: Column, whole: bool) -> Column:
    """The text of a document without leading space; a whole file may be UTF-16, as for Spark's JSON reader."""
    if whole:
        raw = value.cast("binary")
        mark = F.hex(F.substring(raw, 1, 2))
        wide = mark.isin("FEFF", "FFFE") | mark.rlike("^(00..|..00)$")
        charset = F.when(mark.startswith("00"), "UTF-16BE").when(mark.endswith("00"), "UTF-16LE").otherwise("UTF-16")
        value = F.when(wide, F.call_function("decode", raw, charset)).otherwise(value)
    return F.ltrim(value, F.lit("\ufeff \t\r\n"))


def submission_scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Submissions of scrape files.

    A file is ``{scrape_settings, data: [...]}``, a bare list, or bare records one per
    line. Every object is a row, whatever fields it lacks; a field of another
    type is null. Items that are no objects are dropped, and a malformed file gives no rows.
    """
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=multi_line)
        .select(_decoded(F.col("value"), multi_line).alias("text"), F.col("_metadata.file_path").alias("file"))
    )
    # Spark bounds one VARIANT at 128 MiB, so items are parsed one by one, and only a record alone as a whole.
    listed = F.col("text").startswith("[")
    document = F.when(F.col("parsed.data").isNull() & F.col("parsed.scrape_settings").isNull() & ~listed, F.try_parse_json("text"))
    is_file = F.try_variant_get("document", "$.data", "variant").isNotNull()
    raw = raw.select(
        "file",
        F.when(~listed, F.from_json("text", "scrape_settings VARIANT, data ARRAY<VARIANT>")).alias("parsed"),
        F.when(listed, F.from_json("text", "ARRAY<VARIANT>")).alias("list"),
        "text",
    ).withColumn("document", document)
    items = raw.select(
        "file",
        F.try_variant_get("parsed.scrape_settings", "$.subreddit", "string").alias("subreddit"),
        F.coalesce("list", "parsed.data", F.when(F.col("document").isNotNull() & ~is_file, F.array("document"))).alias("items"),
        F.col("document").isNotNull().alias("alone"),
    ).select("file", "subreddit", "alone", F.posexplode("items").alias("at", "item"))
    # A record on a line of its own has no position in a list.
    return items.where(F.schema_of_variant("item").startswith("OBJECT")).select(
        "file", "subreddit", F.when(~F.col("alone"), F.col("at")).alias("pos"), *record_columns(F.col("item"), SUBMISSION_DOC)
    )


def corrupt_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Rejects: files or lines that are no JSON of the expected shape."""
    raw = read_json(spark, path, schema, multi_line)
    # Spark refuses to read the reject column alone, so a schema column comes along.
    return raw.where("_corrupt_record IS NOT NULL").select("file", "_corrupt_record", F.col(raw.columns[0]).isNull().alias("unread"))


def comment_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Comment files: settings, metadata and the comment list, flat or nested."""
    raw = read_json(spark, path, COMMENTS_FILE, multi_line).where("_corrupt_record IS NULL")
    return raw.select(
        "file",
        F.col("scrape_settings.style").alias("style"),
        F.col("scrape_settings.url").alias("url"),
        F.col("data.submission_metadata").alias("submission_metadata"),
        F.col("data.comments").alias("comments"),
    )


def comment_scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Listed comments of comment files, the top level of a nested file."""
    items = comment_documents(spark, path, multi_line).select(
        "file", "style", "url", F.posexplode("comments").alias("pos", "item")
    )
    return items.select("file", "style", "url", "pos", *record_columns(F.col("item"), COMMENT_DOC))


def nested_comment_scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Comments of nested comment files, the replies of every level, with their depth."""
    nested = comment_documents(spark, path, multi_line).select("file", "style", "url", "comments")
    flat = flatten_nested(nested)
    return flat.select("file", "style", "url", "depth", *record_columns(F.col("comment"), COMMENT_DOC))


def redditor_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    raw = read_json(spark, path, REDDITOR_FILE, multi_line).where("_corrupt_record IS NULL")
    return raw.select(
        "file",
        F.col("scrape_settings.redditor").alias("redditor"),
        F.col("data.information").alias("information"),
        F.col("data.interactions").alias("interactions"),
    )


def redditor_scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Items of all interaction lists; the forbidden marker and other strings go."""
    lists = redditor_documents(spark, path, multi_line).select(
        "file", "redditor", F.explode("interactions").alias("category", "items")
    )
    items = lists.select("file", "redditor", "category", F.posexplode("items").alias("pos", "item"))
    return items.where(F.schema_of_variant("item").startswith("OBJECT"))


def livestream_scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    raw = read_json(spark, path, LIVESTREAM_FILE, multi_line).where("_corrupt_record IS NULL")
    return raw.select(
        "file",
        F.col("livestream_settings.included_reddit_objects").alias("object_kind"),
        F.coalesce("livestream_settings.subreddit", "livestream_settings.redditor").alias("source"),
        F.posexplode("data").alias("pos", "item"),
    )


def analytics_files(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Any JSON documents, each as one VARIANT."""
    return (
        spark.read.option("singleVariantColumn", "document")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
        .select("document", F.col("_metadata.file_path").alias("file"))
    )
