"""File listings and path routing; file contents are never read here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """All files below a folder with size and time."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def files_over_size(spark: SparkSession, path: str, least: int = 100) -> DataFrame:
    """JSON files worth reprocessing: larger than ``least`` bytes."""
    return list_files(spark, path, "*.json").where(F.col("length") > least)


def dated_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a ``scrape_date=.../scrape_type=...`` layout with both as columns."""
    listed = list_files(spark, path)
    return listed.select(
        "*",
        F.regexp_extract("path", r"scrape_date=([^/]+)", 1).alias("scrape_date"),
        F.regexp_extract("path", r"scrape_type=([^/]+)", 1).alias("scrape_type"),
        F.regexp_extract("path", r"scrape_date=[^/]+/(.*)$", 1).alias("relative_path"),
    )


# scrapes/{date}/{type}/.../name.json
_ROUTE = r"(?:^|/)scrapes/([^/]+)/([^/]+)/(?:.*/)?([^/]+)$"


def route_by_path(paths: DataFrame, path: str = "path") -> DataFrame:
    """Date, kind and analytics folder of scrape files.

    Files that are not JSON, and files below ``analytics``, are not routed.
    """
    name = F.regexp_extract(path, _ROUTE, 3)
    routed = paths.select(
        "*",
        F.regexp_extract(path, _ROUTE, 1).alias("scrape_date"),
        F.regexp_extract(path, _ROUTE, 2).alias("scrape_type"),
        F.get(F.split(name, r"\."), F.lit(1)).alias("__extension"),
    )
    kept = routed.where((F.col("__extension") == "json") & (F.col("scrape_type") != "analytics"))
    return kept.drop("__extension")


def analytics_dir(path: Column | str, tool: str) -> Column:
    """Folder that mirrors a scrape file's folder below ``analytics/{tool}``."""
    return F.regexp_replace(path, r"(^|/)scrapes/([^/]+)/(.*)/[^/]+$", f"$1scrapes/$2/analytics/{tool}/$3")
