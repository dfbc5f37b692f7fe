"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def append_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Append rows to a table kept in ``buckets`` by the hash of ``key``; gives the table.

    A join by ``key`` reads such a table where it lies: only the other side is exchanged. With as many buckets
    as shuffle partitions, the exchange that dedupes a batch also serves the join.
    """
    # Rows meet by bucket first, so that a bucket gets one file from each load, not one from each task.
    writer = df.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def jdbc_table(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A database table, read in ``partitions`` ranges of a numeric key."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    ranges = {"partitionColumn": key, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    return reader.options(**ranges).load()
