"""Writers. Rows go out from the executors, partition by partition."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..session import delete_path, materialize


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """One document per line; null fields are kept. Spark reads compressed files back as they are."""
    df.write.option("ignoreNullFields", False).option("compression", compression).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header and rows. Quotes and line breaks inside a value survive a read back."""
    df.write.option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "").csv(path)


def write_partitioned(df: DataFrame, path: str, keys: tuple[str, ...] = ("scrape_date", "scrape_type")) -> None:
    """Documents under ``scrape_date=.../scrape_type=...``.

    Rows of a folder are brought together into files near the advisory partition size: a
    dominant date or kind is split over many tasks, small ones do not leave a file per task.
    """
    df.hint("rebalance", *keys).write.partitionBy(*keys).option("ignoreNullFields", False).json(path)


def write_structured_comments(fragments: DataFrame, path: str) -> None:
    """Tree fragments as text in reading order.

    The range sort cuts a long thread into consecutive files; put together in
    file order they are one JSON array per thread.
    """
    fragments.orderBy("link", "at").select(F.col("fragment").alias("value")).write.text(path)


def write_frequencies_csv(frequencies: DataFrame, path: str) -> None:
    write_csv(frequencies.select(F.col("word").alias("words"), F.col("frequency").alias("frequencies")), path)


def frequency_documents(pages: DataFrame) -> DataFrame:
    """``{raw_file, data: {word: n}}`` documents from pages of (word, frequency)."""
    data = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["word"], e["frequency"])))
    return pages.select(F.col("file").alias("raw_file"), "page", data.alias("data"))


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; give only new rows (see the dedupe operators) to stay replay-safe."""
    df.write.mode("append").parquet(path)


def write_lookup(df: DataFrame, path: str, order: str, keys: dict[str, int]) -> None:
    """Rows for point reads: in files sorted by ``order``, with a Bloom filter of each column in ``keys``.

    Bounds of ``order`` skip files and row groups for it; the filters do so for the other keys. ``keys`` gives the distinct
    values to expect in a row group, which sets a filter's size.
    """
    writer = df.repartitionByRange(order).sortWithinPartitions(order).write.option("compression", "zstd")
    for key, distinct in keys.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    writer.parquet(path)


def remove_rows(gone: DataFrame, path: str, key: str, partition: str) -> int:
    """Take the rows whose ``key`` is in ``gone`` out of a table in folders by ``partition``; gives the number of folders touched.

    Only folders that hold such a row are rewritten, from a staged copy of what stays; all other files keep their name and
    time. A second run finds nothing to take out and changes nothing. A row without a partition value stays.
    """
    stored = gone.sparkSession.read.parquet(path)
    ids = materialize(gone.select(key).distinct(), "gone")
    touched = materialize(stored.join(ids, key, "left_semi").select(partition).dropna().distinct(), "touched")
    if touched.isEmpty():
        return 0
    kept = materialize(stored.join(touched, partition, "left_semi").join(ids, key, "left_anti"), "kept")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A folder without a row left is not among those written.
    for row in touched.join(kept.select(partition).distinct(), partition, "left_anti").collect():
        delete_path(gone.sparkSession, f"{path}/{partition}={row[0]}")
    return touched.count()


def upsert_rows(rows: DataFrame, path: str, key: str, partition: str) -> int:
    """Put ``rows``, one per ``key``, into a table in folders by ``partition``; gives the number of folders touched.

    A row replaces the stored one of its key, in whichever folder that lies; a new key is added. Rows that are stored already as they are
    touch nothing, so a second run changes nothing. Only touched folders are rewritten, from a staged copy. A null
    partition value is a folder like the others.
    """
    stored = rows.sparkSession.read.parquet(path)
    rows = materialize(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema]), "given")
    earlier = materialize(stored.join(rows.select(key), key, "left_semi").select(*rows.columns), "earlier")
    new = materialize(rows.join(earlier, _same(rows, earlier, rows.columns), "left_anti"), "new")
    old = earlier.join(new.select(key), key, "left_semi")
    touched = materialize(new.select(partition).unionByName(old.select(partition)).distinct(), "touched")
    if touched.isEmpty():
        return 0
    beside = stored.join(touched, _same(stored, touched, [partition]), "left_semi").join(new.select(key), key, "left_anti")
    whole = materialize(beside.select(*new.columns).unionByName(new), "whole")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A folder whose rows have all moved is not among those written.
    left = whole.select(partition).distinct()
    for row in touched.join(left, _same(touched, left, [partition]), "left_anti").collect():
        delete_path(rows.sparkSession, f"{path}/{partition}={NO_VALUE if row[0] is None else row[0]}")
    return touched.count()


# Fixed value: Spark's folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def overwrite_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch under its own folder: a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def pack(df: DataFrame, path: str, keys: list[str]) -> None:
    """Archive rows as compressed columnar files per key.

    Adaptive execution cuts a dominant key into files near the advisory partition size and
    puts a small one into one file.
    """
    df.hint("rebalance", *keys).write.partitionBy(*keys).option("compression", "zstd").parquet(path)
