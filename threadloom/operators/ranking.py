"""Top-k per group, exact positions and pages, all safe for one huge group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

PAGE = 500
# A group of so many rows is still sorted in one task.
WHOLE = 50_000
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _maps(df: DataFrame) -> set[str]:
    """Columns that have no order or hash."""
    return {f.name for f in df.schema if any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))}


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of every group.

    The filter on ``row_number`` lets Spark keep only ``k`` rows per group and
    task before the shuffle, so the size of a group never reaches one task. Spark
    does so up to a threshold of its own; a larger ``k`` takes exact positions,
    which need no group in one task. Either way, rows that tie in ``order`` are told
    apart by their content, so ``k`` alone never changes which rows come first.
    """
    name = rank or "__rank"
    order = [*order, F.xxhash64(*[F.col(c) for c in df.columns if c not in _maps(df)])]
    if k > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        top = number_rows(df, keys, order, name).where(F.col(name) <= k)
        return top if rank else top.drop(name)
    window = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return top.withColumn(name, F.col(name).cast("bigint")) if rank else top.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exact dedupe: one row per key, the first in ``order``."""
    return top_per_group(df, keys, order, 1)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "position",
    kept: Sequence[Column | str] | None = None,
) -> DataFrame:
    """1-based position of every row in its group, for groups of any size.

    ``row_number`` would sort a whole group in one task. Here a range shuffle
    on keys and order splits a large group over many tasks; each task numbers
    its own slice, and the rows before a slice are added from the slice counts.
    ``order`` must end in a unique column. A null key is a group of its own.
    ``kept`` names what goes on, the keys among it; columns that only the order
    needs are then not written.
    """
    sort = [*[F.col(k) for k in keys], *order]
    sliced = (
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select(
            *(kept or ["*"]),
            F.spark_partition_id().alias("__slice"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__row"),
        )
    )
    # The slice bounds come from a sample, so they are fixed in a table first.
    sliced = materialize(sliced, "slices")
    # One row per group and slice; a group has at most as many as there are tasks.
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*keys, "__slice")
        .agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .select(
            *[F.col(k).alias(f"__key_{k}") for k in keys],
            F.col("__slice").alias("__part"),
            (F.col("__before") - F.col("__first") + 1).alias("__shift"),
        )
    )
    same = sliced["__slice"] == starts["__part"]
    for k in keys:
        same = same & sliced[k].eqNullSafe(starts[f"__key_{k}"])
    return sliced.join(starts, same).select(
        *[sliced[c] for c in sliced.columns if c not in ("__slice", "__row")], (F.col("__row") + F.col("__shift")).alias(name)
    )


def in_pages(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    items: Column,
    name: str,
    page_size: int = PAGE,
) -> DataFrame:
    """Nest a group as arrays of at most ``page_size`` items, in order.

    A group that fits gives one row with page 0; a larger one continues on
    pages 1, 2, ..., so no array grows with the data and nothing is left out.
    Groups of up to ``WHOLE`` rows are numbered and nested after one shuffle by
    their keys; the few larger ones take ``number_rows``, so no task holds one.
    """
    small, large = _by_size(df, keys)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    parts = [] if small is None else [small.withColumn("__position", position)]
    parts += [] if large is None else [number_rows(large, keys, order, "__position")]
    page = F.floor((F.col("__position") - 1) / page_size).cast("bigint")
    nested = [
        part.select(*keys, page.alias("page"), F.struct("__position", items.alias("item")).alias("__item"))
        .groupBy(*keys, "page")
        .agg(F.sort_array(F.collect_list("__item")).alias("__items"))
        .select(*keys, "page", F.transform("__items", lambda i: i["item"]).alias(name))
        for part in parts
    ]
    return nested[0] if len(nested) == 1 else nested[0].unionByName(nested[1])


def _by_size(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of groups of up to ``WHOLE`` rows, and those of larger groups; None where there are none for sure."""
    if not keys:
        return None, df
    counted = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > WHOLE)
    over = materialize(counted.select(*[F.col(k).alias(f"__key_{k}") for k in keys]), "large-groups")
    if over.isEmpty():
        return df, None
    same = reduce(and_, [df[k].eqNullSafe(over[f"__key_{k}"]) for k in keys])
    return df.join(over, same, "left_anti"), df.join(over, same, "left_semi")
