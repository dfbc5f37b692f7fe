"""Substring search over posts in blocks: trigrams name the blocks that can hold a term, ILIKE verifies them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import like_pattern

# Characters of a text that are cut into trigrams at once.
WINDOW = 4096
ESCAPED, WILDCARD = r"\\(.)|([%_])|(.)", "\0wildcard"


def write_indexed(posts: DataFrame, path: str, fields: Sequence[str], blocks: int | None = None) -> None:
    """Store ``posts`` in blocks, and for each of the text ``fields`` the blocks that hold a trigram.

    A block is a folder of one file near the advisory partition size, or one of ``blocks``. Postings are rows of field, trigram and
    block, each once, in that order: Parquet stores the sorted blocks as differences. They are made from the stored
    blocks, so a block keeps its number. A trigram that is in every block is cut over many tasks.
    """
    spread = posts.repartition(blocks) if blocks else posts.hint("rebalance")
    spread.withColumn("block", F.spark_partition_id()).write.partitionBy("block").option("compression", "zstd").parquet(f"{path}/posts")
    stored = posts.sparkSession.read.schema(f"{_ddl(posts)}, block INT").parquet(f"{path}/posts")
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lower(f).alias("text")) for f in fields]))
    # Windows overlap by two characters; both patterns pass a text once.
    windows = F.regexp_extract_all("t.text", F.lit(f"(?s)(?=(.{{1,{WINDOW + 2}}})).{{1,{WINDOW}}}"), F.lit(1))
    grams = F.array_distinct(F.regexp_extract_all("window", F.lit("(?s)(?=(...))"), F.lit(1)))
    postings = (
        stored.select("block", texts.alias("t"))
        .select("block", "t.field", F.explode(windows).alias("window"))
        .select("field", F.explode(grams).alias("gram"), "block")
        .distinct()
    )
    order = ["field", "gram", "block"]
    postings.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", "zstd").option(
        "parquet.writer.version", "PARQUET_2_0"
    ).parquet(f"{path}/postings")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def trigrams(spark: SparkSession, keyword: str, literal: bool = False) -> list[str]:
    """Trigrams that every text with the keyword holds; none where no run between wildcards has three characters."""
    # ILIKE compares lower-cased sides, so the pattern is lower-cased by the same function.
    pattern = spark.sql("SELECT lower(:pattern)", {"pattern": like_pattern(keyword, literal)}).first()[0]
    marks = [WILDCARD if wild else escaped or plain for escaped, wild, plain in re.findall(ESCAPED, pattern, re.DOTALL)]
    triples = zip(marks, marks[1:], marks[2:], strict=False)
    return sorted({"".join(three) for three in triples if WILDCARD not in three})


def candidates(
    spark: SparkSession, path: str, schema: str, keywords: Sequence[str], fields: Sequence[str], literal: bool = False
) -> DataFrame:
    """Stored posts of the blocks that can match any keyword in any field; ``schema`` is that of the posts.

    The caller verifies them (``reads.matches_any``). Spark prunes the scan where the blocks found are few enough for it to broadcast,
    else the blocks are joined. With a keyword without trigrams, or without keywords, all blocks are read.
    """
    posts = spark.read.schema(f"{schema}, block INT").parquet(f"{path}/posts")
    wanted = [trigrams(spark, k, literal) for k in keywords]
    if not wanted or not all(wanted):
        return posts.drop("block")
    postings = spark.read.schema("field STRING, gram STRING, block INT").parquet(f"{path}/postings")
    hits = postings.where(F.col("field").isin(*fields) & F.col("gram").isin(*sorted(set().union(*wanted))))
    whole = [F.count_if(F.col("gram").isin(*grams)) == len(grams) for grams in wanted]
    blocks = hits.groupBy("field", "block").agg(reduce(or_, whole).alias("hit")).where("hit").select("block").distinct()
    # A block is a folder, so the join prunes the scan.
    return posts.join(blocks, "block", "left_semi").drop("block")
