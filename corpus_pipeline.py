"""A corpus pipeline of five stages, each written as Parquet and read again as the next one's documents.

Null and empty texts go with the quality rules. A null id is kept through all stages; rows that repeat are judged one by one by the
rules, and one of each group of copies is left by the n-gram join. A null source is a source of its own. An empty table gives no
row. Extra columns are carried to the last stage under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import mixing, ngram_join, packing, quality, repeats
from threadloom.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.keep(docs, quality.STRICT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that of the smallest id; of rows of one id, one."""
    return ngram_join.representatives(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that stand anywhere else too; characters stay whole."""
    return repeats.strip(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; each source's last one in part."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_repeats", drop_repeats),
    ("pivotal_mixing", mix_sources),
    ("harmonic_packing", pack_sequences),
]

#: Pivotal draws and token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
