"""The registered queries of the numbered operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (
    collocations,
    conversation_trie,
    hidden_markov,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality,
    repeats,
    slack_packing,
    token_files,
    toxicity,
    vector_links,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op2_harmonic_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), capacity=1024, end_id=0)


@query("op3_pivotal_mixing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder), weights=(1, 2, 3), most=3.0)


@query("op4_elias_fano_tokens")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(documents(spark, folder), path, end_id=2)
    return token_files.read_digests(spark, path)


@query("op5_quality_ledger", sql=quality.sql())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    stored = quality.ledger(documents(spark, folder))
    return stored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.STRICT).alias("kept"), "failed",
    )


@query("op6_license_digests", sql=licenses.sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.classes(documents(spark, folder))


@query("op7_hnsw_near_duplicates")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"), least=0.9)


@query("op8_suffix_array_repeats")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove(documents(spark, folder)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op9_hidden_markov_scores")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov.score(documents(spark, folder))


@query("op10_toxic_segments")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.learn(docs, labels.where(~held_out))
    found = toxicity.passages(docs, model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted", F.size("first").alias("n_passages"))


@query("op11_collocations", sql=collocations.sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.best(documents(spark, folder))


@query("op12_conversation_trie", sql=conversation_trie.sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.positions(spark.read.parquet(f"{folder}/conversations.parquet"))
    return conversation_trie.trie(*conversation_trie.regrafted(turns))


@query("op13_slack_packing")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return slack_packing.pack(documents(spark, folder), capacity=1024, end_id=2)
