"""Phrases that keep together against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from data import DOCS, odd_documents
from threadloom.llm import collocations, queries

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*NAMES).collect())


def texts():
    rng = random.Random(8)
    rows = []
    for lang, size in (("en", 40), ("né", 15), (None, 8), ("", 5), ("und", 4)):
        words = [f"w{k}" if k % 5 else f"É{k}" for k in range(size)]
        weights = [1 / (k + 1) for k in range(size)]
        for _ in range(40):
            out = []
            for _ in range(rng.randint(0, 60)):
                out += rng.choices(words, weights, k=1) if rng.random() < 0.8 else rng.choice([["Rare", "pair"], ["of", "the", "long", "fixed", "line", "here"], ["ha", "ha", "ha"]])
                out.append(rng.choice([" ", "  ", "\t", " ", " ", " ", ". ", ",", "\n", "!?"]))
            rows.append((lang, "".join(x if x.strip(" \t") != x or x in ".,\n!?" else x + " " for x in out)))
    return rows + [("en", None), (None, None), ("xx", "one two three"), ("en", "a " * 400)]


@pytest.mark.parametrize(("least", "top", "growth"), [(3, 2000, 16), (5, 6, 4)])
def test_against_brute_force(spark, monkeypatch, least, top, growth):
    for name, value in (("LEAST", least), ("TOP", top), ("GROWTH", growth)):
        monkeypatch.setattr(collocations, name, value)
    rows = texts()
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    frame = frame.select("*", F.lit(1).alias("h"), F.lit("x").alias("words"), F.lit(2).alias("n"), F.lit(3).alias("f"))
    expected = sorted(brute.collocations(rows, 5, least, top))
    assert len(expected) > 10
    assert rows_of(collocations.best(frame)) == expected


def test_small_sets_and_slices(spark, monkeypatch):
    """Sets that let nearly all keys pass, and texts cut into short stretches, change nothing."""
    for name, value in (("LEAST", 3), ("TOP", 30), ("GROWTH", 8), ("SLICE", 64)):
        monkeypatch.setattr(collocations, name, value)
    rows = texts()
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    monkeypatch.setattr(collocations, "CHUNK_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    assert rows_of(collocations.best(frame)) == sorted(brute.collocations(rows, 5, 3, 30))


def test_odd_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", 20)
    rows = odd_documents()
    frame = spark.createDataFrame(rows, DOCS)
    assert rows_of(collocations.best(frame)) == sorted(brute.collocations([(r[2], r[1]) for r in rows], 5, 20, 2000))
    assert collocations.best(frame.limit(0)).count() == 0
    assert collocations.best(frame.where("text = ''")).columns == NAMES


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    assert rows_of(queries.QUERIES["op11_collocations"](spark, folder)) == sorted(brute.collocations(rows, 5, 100, 2000))
