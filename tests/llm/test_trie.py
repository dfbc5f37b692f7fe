"""The conversation trie against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from threadloom.llm import conversation_trie, queries

COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def build(frame):
    return conversation_trie.trie(*conversation_trie.regrafted(conversation_trie.positions(frame)))


def odd_conversations():
    """Stems and forks, absent stems, nulls, ties, repeated rows, empty and long texts, deep conversations, negative ids."""
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choices(["ja", "né", "漢字", "ok\n", ""], k=n))
    rows = [(100, t, rng.choice(["user", None]), say(3)) for t in range(9)]
    for c in [*range(101, 140), *range(230, 236), -7, -100, 0, 5]:
        rows += [(c, None if rng.random() < 0.1 else t, rng.choice(["user", "bot"]), rng.choice([None, "", "same", say(2)])) for t in range(rng.randint(1, 8))]
    rows += [(300, t, "user", f"turn {t}") for t in range(70)]
    rows += [(c, t, "user", f"turn {t}") for c in (301, 302, 303, 304) for t in range(rng.choice([70, 40, 33]))]
    rows += [(310, 1, "user", "tie")] * 30 + [(310, 1, "user", "other"), (311, 1, "a", "x" * 100_000), (None, 1, "user", "no one's"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("band", "block"), [(8, 64), (3, 4)])
def test_trie(spark, monkeypatch, band, block):
    monkeypatch.setattr(conversation_trie, "BAND", band)
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    monkeypatch.setattr(conversation_trie, "PAGE", 3)
    rows = odd_conversations()
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5).select(F.lit(1).alias("k1"), "*", F.lit(2).alias("depth"), F.lit(3).alias("position"))
    assert Counter(tuple(r) for r in build(frame).collect()) == brute.trie(brute.regrafted(rows))


def test_empty(spark):
    out = build(spark.createDataFrame([], COLUMNS))
    assert out.count() == 0
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries.QUERIES["op12_conversation_trie"](spark, folder)
    assert Counter(tuple(r) for r in out.collect()) == brute.trie(brute.regrafted(rows))
