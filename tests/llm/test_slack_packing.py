"""Best-fit packing against brute force and its bounds."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from data import DOCS, odd_documents
from threadloom.llm import queries, slack_packing
from threadloom.llm.tokens import vocabulary


def encoded(rows, end_id):
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.encode_special_tokens = False
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id]) for i, t in rows]


def verify(rows, out, capacity, end_id):
    """Every id of every document lies in one piece, pieces lie side by side; gives the number of sequences."""
    pieces = defaultdict(list)
    for name, ids in encoded(rows, end_id):
        rest = len(ids) % capacity
        starts = ([0] if rest else []) + list(range(rest, len(ids), capacity))
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            pieces[(name, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))].append(1)
    found = defaultdict(list)
    sequences = defaultdict(list)
    for r in out:
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)].append(1)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == pieces
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 37, 1])
def test_pack(spark, capacity):
    rows = odd_documents()
    frame = spark.createDataFrame(rows, DOCS).repartition(4).select("*", F.lit(1).alias("length"), F.lit(2).alias("part"), F.lit(3).alias("number"))
    out = slack_packing.pack(frame, capacity=capacity, end_id=2).collect()
    used = verify([(r[0], r[1]) for r in rows], out, capacity, 2)
    assert used <= -(-sum(r.length for r in out) // capacity) + 2
    assert slack_packing.pack(frame.limit(0), capacity=capacity).count() == 0


def test_fullest_is_fullest():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.randint(5, 40)
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        taken = slack_packing.fullest(np.bincount(lengths, minlength=capacity + 1), capacity)
        chosen = [x for x, copies in taken for _ in range(copies)]
        left = lengths[:]
        for x in chosen:
            left.remove(x)
        best = max(s for k in range(len(lengths)) for c in combinations(lengths[1:], k) if (s := lengths[0] + sum(c)) <= capacity)
        assert chosen[0] == lengths[0] and sum(chosen) == best


def test_many_lengths_and_few_steps():
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(5.5, 1, 200_000).astype(int) + 1, 1024)
    counts = np.bincount(lengths, minlength=1025)
    plan = slack_packing.bins_of(counts, 1024)
    assert sum(b for b, _ in plan) <= -(-lengths.sum() // 1024) + 3
    assert len(plan) < 5_000
    left = counts.copy()
    for bins, combination in plan:
        for length, copies in combination:
            left[length] -= bins * copies
    assert not left.any()


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.QUERIES["op13_slack_packing"](spark, folder).collect()
    used = verify(rows, out, 1024, 2)
    assert used <= -(-sum(r.length for r in out) // 1024) + 2
