"""Best-fit packing by minimum bin slack: the fullest combination of the lengths that are left, bin after bin."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from .frames import batch, chosen
from .tokens import encoder, vocabulary

_PIECES = "part int, nth bigint, doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
_TYPES = {"int": pa.int32(), "bigint": pa.int64()}


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in columns.split(", ")])


def cuts_of(tokens: int, capacity: int) -> list[int]:
    """Where the pieces of a document start: whole ones of ``capacity``, the rest first."""
    rest = tokens % capacity
    return [*([0] if rest else []), *range(rest, tokens, capacity)]


def fullest(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(length, copies), longest first, of a bin with the longest length that is left and as little slack as can be.

    Bit s of ``reach`` says that some lengths sum to s. Lengths are let in from the longest down, each up to the copies
    there are, until the bin can be filled to the brim; the sets before each length lead back to the copies taken.
    """
    longest = int(np.flatnonzero(counts)[-1])
    room = capacity - longest
    reach, mask, layers = 1, (1 << (room + 1)) - 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        layers.append((length, reach))
        for _ in range(min(int(counts[length]) - (length == longest), room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            reach = more
        if reach >> room & 1:
            break
    taken, left = {longest: 1}, reach.bit_length() - 1
    for length, before in reversed(layers):
        while not before >> left & 1:
            left -= length
            taken[length] = taken.get(length, 0) + 1
    return sorted(taken.items(), reverse=True)


def bins_of(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, combination) until no length is left. ``counts[l]`` pieces have length l.

    A combination is taken for as many bins as its lengths last, so there are about as many steps as
    lengths, whatever the number of pieces.
    """
    counts, out = np.array(counts, np.int64), []
    while counts.any():
        combination = fullest(counts, capacity)
        bins = min(int(counts[length]) // copies for length, copies in combination)
        for length, copies in combination:
            counts[length] -= bins * copies
        out.append((bins, combination))
    return out


class Places:
    """Sequence and offset of the j-th piece of a length, under a plan of ``bins_of``."""

    def __init__(self, plan: list[tuple[int, list[tuple[int, int]]]], capacity: int):
        spans: list[list[tuple]] = [[] for _ in range(capacity + 1)]
        used, sequence = [0] * (capacity + 1), 0
        for bins, combination in plan:
            offset = 0
            for length, copies in combination:
                spans[length].append((used[length], sequence, copies, offset))
                used[length] += bins * copies
                offset += length * copies
            sequence += bins
        self.spans = [np.array(s, np.int64).reshape(-1, 4) for s in spans]

    def __call__(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            at, spans = np.flatnonzero(lengths == length), self.spans[length]
            span = spans[np.searchsorted(spans[:, 0], numbers[at], "right") - 1]
            within = numbers[at] - span[:, 0]
            sequences[at] = span[:, 1] + within // span[:, 2]
            offsets[at] = span[:, 3] + within % span[:, 2] * length
        return sequences, offsets


def _pieces(path: str, capacity: int, end_id: int):
    schema = _schema(_PIECES)

    def run(batches) -> Iterator:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for rows in batches:
            for at, ids, offsets in encoder(path)(rows["text"]):
                out = []
                names = rows["doc_id"].take(pa.array(at)).to_pylist()
                for name, a, b in zip(names, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    raw = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                    starts = cuts_of(len(raw) // 4, capacity)
                    for k, (x, y) in enumerate(zip(starts, [*starts[1:], len(raw) // 4], strict=True)):
                        out.append((part, int(seen[y - x]), name, k, x, y - x, zlib.crc32(raw[4 * x : 4 * y])))
                        seen[y - x] += 1
                yield batch(schema, *zip(*out, strict=True))

    return run


def pack(
    docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary_path: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents, and the sequence and offset at which each lies, in as few sequences as the method finds.

    A document is its ids and then ``end_id``; only one of more than ``capacity`` tokens is cut, into pieces of ``capacity``,
    the first of which may be shorter. Each sequence is the fullest combination of lengths around the longest one that is left.
    Sequences are chosen from the counts of the lengths, ``capacity`` numbers whatever the input; the pieces of a
    length are alike, so each finds its place by its number among those of its length.

    Texts are encoded once, in the tasks that read them; what is exchanged is one short row a piece. A piece's number is that
    within its task plus the pieces in the tasks before, so no length has to meet in one task.

    A null or empty text is a document of one id. A null ``doc_id`` stays null; repeated rows are packed each. An
    empty table gives no row. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = chosen(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = materialize(rows.mapInArrow(_pieces(vocabulary_path or vocabulary(), capacity, end_id), _PIECES), "pieces")

    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("__n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("__n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(Places(bins_of(counts, capacity), capacity))

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    numbered = pieces.join(before, ["part", "length"]).withColumn("number", F.col("nth") + F.col("__before"))
    schema = _schema(PLACED)

    def place(batches) -> Iterator:
        for part in batches:
            sequences, offsets = places.value(part["length"].to_numpy(), part["number"].to_numpy())
            yield batch(
                schema, part["doc_id"], part["piece"], part["start"], part["length"].cast(pa.int64()), part["ids_crc32"], sequences, offsets
            )

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, PLACED)
