"""Files of token ids: concatenated ids with Elias-Fano coded document bounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .frames import batch, chosen
from .tokens import encoder, vocabulary

#: Ones between two stored positions of the select structure.
SAMPLE = 256
#: A segment is closed once it holds this many ids; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 18
SEGMENTS = (
    "shard int, segment int, documents bigint, shard_start bigint, n_ids bigint, id_bytes int, ids binary, "
    "low_bits int, low binary, high binary, samples binary, first_doc bigint, doc_low_bits int, doc_low binary, "
    "doc_high binary, doc_samples binary"
)
_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
_SEGMENTS = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in SEGMENTS.split(", ")])
_READ = pa.schema([(n, pa.int64()) for n in ("shard", "doc_id", "in_shard", "n_tokens", "ids_crc32")])


@dataclass
class EliasFano:
    """A non-decreasing list of n values up to u in n * (2 + log2(u / n)) bits or so.

    The low bits of each value are packed side by side; value i with high part h
    sets bit h + i of the high bits. ``samples`` holds the place of every
    ``SAMPLE``-th one, so ``select`` reads a short stretch, whatever the length.
    """

    count: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        pack = lambda x: np.packbits(x, bitorder="little").tobytes()
        return cls(n, low_bits, pack(bits.astype(np.uint8).ravel()), pack(high), places[::SAMPLE].astype("<u4").tobytes())

    def _low(self, index: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.count * self.low_bits]
        bits = bits.reshape(self.count, self.low_bits)[index].astype(np.uint64)
        return (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def values(self) -> np.ndarray:
        """All values in order."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.count]
        upper = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)
        return (upper | self._low(np.arange(self.count))).astype(np.int64)

    def select(self, i: int) -> int:
        """Value i, from the nearest sampled place on."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, place >> 3
        word = self.high[byte] >> (place & 7) << (place & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        upper = (byte << 3) + (word & -word).bit_length() - 1 - i
        start, low = i * self.low_bits, 0
        for k in range(self.low_bits):
            low |= (self.low[(start + k) >> 3] >> ((start + k) & 7) & 1) << k
        return upper << self.low_bits | low


def _segment(shard: int, number: int, shard_start: int, parts: list[np.ndarray], names: list) -> tuple:
    ends = EliasFano.of(np.cumsum([len(p) for p in parts]))
    first = names[0]
    # Documents without an id have segments of their own, whose first_doc is null.
    docs = EliasFano.of(np.array([] if first is None else [n - first for n in names], np.uint64))
    ids = np.concatenate(parts)
    width = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
    return (
        shard, number, len(parts), shard_start, len(ids), width, ids.astype(f"<u{width}").tobytes(),
        ends.low_bits, ends.low, ends.high, ends.samples,
        first, docs.low_bits, docs.low, docs.high, docs.samples,
    )


def _segments(path: str, end_id: int):
    def run(batches) -> Iterator:
        shard, number, shard_start = TaskContext.get().partitionId(), 0, 0
        parts: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0
        for rows in batches:
            for at, ids, offsets in encoder(path)(rows["text"]):
                for name, a, b in zip(rows["doc_id"].take(pa.array(at)).to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    if names and name is None and names[-1] is not None:
                        yield batch(_SEGMENTS, *zip(_segment(shard, number, shard_start, parts, names), strict=True))
                        number, shard_start, held, parts, names = number + 1, shard_start + held, 0, [], []
                    parts.append(np.append(ids[a:b], np.uint32(end_id)))
                    names.append(name)
                    held += len(parts[-1])
                    if held >= SEGMENT_IDS:
                        yield batch(_SEGMENTS, *zip(_segment(shard, number, shard_start, parts, names), strict=True))
                        number, shard_start, held, parts, names = number + 1, shard_start + held, 0, [], []
        if parts:
            yield batch(_SEGMENTS, *zip(_segment(shard, number, shard_start, parts, names), strict=True))

    return run


def write_tokens(
    docs: DataFrame, path: str, end_id: int = 2, vocabulary_path: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode all documents and write them in ascending ``doc_id`` order.

    One range shuffle orders the texts; each task then writes a shard, a Parquet file
    of segments of about ``SEGMENT_IDS`` ids. A segment holds its ids in two
    bytes each (four if one needs it), the ends of its documents and their ids as
    Elias-Fano lists. Documents are never cut. Spark's writer commits whole
    tasks, so a lost executor leaves no half shard.

    A null text is a document of the end id alone. Documents with equal ids lie side by side.
    Documents with a null ``doc_id`` come last, in segments whose ``first_doc`` is null; they are dealt by a
    hash of their text, so that many of them do not meet in one task.
    """
    rows = chosen(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = rows.withColumn("__h", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("__h").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(_segments(vocabulary_path or vocabulary(), end_id), SEGMENTS).write.parquet(path)


def bounds_of(row: dict) -> EliasFano:
    """The ends of a segment's documents within its ids."""
    return EliasFano(row["documents"], row["low_bits"], row["low"], row["high"], row["samples"])


def names_of(row: dict) -> EliasFano:
    """The ids of a segment's documents, less the first; none if ``first_doc`` is null."""
    if row["first_doc"] is None:
        return EliasFano(0, 0, b"", b"", b"")
    return EliasFano(row["documents"], row["doc_low_bits"], row["doc_low"], row["doc_high"], row["doc_samples"])


def document(row: dict, i: int) -> np.ndarray:
    """Ids of document ``i`` of a segment, found by ``select`` alone."""
    ends = bounds_of(row)
    first = ends.select(i - 1) if i else 0
    width = row["id_bytes"]
    return np.frombuffer(row["ids"], f"<u{width}", ends.select(i) - first, first * width).astype(np.uint32)


def _digests(batches) -> Iterator:
    for rows in batches:
        for k in range(rows.num_rows):
            row = {name: rows[name][k].as_py() for name in rows.schema.names}
            ends = bounds_of(row).values()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
            raw = memoryview(ids.tobytes())
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            first = row["first_doc"]
            names = pa.nulls(len(ends), pa.int64()) if first is None else names_of(row).values() + first
            yield batch(
                _READ, np.full(len(ends), row["shard"]), names,
                row["shard_start"] + starts, ends - starts, crcs,
            )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files.

    A shard's first id is the sum over the shards before it: one row per shard in that window.
    """
    stored = spark.read.parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("__n"))
    shards = shards.select(F.col("shard").cast("bigint").alias("shard"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    rows = stored.mapInArrow(_digests, "shard bigint, doc_id bigint, in_shard bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(shards, "shard").select(
        "doc_id", (F.col("__base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )
