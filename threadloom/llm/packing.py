"""Harmonic packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .frames import batch, chosen
from .tokens import encoder, vocabulary

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


class HarmonicBins:
    """Open bins of one task.

    A rest of length l belongs to class k = capacity // l, the lengths in (capacity / (k + 1), capacity / k]. A
    bin of class k is ready when it holds k rests, so a bin needs no search and classes need no exchange; a task
    holds at most one open bin for each class. What a ready bin lacks, less than one more rest of its class, is cut from the head of
    the rest that comes next, whatever its class. So there is about one cut for each sequence, and no padding.
    """

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.ready: list[tuple] = []  # the bin that waits for its last tokens
        self.lacks = 0
        self.done: list[tuple] = []

    def add(self, ids: bytes, *document) -> None:
        """All of a document: ``ids`` holds four bytes a token."""
        size, total = 4 * self.capacity, len(ids)
        whole = total // size * size
        for at in range(0, whole, size):
            self._close([(document, at, ids[at : at + size])])
        self._rest(document, whole, ids[whole:])

    def _rest(self, document: tuple, start: int, ids: bytes) -> None:
        if self.ready:
            head = ids[: 4 * self.lacks]
            self.ready.append((document, start, head))
            self.lacks -= len(head) // 4
            if self.lacks:
                return
            self._close(self.ready)
            self.ready, start, ids = [], start + len(head), ids[len(head) :]
        if not ids:
            return
        count = 4 * self.capacity // len(ids)
        held = self.open[count]
        held.append((document, start, ids))
        if len(held) == count:
            del self.open[count]
            self.lacks = self.capacity - sum(len(p[2]) for p in held) // 4
            if self.lacks:
                self.ready = held
            else:
                self._close(held)

    def _close(self, held: list[tuple]) -> None:
        offset = 0
        for document, start, ids in held:
            self.done.append((*document, start // 4, len(ids) // 4, zlib.crc32(ids), self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def finish(self) -> None:
        """Close what is open: full sequences, and one for each binary digit of the rest, which need no padding."""
        held = [*self.ready, *[piece for bin_ in self.open.values() for piece in bin_]]
        left = sum(len(p[2]) for p in held) // 4
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << k for k in range(left.bit_length() - 1, -1, -1) if left >> k & 1]
        held.reverse()
        for size in sizes:
            bin_, lacks = [], 4 * size
            while lacks:
                document, start, ids = held.pop()
                if len(ids) > lacks:
                    held.append((document, start + lacks, ids[lacks:]))
                    ids = ids[:lacks]
                bin_.append((document, start, ids))
                lacks -= len(ids)
            self._close(bin_)
        self.ready, self.lacks = [], 0
        self.open.clear()

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(
    docs: DataFrame, capacity: int = 1024, end_id: int = 0, vocabulary_path: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents, and the sequence and offset at which each lies.

    Each document is its ids and then ``end_id``. It is cut into full sequences, and its rest goes into a bin of its reciprocal-capacity
    class (``HarmonicBins``). Sequences are full; bins that stay open at the end of a task become full ones and at
    most one for each binary digit of ``capacity``, whose lengths are powers of two. Tasks fill their bins on
    their own: there is no shuffle.

    Sequence ids are unique; they follow the input split and the order within, so a task that runs
    again gives the same rows. A null or empty text is a document of one id. A null
    ``doc_id`` stays null; repeated rows are packed each. An empty table gives no row. Other columns are not read.
    """
    path = vocabulary_path or vocabulary()

    def run(batches):
        # No task fills 2**40 sequences.
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 40)
        for rows in batches:
            for at, ids, offsets in encoder(path)(rows["text"]):
                for name, a, b in zip(rows["doc_id"].take(pa.array(at)).to_pylist(), offsets[:-1], offsets[1:], strict=True):
                    raw = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                    bins.add(raw, name, len(raw) // 4)
                if done := bins.take():
                    yield rows_of(done)
        bins.finish()
        if done := bins.take():
            yield rows_of(done)

    def rows_of(done):
        name, total, start, length, crc, sequence, offset = zip(*done, strict=True)
        return batch(_SCHEMA, name, start, length, crc, total, sequence, offset)

    return chosen(docs, doc_id=doc_id, text=text).mapInArrow(run, PIECES)
