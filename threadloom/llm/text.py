"""Words, hashes and per-document sums of a batch of texts, in numpy over the batch's bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; one longer text is taken whole.
SLICE = 2 << 20
#: White space between words: space and \t \n \v \f \r, single bytes in UTF-8.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_random = np.random.Generator(np.random.PCG64(20240229))
_EXACT = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _LOWER[97:123]
_ORDER = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, count: int) -> np.ndarray:
    """base**i modulo 2**64 for i below ``count``."""
    out = np.full(count, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


#: Powers within a stretch of bytes; the power of a stretch's start is one factor more.
_STRETCH = 1 << 16
_UP, _DOWN = _powers(_BASE, _STRETCH), _powers(pow(_BASE, -1, 2**64), _STRETCH)


class SpanHash:
    """64-bit hashes of any byte spans of ``data``, from one prefix sum: eight bytes for each byte."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n, values = len(data), _LOWER if lower else _EXACT
        stretches = n // _STRETCH + 1
        up = _powers(pow(_BASE, _STRETCH, 2**64), stretches)
        self.down = _powers(pow(_BASE, -_STRETCH, 2**64), stretches)
        self.sums = np.zeros(n + 1, np.uint64)
        for k in range(stretches):
            a, b = k * _STRETCH, min((k + 1) * _STRETCH, n)
            part = self.sums[a + 1 : b + 1]
            np.cumsum(values[data[a:b]] * _UP[: b - a] * up[k], out=part)
            part += self.sums[a]

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = self.sums[ends] - self.sums[starts]
        raw *= _DOWN[starts & (_STRETCH - 1)]
        raw *= self.down[starts >> 16]
        return mix(raw + (ends - starts).astype(np.uint64) * _ORDER[63])


@dataclass
class Texts:
    """Some whole texts: their bytes one after another, and where each starts."""

    rows: np.ndarray  # position of each text in its batch
    data: np.ndarray
    offsets: np.ndarray  # len(rows) + 1

    def per_text(self, positions: np.ndarray) -> np.ndarray:
        """How many of the ascending byte positions lie in each text."""
        return np.diff(np.searchsorted(positions, self.offsets))

    def inside(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def texts_of(column: pa.Array, limit: int = SLICE) -> Iterator[Texts]:
    """Cut a column of strings into runs of whole texts of about ``limit`` bytes. A null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(
            np.arange(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        )
        first = last


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray  # words of each text
    firsts: np.ndarray  # the first word of each text, and the number of words

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def words_of(texts: Texts, lower: bool, breaks: np.ndarray = SPACES, hashes: SpanHash | None = None) -> Words:
    """Maximal runs of bytes that are no ``breaks``, cut at the ends of texts."""
    inside = ~breaks[texts.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[texts.offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = hashes or SpanHash(texts.data, lower)
    counts = texts.per_text(starts)
    return Words(starts, ends, hashes(starts, ends), counts, np.concatenate([[0], np.cumsum(counts)]))


def shingles_of(words: Words, size: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, with the text and the first word of each.

    With ``short``, a text with fewer words gives its whole sequence as one run.
    """
    h, n = words.hashes, len(words.hashes)
    owners = words.owners()
    left = words.firsts[owners + 1] - np.arange(n)  # words from here to the end of the text
    whole = np.flatnonzero(left >= size)
    value = np.zeros(len(whole), np.uint64)
    for i in range(size):
        value += h[whole + i] * _ORDER[i]
    value = mix(value + np.uint64(size))
    if not short:
        return value, owners[whole], whole
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    first, count = words.firsts[few], words.counts[few]
    rest = np.zeros(len(few), np.uint64)
    for i in range(size - 1):
        has = np.flatnonzero(count > i)
        rest[has] += h[first[has] + i] * _ORDER[i]
    rest = mix(rest + count.astype(np.uint64))
    return np.concatenate([value, rest]), np.concatenate([owners[whole], few]), np.concatenate([whole, first])


def sorted_distinct(owners: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs in that order."""
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(owners[order], kind="stable")]
    owners, values = owners[order], values[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    return owners[new], values[new]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the same from starts[1], and so on."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else starts, counts)
    return np.arange(total) + shift
