"""Removal of repeated byte strings by bounded interval expansion on Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import discard, materialize
from .frames import batch, chosen
from .text import SLICE, SpanHash, Texts, ragged, texts_of

#: Bytes that a repeated string has at least.
LENGTH = 200
#: Bytes of an anchor. A string of LENGTH bytes holds LENGTH - ANCHOR + 1 of them.
ANCHOR = 32
#: Depth from which intervals are expanded, as the suffix sort passes it: a power of two.
KNOWN = 128
#: Bytes of segments under one transform, about; and distinct segments of one anchor that go into one.
BLOCK = 1 << 20
GROUP = 8192
#: Entries of one shuffle partition that are looked through at once.
HELD = 1 << 20

_ANCHORS = pa.schema([("bucket", pa.int32()), *[(n, pa.binary()) for n in ("anchors", "segments", "docs", "starts", "counts")]])
_FOUND = pa.schema([
    ("anchor", pa.int64()), ("segment", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()),
])
_TEXTS = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("copies", pa.int32()), ("blocks", pa.int32()), ("bytes", pa.binary())])
_RANGES = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def segments_of(texts: Texts) -> tuple[np.ndarray, ...]:
    """Cut the strings of ``LENGTH`` bytes of each text into runs that share an anchor.

    A string's anchor is its least ``ANCHOR``-gram by hash, the leftmost of equal
    ones. Equal strings have equal anchors, wherever they stand. Gives for each run the
    text, the first string's start, the number of strings, and the hashes of the anchor
    and of all bytes of the run.
    """
    n, grams = len(texts.data), len(texts.data) - ANCHOR + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none
    spans = SpanHash(texts.data)
    at = np.arange(grams)
    least = (spans(at, at + ANCHOR) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, need = 1, LENGTH - ANCHOR + 1
    while 2 * width <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (need - width)], least[need - width :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings that cross the end of a text are none.
    good = np.ones(len(anchor) + LENGTH, bool)
    ends = texts.offsets[1:]
    good[ragged(np.maximum(ends - LENGTH + 1, 0), np.minimum(ends, LENGTH - 1))] = False
    good = good[: len(anchor)]
    new = good.copy()
    new[1:] &= ~good[:-1] | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(new)
    # A run ends before the next one or at the last string of its text.
    text = np.searchsorted(texts.offsets, starts, "right") - 1
    last = np.minimum(np.append(starts[1:], len(anchor)), texts.offsets[text + 1] - LENGTH + 1)
    counts = last - starts
    place = anchor[starts]
    return text, starts, counts, spans(place, place + ANCHOR), spans(starts, starts + counts + LENGTH - 1)


def windows_of(texts: Texts) -> Iterator[tuple[Texts, int]]:
    """Texts, and where they start in their own; a long one in windows that overlap by all but one byte of a string."""
    if len(texts.rows) > 1 or len(texts.data) <= 2 * SLICE:
        yield texts, 0
        return
    for start in range(0, len(texts.data) - LENGTH + 1, SLICE):
        data = texts.data[start : start + SLICE + LENGTH - 1]
        yield Texts(texts.rows, data, np.array([0, len(data)])), start


def _anchor_rows(buckets: int):
    """Runs leave a batch in one row per bucket of their anchors."""

    def run(batches) -> Iterator:
        for rows in batches:
            parts = []
            docs = rows["doc"].to_numpy()
            for whole in texts_of(rows["text"], SLICE):
                for texts, shift in windows_of(whole):
                    text, starts, counts, anchors, segments = segments_of(texts)
                    parts.append((anchors, segments, docs[texts.rows[text]], starts - texts.offsets[text] + shift, counts))
            if not parts:
                continue
            anchors, segments, doc, starts, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            if not len(anchors):
                continue
            bucket = (anchors.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            firsts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(firsts[1:], len(bucket))
            columns = [x[order] for x in (anchors, segments, doc, starts.astype("<i8"), counts.astype("<u2"))]
            yield batch(_ANCHORS, bucket[firsts], *[[c[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)] for c in columns])

    return run


def _repeated(batches) -> Iterator:
    """Runs of one shuffle partition whose anchor stands at two places or more.

    Runs pass by in stretches. Of an anchor that has come once, its run is held; with the second one both go on, and
    any later one goes on at once. So what is held grows with the anchors, not with the places of one.
    """
    kinds = (np.uint64, np.int64, np.int64, "<i8", "<u2")
    once = [np.zeros(0, kind) for kind in kinds]  # by anchor
    twice = np.zeros(0, np.uint64)

    def passed(parts: list[tuple]) -> Iterator:
        nonlocal once, twice
        runs = [np.concatenate(x) for x in zip(*parts, strict=True)]
        known = np.isin(runs[0], twice)
        yield from out([r[known] for r in runs])
        runs = [np.concatenate([o, r[~known]]) for o, r in zip(once, runs, strict=True)]
        order = np.argsort(runs[0], kind="stable")
        runs = [r[order] for r in runs]
        same = runs[0][1:] == runs[0][:-1]
        more = np.append(False, same) | np.append(same, False) if len(runs[0]) else same
        once = [r[~more] for r in runs]
        twice = np.union1d(twice, runs[0][more])
        yield from out([r[more] for r in runs])

    def out(runs: list[np.ndarray]) -> Iterator:
        for a in range(0, len(runs[0]), 200_000):
            at = slice(a, a + 200_000)
            yield batch(_FOUND, runs[0][at].view(np.int64), *[r[at] for r in runs[1:]])

    parts, held = [], 0
    for rows in batches:
        for k in range(rows.num_rows):
            parts.append(tuple(np.frombuffer(rows[name][k].as_buffer(), kind) for name, kind in zip(_ANCHORS.names[1:], kinds, strict=True)))
            held += len(parts[-1][0])
            if held >= HELD:
                yield from passed(parts)
                parts, held = [], 0
    if parts:
        yield from passed(parts)


def _cut(batches) -> Iterator:
    """The bytes of the runs that a text stands for."""
    for rows in batches:
        for text, wanted in zip(rows["text"], rows["wanted"], strict=True):
            raw, runs = memoryview(text.as_buffer()), wanted.values
            names = [runs.field(n) for n in ("anchor", "segment", "copies", "blocks")]
            starts, counts = (runs.field(n).to_numpy() for n in ("start", "windows"))
            for a in range(0, len(runs), 4096):
                at = slice(a, a + 4096)
                cuts = [bytes(raw[x : x + n + LENGTH - 1]) for x, n in zip(starts[at].tolist(), counts[at].tolist(), strict=True)]
                yield batch(_TEXTS, *[n[at] for n in names], cuts)


def sort_suffixes(data: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``least`` bytes or more, and flags of those that differ from the one before within ``depth``.

    Sorts by eight bytes and then doubles; only suffixes with an equal one are sorted
    again, within their place, so flags stay where they are.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    rank = np.zeros(n + 1, np.int64)  # the place of the first equal suffix, plus one; past the end it is 0
    tied, span, known = np.arange(n), 8, None
    while True:
        if span == depth:
            known = new.copy()
        tied = tied[~new[tied] | np.append(~new[1:], False)[tied]]
        if span >= least or not len(tied):
            return order, new if known is None else known
        if span == 8:
            rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
        suffix = order[tied]
        key = (rank[suffix].astype(np.uint64) << np.uint64(32)) | rank[np.minimum(suffix + span, n)].astype(np.uint64)
        again = np.argsort(key)
        order[tied] = suffix = suffix[again]
        key = key[again]
        fresh = np.append(True, key[1:] != key[:-1])
        new[tied] = fresh
        rank[suffix] = tied[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] + 1
        span *= 2


def expand(data: np.ndarray, order: np.ndarray, new: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Flags of the suffixes that share less than ``length`` bytes with the one before, from those for ``depth``.

    Breadth first: a flag of depth d splits an interval of equal prefixes. Extending the interval
    backwards by each byte before its suffixes splits the longer intervals at depth d + 1, at the first suffix past the
    flag with the same byte before it. So the common prefixes come out in the order of their lengths, and the walk ends at ``length``.
    """
    n = len(order)
    before = data[order - 1]  # the transform; text is cyclic, its last byte ends a segment
    inverse = np.argsort(before, kind="stable")  # suffix r is one byte and then suffix inverse[r]
    forward = np.empty(n, np.int64)
    forward[inverse] = np.arange(n)
    new = new.copy()
    new[0] = True
    open_ = np.flatnonzero(~new)
    left, right = inverse[open_ - 1], inverse[open_]
    beside = right == left + 1
    # Two suffixes side by side with one byte before them: their flag moves on as it is.
    moves = np.zeros(n, bool)
    moves[right[beside]] = True
    far, far_left, far_right = open_[~beside], left[~beside], right[~beside]
    fresh = np.flatnonzero(new)
    for _ in range(depth, length):
        groups = np.cumsum(new)
        split = groups[far_left] != groups[far_right]
        found = forward[fresh[moves[fresh]]]
        fresh = np.concatenate([found[~new[found]], far[split]])
        new[fresh] = True
        far, far_left, far_right = far[~split], far_left[~split], far_right[~split]
    return new


def repeated_starts(segments: list[bytes], copies: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Flags over the segments, one after another with a byte between, of starts of strings found twice or more.

    A string counts as often as its segment has copies. No string crosses segments: the byte between them lies
    within ``length`` of every start that would.
    """
    sizes = np.array([len(s) for s in segments])
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    order, new = sort_suffixes(data, KNOWN, length)
    new = expand(data, order, new, KNOWN, length)
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    weight, valid = np.repeat(copies, sizes + 1), np.zeros(len(data), bool)
    valid[ragged(firsts, np.maximum(sizes - length + 1, 0))] = True
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=weight[order] * valid[order])
    flags = np.zeros(len(data), bool)
    flags[order] = total[group] > 1
    return flags & valid


def _expanded(batches) -> Iterator:
    """Rows come sorted by anchor and segment; whole anchors are put under one transform until it is large enough."""

    def done(held: list[tuple]) -> Iterator:
        segments = [bytes(h[2]) for h in held]
        flags = repeated_starts(segments, np.array([h[3] for h in held]))
        edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        firsts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in segments])[:-1]])
        which = np.searchsorted(firsts, starts, "right") - 1
        names = np.array([h[:2] for h in held], np.int64)[which]
        yield batch(_RANGES, names[:, 0], names[:, 1], starts - firsts[which], ends - firsts[which])

    held, size, at, last = [], 0, None, None
    for rows in batches:
        keys = zip(rows["anchor"].to_pylist(), rows["one"].to_pylist(), rows["other"].to_pylist(), strict=True)
        segments, copies = rows["segment"].to_pylist(), rows["copies"].to_pylist()
        for k, key in enumerate(keys):
            # Two groups of one anchor may hold the same run, which is no repeat of itself.
            if at is not None and key != at and (size >= BLOCK or key[0] == at[0]):
                yield from done(held)
                held, size = [], 0
            # Rows of one id and text have each given their runs.
            if (at, last) == (key, segments[k]):
                continue
            at, last = key, segments[k]
            raw = rows["bytes"][k].as_py()
            held.append((key[0], segments[k], raw, copies[k]))
            size += len(raw) + 1
    if held:
        yield from done(held)


def spans(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """``doc``, ``first`` and ``last``: from each byte of [first, last) a repeated string of ``LENGTH`` bytes starts."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"{f.name} {'int' if f.name == 'bucket' else 'binary'}" for f in _ANCHORS)
    anchors = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(_anchor_rows(buckets), columns)
    found = anchors.repartition("bucket").mapInArrow(_repeated, "anchor bigint, segment bigint, doc bigint, start bigint, windows int")
    found = materialize(found, "repeats-anchors")

    # One place of each distinct run, and on how many it stands: two will do, as for any repeat. An anchor
    # with very many distinct runs is cut into blocks, and each pair of blocks has a transform of its own.
    distinct = found.groupBy("anchor", "segment").agg(
        F.min(F.struct("doc", "start", "windows")).alias("__p"), F.least(F.count("*"), F.lit(2)).cast("int").alias("copies")
    )
    distinct = materialize(distinct.select("anchor", "segment", "copies", "__p.*"), "repeats-distinct")
    large = distinct.groupBy("anchor").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("blocks")).where("blocks > 1")
    placed = distinct.join(large, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    wanted = placed.groupBy("doc").agg(F.collect_list(F.struct("anchor", "segment", "copies", "blocks", "start", "windows")).alias("wanted"))
    texts = docs.select(F.col(doc).alias("doc"), F.col(text).cast("binary").alias("text")).join(wanted, "doc")
    cut = texts.select("text", "wanted").mapInArrow(_cut, "anchor bigint, segment bigint, copies int, blocks int, bytes binary")
    cut = cut.withColumn("__b", F.pmod(F.xxhash64("segment"), "blocks").cast("int"))
    dealt = cut.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("anchor", F.least("__b", "__o").alias("one"), F.greatest("__b", "__o").alias("other"), "segment", "copies", "bytes")
    dealt = dealt.repartition("anchor", "one", "other").sortWithinPartitions("anchor", "one", "other", "segment")
    ranges = materialize(dealt.mapInArrow(_expanded, "anchor bigint, segment bigint, first int, last int"), "repeats-ranges")
    discard(distinct)
    return found.join(ranges, ["anchor", "segment"]).select(
        "doc", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last")
    )


def merged(first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the strings starting in [first, last) cover."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + length - 1)
    new = np.append(True, first[1:] > end[:-1])[: len(first)]
    at = np.flatnonzero(new)
    return first[at], np.append(end[at[1:] - 1], end[-1:]) if len(at) else end


def whole_characters(raw: bytes, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Runs made smaller until they start and end between characters; runs inside one character go."""
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = chosen(docs, doc_id=doc_id, text=text)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Rows that are the same in both share their runs, as each repeats the other.
    return rows.withColumn("doc", F.xxhash64("doc_id", "text"))


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and the removed runs as ``first`` and ``last``.

    A byte goes if a string of ``LENGTH`` bytes over it starts anywhere else too. Texts are cut into
    runs of strings by content anchors; runs of one anchor meet in a task, distinct ones once. There a Burrows-Wheeler
    transform over the bytes of whole anchors finds all strings that stand at two places.

    A null text is empty and has no run. A null ``doc_id`` and repeated rows are rows of
    their own; an empty table gives none.
    """
    rows = _keyed(docs, doc_id, text)
    removed = spans(rows).groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    joined = rows.join(removed, "doc", "left").select("doc_id", F.col("text").cast("binary").alias("text"), "runs")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())),
    ])

    def run(batches) -> Iterator:
        for part in batches:
            out = []
            for text, runs in zip(part["text"], part["runs"], strict=True):
                raw = text.as_py()
                first, last, kept = [], [], raw
                if runs.is_valid:
                    pairs = np.array([(r["first"], r["last"]) for r in runs.as_py()], np.int64)
                    a, b = merged(pairs[:, 0], pairs[:, 1])
                    first, last = a.tolist(), b.tolist()
                    kept = b"".join(raw[x:y] for x, y in zip([0, *last], [*first, len(raw)], strict=True))
                out.append((len(raw), len(raw) - len(kept), len(first), hashlib.sha256(kept).hexdigest(), first, last))
            if out:
                yield batch(schema, part["doc_id"], *zip(*out, strict=True))

    return joined.mapInArrow(
        run,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, first array<bigint>, last array<bigint>",
    )


def strip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without the repeated strings in their texts; characters stay whole.

    Every row stays, if need be with an empty text. A null text stays null; null ids and repeated rows are rows of their own, and
    a repeated long row loses all of its text, as each copy repeats the other. An empty table gives none.
    """
    columns = docs.columns
    flat = docs.toDF(*[f"__c{i}" for i in range(len(columns))])
    at = {"doc_id": columns.index(doc_id), "text": columns.index(text)}
    body = f"__c{at['text']}"
    flat = flat.withColumn("__doc", F.xxhash64(F.col(f"__c{at['doc_id']}").cast("bigint"), F.coalesce(body, F.lit(""))))
    found = spans(_keyed(docs, doc_id, text)).groupBy(F.col("doc").alias("__doc")).agg(F.collect_list(F.struct("first", "last")).alias("__runs"))
    joined = flat.join(found, "__doc", "left").select(*[f"__c{i}" for i in range(len(columns))], "__runs")

    def run(batches) -> Iterator:
        for part in batches:
            texts = part[body].to_pylist()
            for k, runs in enumerate(part["__runs"]):
                if runs.is_valid:
                    raw = texts[k].encode()
                    pairs = np.array([(r["first"], r["last"]) for r in runs.as_py()], np.int64)
                    cuts = whole_characters(raw, *merged(pairs[:, 0], pairs[:, 1]))
                    edges = [0, *[x for c in cuts for x in c], len(raw)]
                    texts[k] = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)).decode()
            arrays = [pa.array(texts, part.schema.field(i).type) if i == at["text"] else part.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names[: len(columns)])

    schema = flat.drop("__doc").schema
    return joined.mapInArrow(run, schema).toDF(*columns)
