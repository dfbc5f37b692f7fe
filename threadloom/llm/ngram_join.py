"""Similarity join of texts by the Jaccard index of their word shingles, through parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .frames import batch, chosen
from .graph import components
from .text import Texts, mix, ragged, shingles_of, texts_of, words_of

SHINGLE = 5
#: 100 * shared >= PERCENT * all
PERCENT = 80
#: A band holds sizes from RATIO**k to RATIO**(k + 1).
RATIO = 1.5
#: Blocks of a sketch against the differences that it has to stand, so that poor blocks can be left out.
SLACK = 1.3
#: Keys that a task holds before it sends them off.
HELD = 500_000
#: Members of a key that one task compares with each other at once.
GROUP = 2048
#: A key of at most so many members gives its pairs of sets, which are told apart over all keys before their sketches meet.
SMALL = 16
#: Words of sketches that are compared at once.
WORK = 1 << 19

#: Keys of a bucket (with their sets), or rows of the table (``nulls``: which of them have no id).
_KEYS = pa.schema([
    ("bucket", pa.int32()), ("keys", pa.binary()), ("sets", pa.binary()), ("sizes", pa.binary()), ("rows", pa.binary()), ("nulls", pa.binary()),
])
ROW, HUB, PAIR, MEMBER = range(4)
#: By kind: a row's doc_id, set, size and row key; a hub and a member; two other members of a small key; a large key and a member.
_MET = pa.schema([("kind", pa.int32()), ("one", pa.int64()), ("other", pa.int64()), ("size", pa.int32()), ("row_key", pa.int64())])
_CONTENT = pa.schema([("set_id", pa.int64()), ("size", pa.int32()), ("shingles", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_APART = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("apart", pa.int32())])
_ASKED = pa.schema([("key", pa.int64()), ("member", pa.int64()), ("other", pa.int64())])


def _most_apart(a, b):
    """The largest symmetric difference of linked sets of sizes a and b: shared >= r / (1 + r) * (a + b), r the index."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def _bands(largest: int) -> np.ndarray:
    """First size of each band."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] * RATIO))))
    return np.array(starts)


class Sets:
    """The distinct shingle hashes of some texts, those of one text side by side and ascending."""

    def __init__(self, texts: Texts):
        value, owner, _ = shingles_of(words_of(texts, lower=True), SHINGLE, short=True)
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
        ends = np.cumsum(np.bincount(owner, minlength=len(texts.rows)))
        for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            if b - a > 1:
                value[a:b].sort()
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        self.owner, self.value = owner[new], value[new]
        self.sizes = np.bincount(self.owner, minlength=len(texts.rows))
        self.firsts = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.zeros(len(self.value) + 1, np.uint64)
        np.cumsum(mix(self.value + np.uint64(1)), out=sums[1:])
        # Equal sets have equal ids; 64 bits tell others apart.
        self.ids = mix(sums[self.firsts[1:]] - sums[self.firsts[:-1]] + self.sizes.astype(np.uint64)).view(np.int64)


def sketch_keys(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which any two linked, unequal sets share one, and the set of each key.

    A band's sketch is ``blocks`` blocks of parity bits: a shingle's hash picks one block
    and the bit to flip there. So each shingle that only one of two sets holds flips
    one bit, the sketches' Hamming distance is at most the difference of the
    sets, and at most as many blocks differ. A block's 2**64 bits are kept as the XOR of the places
    of its set bits. Of the blocks in an order that equal blocks share (most
    shingles first), the first ``apart`` + 1 of both sets have one in common,
    as for any two lists that overlap in all but ``apart`` places.
    A set is sketched for its own band, and for the band below if a linked set may be there.
    """
    sizes = sets.sizes
    starts = _bands(int(sizes.max(initial=1)))
    home = np.searchsorted(starts, np.maximum(sizes, 1), "right") - 1
    keys, owners = [], []
    for guest in (False, True):
        band = home - guest
        below = starts[home] - 1  # the largest size of the band below
        if guest:
            apart = _most_apart(sizes, below)
            use = (home > 0) & (PERCENT * sizes <= 100 * below)
        else:
            apart = _most_apart(sizes, sizes * 100 // PERCENT)
            use = sizes > 0
        use &= apart > 0  # sets that stand no difference link with equal sets only
        if not use.any():
            continue
        top = starts[np.minimum(band + 1, len(starts) - 1)] - 1
        blocks = np.ceil(SLACK * (_most_apart(top, top * 100 // PERCENT) + 1)).astype(np.int64)
        mine = np.flatnonzero(use[sets.owner])
        owner, value = sets.owner[mine], sets.value[mine]
        block = ((value >> np.uint64(32)) * blocks[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(mine), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        bits = np.bitwise_xor.reduceat(mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
        count = np.diff(np.append(first, len(mine)))
        owner, block = owner[first], block[first]
        # Blocks without shingles come last; they are needed only where too few others exist.
        filled = np.bincount(owner, minlength=len(sizes))
        short = np.flatnonzero(use & (filled < apart + 1))
        if len(short):
            full_owner = np.repeat(short, blocks[short])
            full_block = np.concatenate([np.arange(blocks[s]) for s in short])
            have = np.isin(full_owner * (1 << 40) + full_block, owner * (1 << 40) + block)
            owner = np.concatenate([owner, full_owner[~have]])
            bits = np.concatenate([bits, np.zeros((~have).sum(), np.uint64)])
            count = np.concatenate([count, np.zeros((~have).sum(), np.int64)])
            block = np.concatenate([block, full_block[~have]])
        key = mix(bits ^ mix(block.astype(np.uint64) * np.uint64(1 << 20) + band[owner].astype(np.uint64) + np.uint64(1)))
        # Most shingles first, then by key; no two blocks of a set are the same, so none tie.
        place = (255 - np.minimum(count, 255)).astype(np.uint64) << np.uint64(56)
        place |= (key >> np.uint64(40)) << np.uint64(32) | block.astype(np.uint64)
        if len(short):
            order = np.argsort(owner, kind="stable")
            owner, key, place = owner[order], key[order], place[order]
        last = np.full(len(sizes), np.iinfo(np.uint64).max, np.uint64)
        ends = np.cumsum(np.bincount(owner, minlength=len(sizes)))
        mine = np.flatnonzero(use)
        starts_at = np.append(0, ends[:-1])[mine]
        for k, a, b, most in zip(mine.tolist(), starts_at.tolist(), ends[mine].tolist(), apart[mine].tolist(), strict=True):
            if b - a > most + 1:
                last[k] = np.partition(place[a:b], most)[most]
        taken = place <= last[owner]
        keys.append(key[taken])
        owners.append(owner[taken])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _key_rows(buckets: int):
    """Keys leave a batch in one row per bucket, equal sets once; the batch's own rows follow in one more."""

    def grouped(parts: list[tuple]) -> Iterator:
        key, ids, sizes = (np.concatenate([p[k] for p in parts]) for k in range(3))
        bucket = (key % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, key, ids, sizes = bucket[order], key[order], ids[order], sizes[order].astype("<u4")
        firsts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(firsts[1:], len(bucket))
        cut = lambda x: [x[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)]
        none = [None] * len(firsts)
        yield batch(_KEYS, bucket[firsts], cut(key), cut(ids), cut(sizes), none, none)
        doc, sets, size, row, null = (np.concatenate([p[k] for p in parts]) for k in range(3, 8))
        there = [[x.tobytes()] for x in (doc, sets, size.astype("<u4"), row, null)]
        yield batch(_KEYS, [int(sets[0]) % buckets], *there)

    def run(batches) -> Iterator:
        for rows in batches:
            parts = []
            null = rows["doc_id"].is_null().to_numpy(zero_copy_only=False)
            doc, row = (rows[name].fill_null(0).to_numpy() for name in ("doc_id", "row_key"))
            seen: set[int] = set()
            for texts in texts_of(rows["text"]):
                sets = Sets(texts)
                key, owner = sketch_keys(sets)
                fresh = np.zeros(len(sets.ids), bool)
                ids, firsts = np.unique(sets.ids, return_index=True)
                fresh[[k for i, k in zip(ids.tolist(), firsts.tolist(), strict=True) if i not in seen]] = True
                seen.update(ids.tolist())
                key, owner = key[fresh[owner]], owner[fresh[owner]]
                at = texts.rows
                parts.append((key, sets.ids[owner], sets.sizes[owner], doc[at], sets.ids, sets.sizes, row[at], null[at]))
                if sum(len(p[0]) for p in parts) > HELD:
                    yield from grouped(parts)
                    parts, seen = [], set()
            if parts:
                yield from grouped(parts)

    return run


def _met(kind: int, one, other) -> pa.RecordBatch:
    none = pa.nulls(len(one))
    return batch(_MET, np.full(len(one), kind), one, other, none, none)


def _pairs(kind: int, ids: np.ndarray, sizes: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """The distinct pairs among those at places ``one`` and ``other`` whose sizes let them link."""
    low, high = np.minimum(sizes[one], sizes[other]), np.maximum(sizes[one], sizes[other])
    use = 100 * low >= PERCENT * high
    a, b = ids[one[use]], ids[other[use]]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return _met(kind, a[new], b[new])


def _joined(small: int):
    """What meets in the keys of one shuffle partition; the table's rows go on as they are.

    A key's least set is the hub of the others. The other pairs of a key come out if it has at most ``small`` members, else its members do.
    """

    def run(batches) -> Iterator:
        parts: list[tuple] = []
        for rows in batches:
            for k in range(rows.num_rows):
                get = lambda name, kind: np.frombuffer(rows[name][k].as_buffer(), kind)  # noqa: B023, E731
                found = get("keys", np.uint64), get("sets", np.int64), get("sizes", "<u4")
                if rows["rows"][k].is_valid:
                    doc = pa.array(found[0].view(np.int64), mask=get("nulls", bool))
                    yield batch(_MET, np.full(len(doc), ROW), doc, found[1], found[2], get("rows", np.int64))
                else:
                    parts.append(found)
        if not parts:
            return
        key, ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        order = order[np.append(same, False) | np.append(False, same)]  # most keys have one member
        key, ids, sizes = key[order], ids[order], sizes[order].astype(np.int64)
        order = np.lexsort((ids, key))
        key, ids, sizes = key[order], ids[order], sizes[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, ids, sizes = key[new], ids[new], sizes[new]
        firsts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(firsts[1:], len(key))
        for a in range(0, len(firsts), 50_000):
            first, end = firsts[a : a + 50_000], ends[a : a + 50_000]
            hub, stop = np.repeat(first, end - first), np.repeat(end, end - first)
            at = np.arange(first[0], end[-1])
            rest = at != hub
            hub, stop, at = hub[rest], stop[rest], at[rest]
            begin = stop - at - 1  # members after this one
            yield _pairs(HUB, ids, sizes, hub, at)
            few = np.flatnonzero((at - hub + begin < small) & (begin > 0))
            yield _pairs(PAIR, ids, sizes, np.repeat(at[few], begin[few]), ragged(at[few] + 1, begin[few]))
            big = end - first > small
            at = ragged(first[big], (end - first)[big])
            for b in range(0, len(at), 200_000):
                yield _met(MEMBER, key[at[b : b + 200_000]].view(np.int64), ids[at[b : b + 200_000]])

    return run


def _contents(batches) -> Iterator:
    for rows in batches:
        for texts in texts_of(rows["text"]):
            sets = Sets(texts)
            raw = [sets.value[a:b].tobytes() for a, b in zip(sets.firsts[:-1], sets.firsts[1:], strict=True)]
            want = rows["set_id"].take(pa.array(texts.rows)).to_numpy()
            same = np.flatnonzero(want == sets.ids)
            yield batch(_CONTENT, sets.ids[same], sets.sizes[same], [raw[i] for i in same])


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.sort(np.concatenate([a, b]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _verified(batches) -> Iterator:
    """Rows come sorted by (hub, salt), the hub's own first: the hub is held, the others stream by."""
    at, held = None, None
    for rows in batches:
        a, b = [], []
        hubs, salts, members = rows["hub"].to_pylist(), rows["salt"].to_pylist(), rows["set_id"].to_pylist()
        for k, (hub, salt, member) in enumerate(zip(hubs, salts, members, strict=True)):
            shingles = np.frombuffer(rows["shingles"][k].as_buffer(), np.uint64)
            if member == hub:
                at, held = (hub, salt), shingles.copy()
            elif at == (hub, salt) and _linked(held, shingles):
                a.append(hub)
                b.append(member)
        yield batch(_PAIRS, a, b)


def verify(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs (hub, member) whose sets do link.

    A hub's set travels once for about a thousand members, so a hub of any
    number of members is dealt over many tasks, and a task holds two sets at a time.
    """
    salts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / 1000).cast("int").alias("salts"))
    members = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("member"), "salts").cast("int").alias("salt"), F.col("member").alias("set_id"))
    hubs = salts.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("hub").alias("set_id"))
    rows = members.union(hubs).join(contents, "set_id").select(
        "hub", "salt", (F.col("set_id") != F.col("hub")).alias("other"), "set_id", "shingles"
    )
    dealt = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "other")
    return dealt.mapInArrow(_verified, "a bigint, b bigint")


def _fold(raw: bytes, bits: int) -> np.ndarray:
    """Parity of the shingles that fall on each of ``bits`` bits."""
    value = np.frombuffer(raw, np.uint64)
    return np.bincount((value & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1


def _sketch_rows(batches) -> Iterator:
    schema = pa.schema([("set_id", pa.int64()), ("size", pa.int32()), ("sketch", pa.binary())])
    for rows in batches:
        raws = [x.as_buffer() for x in rows["shingles"]]
        bits = [1 << max(6, (4 * n).bit_length()) for n in rows["size"].to_pylist()]
        yield batch(schema, rows["set_id"], rows["size"], [np.packbits(_fold(r, b)).tobytes() for r, b in zip(raws, bits, strict=True)])


def _halved(sketch: np.ndarray, length: int) -> np.ndarray:
    """The sketch of fewer bits: the bits that meet are added without carry."""
    while sketch.shape[-1] > length:
        # Bit i of the larger sketch is bit i modulo the smaller length.
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _by_length(sketches: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the sketches of each length, and these sketches as rows of words."""
    sketches = sketches.cast(pa.large_binary())
    _, offsets, data = sketches.buffers()
    offsets = np.frombuffer(offsets, np.int64)[sketches.offset : sketches.offset + len(sketches) + 1]
    data = np.frombuffer(data, np.uint8)
    lengths = np.diff(offsets)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        if len(at) == at[-1] - at[0] + 1:
            raw = data[offsets[at[0]] : offsets[at[-1] + 1]].reshape(len(at), n)
        else:
            raw = np.stack([data[a : a + n] for a in offsets[at].tolist()])
        yield at, np.ascontiguousarray(raw).view(np.uint64)


def _bits_apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    length = min(one.shape[1], other.shape[1])
    return np.bitwise_count(_halved(one, length) ^ _halved(other, length)).sum(axis=1, dtype=np.int64)


def _near_pairs(batches) -> Iterator:
    """The pairs whose sketches are near enough."""
    for rows in batches:
        a, b = (rows[name].to_numpy() for name in ("a", "b"))
        most = _most_apart(rows["size_a"].to_numpy().astype(np.int64), rows["size_b"].to_numpy().astype(np.int64))
        apart = np.zeros(len(a), np.int64)
        where = np.zeros(len(a), np.int64)
        others = list(_by_length(rows["sketch_b"]))
        for at_a, one in _by_length(rows["sketch_a"]):
            where[at_a] = np.arange(len(at_a))
            mine = np.zeros(len(a), bool)
            mine[at_a] = True
            for at_b, other in others:
                both = np.flatnonzero(mine[at_b])
                step = max(1, WORK // max(one.shape[1], other.shape[1]))
                for k in range(0, len(both), step):
                    at = at_b[both[k : k + step]]
                    apart[at] = _bits_apart(one[where[at]], other[both[k : k + step]])
        near = apart <= most
        yield batch(_APART, a[near], b[near], apart[near])


def _near(nearest: bool):
    """Pairs of different labels in one key, whose sketches are near enough, of the blocks of members dealt here.

    With ``nearest``, the nearest partner of each member that has any; else each pair once.
    """

    def pairs_of(group: pa.Table, key: int, one: int, other: int) -> Iterator:
        ids, sizes, labels, blocks = (group[k].to_numpy() for k in ("member", "size", "label", "block"))
        sizes = sizes.astype(np.int64)
        kinds = list(_by_length(group["sketch"].combine_chunks()))
        # Of two members of different labels, one at least is not of the commonest.
        values, counts = np.unique(labels, return_counts=True)
        minor = labels != values[counts.argmax()]
        best, partner = np.full(len(ids), np.iinfo(np.int64).max), np.full(len(ids), -1)
        for rows, mine in kinds:
            picked = np.flatnonzero(minor[rows])
            for columns, theirs in kinds:
                length = min(mine.shape[1], theirs.shape[1])
                x, y = _halved(mine[picked], length), _halved(theirs, length)
                step = max(1, WORK // (len(columns) * length))
                for k in range(0, len(picked), step):
                    i, j = rows[picked[k : k + step]][:, None], columns[None, :]
                    use = (labels[i] != labels[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= PERCENT * np.maximum(sizes[i], sizes[j]))
                    use &= ~minor[j] | (i < j)
                    if one != other:
                        use &= blocks[i] != blocks[j]
                    p, q = np.nonzero(use)
                    apart = _bits_apart(x[k + p], y[q])
                    i, j = i[p, 0], columns[q]
                    near = apart <= _most_apart(sizes[i], sizes[j])
                    i, j, apart = i[near], j[near], apart[near]
                    if not len(i):
                        continue
                    if not nearest:
                        yield batch(_ASKED, np.full(len(i), key), ids[i], ids[j])
                        continue
                    i, j, apart = np.concatenate([i, j]), np.concatenate([j, i]), np.tile(apart, 2)
                    order = np.lexsort((apart, i))
                    order = order[np.append(True, i[order[1:]] != i[order[:-1]])]
                    order = order[apart[order] < best[i[order]]]
                    best[i[order]], partner[i[order]] = apart[order], j[order]
        has = np.flatnonzero(partner >= 0)
        if len(has):
            yield batch(_ASKED, np.full(len(has), key), ids[has], ids[partner[has]])

    def run(batches) -> Iterator:
        at, held = None, []
        for rows in batches:
            if not rows.num_rows:
                continue
            group = [rows[name].to_numpy() for name in ("key", "one", "other")]
            new = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in group], axis=0)))
            for a, b in zip(new.tolist(), np.append(new[1:], rows.num_rows).tolist(), strict=True):
                now = tuple(int(x[a]) for x in group)
                if held and now != at:
                    yield from pairs_of(pa.Table.from_batches(held), *at)
                    held = []
                at = now
                held.append(rows.slice(a, b - a))
        if held:
            yield from pairs_of(pa.Table.from_batches(held), *at)

    return run


def _labelled(rows: DataFrame, labels: DataFrame, member: str, name: str) -> DataFrame:
    label = labels.select(F.col("node").alias(member), F.col("component").alias("__c"))
    return rows.join(label, member, "left").withColumn(name, F.coalesce("__c", member)).drop("__c")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not connected yet."""
    return _labelled(_labelled(pairs, labels, "a", "__a"), labels, "b", "__b").where("__a <> __b").drop("__a", "__b")


def _compared(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches are near enough, and the bits between these."""
    for name in ("a", "b"):
        pairs = pairs.join(sketches.toDF(name, f"size_{name}", f"sketch_{name}"), name)
    return pairs.mapInArrow(_near_pairs, "a bigint, b bigint, apart int")


def _nearest(pairs: DataFrame) -> DataFrame:
    """The pair of each member that is least apart."""
    asked = [pairs.select(F.col(x).alias("member"), F.struct("apart", F.col(y).alias("other")).alias("__p")) for x, y in ("ab", "ba")]
    best = asked[0].union(asked[1]).groupBy("member").agg(F.min("__p").alias("__p"))
    return best.select("member", F.col("__p.other").alias("other"))


def _rest(members: DataFrame, labels: DataFrame, sketches: DataFrame, nearest: bool) -> DataFrame:
    """Pairs that share a large key, are not connected yet, and are near by their sketches, each with the key.

    Only keys whose members have different labels are left. Very large ones are
    cut into blocks of ``GROUP`` members, and each pair of blocks is a group of its own.
    """
    rows = _labelled(members, labels, "member", "label")
    mixed = rows.groupBy("key").agg(F.min("label").alias("__a"), F.max("label").alias("__b"), F.count("*").alias("__n"))
    mixed = mixed.where("__a <> __b").select("key", F.ceil(F.col("__n") / GROUP).cast("int").alias("__blocks"))
    rows = rows.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("member"), F.col("__blocks")).cast("int"))
    rows = rows.select("key", "member", "label", "block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__o"))
    rows = rows.withColumns({"one": F.least("block", "__o"), "other": F.greatest("block", "__o")})
    rows = rows.join(sketches, rows["member"] == sketches["set_id"]).select("key", "one", "other", "block", "member", "size", "label", "sketch")
    rows = rows.repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "size")
    return rows.mapInArrow(_near(nearest), "key bigint, member bigint, other bigint")


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The set of each row (``doc_id``, ``n_shingles``, ``set_id``), and verified links that connect all that any links do.

    Links are between sets, so copies cost nothing here. Sketch keys are joined in numpy, one shuffle
    partition at a time. A key's least set is its hub: hubs are verified against their members first. Then
    members of a key that are still apart are compared by their sketches: the nearest are verified, round by round, until
    they connect no more, and in the end all that are left. So every pair of unequal sets that shares a
    key has been verified, lies too far apart by its sketch, or was connected already. The pairs of small keys are compared once; of a
    large key, a member that is near no other one of another label takes no part in later rounds, as labels only merge.
    """
    spark = docs.sparkSession
    rows = chosen(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # A row without an id is found again by its text; other rows of that key are told apart by their sets.
    rows = rows.withColumn("row_key", F.coalesce("doc_id", F.xxhash64("text")))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.mapInArrow(_key_rows(buckets), "bucket int, keys binary, sets binary, sizes binary, rows binary, nulls binary").repartition("bucket")
    met = materialize(keys.mapInArrow(_joined(SMALL), "kind int, one bigint, other bigint, size int, row_key bigint"), "ngram-met")
    of = lambda kind: met.where(F.col("kind") == kind)
    sets = of(ROW).select(
        F.col("one").alias("doc_id"), F.col("size").cast("bigint").alias("n_shingles"), F.col("other").alias("set_id"), "row_key"
    )
    large = of(MEMBER).select(F.col("one").alias("key"), F.col("other").alias("member"))
    pairs = materialize(of(HUB).select(F.col("one").alias("hub"), F.col("other").alias("member")).distinct(), "ngram-pairs")

    paired = met.where(F.col("kind").isin(HUB, PAIR)).select(F.explode(F.array("one", "other")).alias("set_id"))
    wanted = paired.union(large.select("member")).distinct()
    first = sets.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("row_key").alias("row_key"))
    texts = rows.select("row_key", "text").join(first, "row_key").select("set_id", "text")
    contents = texts.mapInArrow(_contents, "set_id bigint, size int, shingles binary").dropDuplicates(["set_id"])
    contents = materialize(contents, "ngram-contents")

    found = materialize(verify(pairs, contents), "ngram-links")
    labels = components(found)
    sketches = contents.select("set_id", "size", "shingles").mapInArrow(_sketch_rows, "set_id bigint, size int, sketch binary")
    sketches = materialize(sketches, "ngram-sketches")
    tested = pairs.toDF("a", "b")  # a hub is the least of its key
    close = of(PAIR).select(F.col("one").alias("a"), F.col("other").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    close = materialize(_compared(_apart(close, labels), sketches), "ngram-close")
    nearest = True
    while True:
        asked = materialize(_rest(large, labels, sketches, nearest), "ngram-near")
        few = _apart(close, labels)
        few = _nearest(few) if nearest else few.select(F.col("a").alias("member"), F.col("b").alias("other"))
        more = asked.select("member", "other").union(few)
        more = more.select(F.least("member", "other").alias("a"), F.greatest("member", "other").alias("b")).distinct()
        more = more.join(tested, ["a", "b"], "left_anti")
        more = materialize(more.select(F.col("a").alias("hub"), F.col("b").alias("member")), "ngram-pairs")
        linked = materialize(verify(more, contents), "ngram-links")
        found = found.union(linked)
        if not nearest:
            return sets, found
        # While the nearest ones still connect something, few pairs do; then all that are left.
        tested = tested.union(more.toDF("a", "b"))
        large = asked.select("key", "member").distinct()
        nearest = linked.take(1) != []
        if nearest:
            labels = components(found)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``n_shingles``, and ``component_id``, the smallest doc_id that links lead to.

    Texts of less than five words are one shingle. Null and empty texts have none and link with nothing. Equal
    texts link. Rows with a null ``doc_id`` take part, but name no component unless all its rows have none.
    An empty table gives none.
    """
    sets, found = links(docs, doc_id, text)
    labels = components(found)
    joined = sets.join(labels, sets["set_id"] == labels["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "set_id").alias("__class")
    )
    joined = joined.withColumn("__class", F.when(F.col("n_shingles") > 0, F.col("__class")))
    least = joined.where("__class IS NOT NULL").groupBy("__class").agg(F.min("doc_id").alias("__least"))
    return joined.join(least, "__class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("__class").isNull(), F.col("doc_id")).otherwise(F.col("__least")).alias("component_id")
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each class: the one that names it, its smallest doc_id.

    Rows without a shingle are no copies of each other and all stay. If rows of a class share its smallest id, one
    stays; of classes without an id, one row does.
    """
    columns = docs.columns
    flat = docs.toDF(*[f"__c{i}" for i in range(len(columns))])
    name, body = f"__c{columns.index(doc_id)}", f"__c{columns.index(text)}"
    sets, found = links(docs, doc_id, text)
    labels = components(found)
    joined = sets.join(labels, sets["set_id"] == labels["node"], "left")
    joined = joined.where("n_shingles > 0").select("doc_id", "row_key", "set_id", F.coalesce("component", "set_id").alias("__class"))
    # The first row of each class, a null id last; its set tells it from other rows of its id.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "set_id"))
    kept = joined.groupBy("__class").agg(first.alias("__k")).select("__k.row_key", "__k.set_id")
    has_word = F.coalesce(F.col(body).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = flat.withColumn("row_key", F.coalesce(F.col(name).cast("bigint"), F.xxhash64(body)))

    def with_sets(batches) -> Iterator:
        for part in batches:
            ids = [Sets(texts).ids for texts in texts_of(part[body])]
            ids = pa.array(np.concatenate([np.zeros(0, np.int64), *ids]), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "set_id"])

    full = rows.where(has_word).mapInArrow(with_sets, StructType([*rows.schema, StructField("set_id", LongType())]))
    full = full.join(kept, ["row_key", "set_id"]).dropDuplicates(["row_key", "set_id"]).select(*flat.columns)
    return full.union(flat.where(~has_word)).toDF(*columns)
