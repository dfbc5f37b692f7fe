"""A hidden Markov language model over word classes, with each word's count within its class."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .frames import batch, chosen
from .text import texts_of, words_of

STATES = 6
#: Word classes, by hash, at least; there are CLASS_ROOT times the square root of the vocabulary, as a power of two.
CLASSES, CLASS_ROOT = 4096, 8
#: Baum-Welch ends with the round that gains less of log10 likelihood a training token.
TOLERANCE = 0.005
#: Bytes of text whose tokens make one row; words are looked up once for each row.
SLICE = 4 << 20
#: Weight of the class frequencies in a state's emissions.
PRIOR = 500.0
END = np.uint64(0x5E4D0F7E1D)
#: Groups in which parameter counts are added before the last sum, at most, and the bytes of all of them.
SUMS, SUM_BYTES = 64, 32 << 20
#: Tokens whose states a task follows at once.
TOGETHER = 2_000_000
#: Words of one row of a vocabulary.
LISTED = 250_000

SLICES = (
    "slice bigint, doc_ids array<bigint>, held array<boolean>, lengths binary, low binary, high binary, classes binary, "
    "buckets binary, words binary, train binary"
)
_SLICES = pa.schema([
    ("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    *[(n, pa.binary()) for n in ("lengths", "low", "high", "classes", "buckets", "words", "train")],
])
_REQUESTS = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("train", pa.binary())])
_COUNTS = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("words", pa.binary())])
_PART = pa.schema([("task", pa.int32()), ("sums", pa.binary())])
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, known_log double, class_score double, word_score double"
_SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("known_log", pa.float64()), ("class_score", pa.float64()), ("word_score", pa.float64()),
])


def _slice_rows(buckets: int):
    """One row per run of whole texts: its distinct words, commonest first, and its tokens as places in that list."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches) -> Iterator:
        return _sliced(batches, buckets, kind)

    return run


def _sliced(batches, buckets: int, kind: str) -> Iterator:
    number = TaskContext.get().partitionId() << 32
    for rows in batches:
        for texts in texts_of(rows["text"], SLICE):
            words = words_of(texts, lower=True)
            lengths = words.counts + 1
            ends = np.cumsum(lengths) - 1
            tokens = np.empty(len(words.hashes) + len(lengths), np.uint64)
            is_end = np.zeros(len(tokens), bool)
            is_end[ends] = True
            tokens[is_end], tokens[~is_end] = END, words.hashes
            distinct, place, count = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place, distinct = rank[place], distinct[order]
            held = np.array(rows["held"].take(pa.array(texts.rows)).to_pylist(), bool)
            train = np.bincount(place[~np.repeat(held, lengths)], minlength=len(distinct))
            yield batch(
                _SLICES, [number], [rows["doc_id"].take(pa.array(texts.rows)).to_pylist()], [held.tolist()],
                [lengths.astype("<i4").tobytes()], [(place & 0xFFFF).astype("<u2").tobytes()], [(place >> 16).astype("<u2").tobytes()],
                [(distinct & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()],
                [((distinct >> np.uint64(24)) % np.uint64(buckets)).astype(kind).tobytes()], [distinct.tobytes()], [train.astype("<u4").tobytes()],
            )
            number += 1


def _by_bucket(rows, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of a slice's words by bucket: all places, and where each bucket starts and ends among them."""
    words = len(rows["classes"][k].as_buffer()) // 4
    raw = rows["buckets"][k].as_buffer()
    bucket = np.frombuffer(raw, f"<u{len(raw) // words}").astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    firsts = np.flatnonzero(np.append(True, np.diff(bucket[order]) > 0))
    return bucket, order, np.append(firsts, len(order))


def _requests(batches) -> Iterator:
    for rows in batches:
        for k in range(rows.num_rows):
            words = np.frombuffer(rows["words"][k].as_buffer(), np.uint64)
            train = np.frombuffer(rows["train"][k].as_buffer(), "<u4")
            bucket, order, edges = _by_bucket(rows, k)
            cut = lambda x: [x[order[a:b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]  # noqa: B023, E731
            yield batch(_REQUESTS, [rows["slice"][k].as_py()] * (len(edges) - 1), bucket[order[edges[:-1]]], cut(words), cut(train))


def _counted(batches) -> Iterator:
    """Corpus counts of the words of one shuffle partition, sent back to each slice that asks; and its part of the vocabulary."""
    asked: list[tuple] = []
    for rows in batches:
        for k in range(rows.num_rows):
            get = lambda n: rows[n][k].as_buffer()  # noqa: B023, E731
            asked.append((rows["slice"][k].as_py(), rows["bucket"][k].as_py(), np.frombuffer(get("words"), np.uint64), np.frombuffer(get("train"), "<u4")))
    if not asked:
        return
    distinct, place = np.unique(np.concatenate([a[2] for a in asked]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([a[3] for a in asked]), minlength=len(distinct)).astype(np.int64)
    seen = np.flatnonzero(total)
    for a in range(0, len(seen), LISTED):
        at = seen[a : a + LISTED]
        yield batch(_COUNTS, [-1], [len(at)], [total[at].astype("<i8").tobytes()], [(distinct[at] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()])
    kind = "<u4" if total.max(initial=0) < 1 << 32 else "<u8"
    ends = np.cumsum([len(a[2]) for a in asked])
    for (name, bucket, words, _), end in zip(asked, ends, strict=True):
        counts = total[place[end - len(words) : end]].astype(kind).tobytes()
        yield batch(_COUNTS, [name], [bucket], [counts], [b""])


def _class_sums(classes: int):
    """Training tokens and distinct training words of each class, from parts of the vocabulary."""

    def run(batches) -> Iterator:
        sums = np.zeros(2 * classes)
        for rows in batches:
            for k in range(rows.num_rows):
                of = np.frombuffer(rows["words"][k].as_buffer(), "<u4").astype(np.int64) % classes
                sums[:classes] += np.bincount(of, weights=np.frombuffer(rows["counts"][k].as_buffer(), "<i8"), minlength=classes)
                sums[classes:] += np.bincount(of, minlength=classes)
        yield batch(_PART, [TaskContext.get().partitionId()], [sums.astype("<f8").tobytes()])

    return run


def _added(batches) -> Iterator:
    sums, task = None, 0
    for rows in batches:
        for task, raw in zip(rows["task"].to_pylist(), rows["sums"], strict=True):
            one = np.frombuffer(raw.as_buffer(), "<f8")
            sums = one.copy() if sums is None else sums + one
    if sums is not None:
        yield batch(_PART, [task], [sums.tobytes()])


def gathered(df: DataFrame, length: int) -> np.ndarray | None:
    """The sum of all vectors in ``sums``, ``length`` numbers each. So many reach the driver as fit in ``SUM_BYTES``, ``SUMS`` at most."""
    groups = max(1, min(SUMS, SUM_BYTES // (8 * length)))
    for many in (groups * 16, groups):
        df = df.withColumn("task", F.pmod("task", F.lit(many))).repartition("task").mapInArrow(_added, "task int, sums binary")
    parts = df.collect()
    return sum(np.frombuffer(p["sums"], "<f8") for p in parts) if parts else None


@dataclass
class Model:
    start: np.ndarray  # state
    move: np.ndarray  # state, next state
    emit: np.ndarray  # class, state

    @classmethod
    def first(cls, class_counts: np.ndarray) -> Model:
        """Every state near the class frequencies, each off in its own way, and prone to stay."""
        rng = np.random.Generator(np.random.PCG64(5))
        emit = _frequencies(class_counts)[:, None] * np.exp(0.7 * rng.standard_normal((len(class_counts), STATES)))
        move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def of(cls, sums: np.ndarray, class_counts: np.ndarray) -> Model:
        """The model of the expected counts, with a little of every class and move."""
        start, move = sums[:STATES] + 1.0, sums[STATES : STATES + STATES**2].reshape(STATES, STATES) + 1.0
        emit = sums[STATES + STATES**2 : -2].reshape(-1, STATES) + PRIOR * _frequencies(class_counts)[:, None]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _frequencies(class_counts: np.ndarray) -> np.ndarray:
    return (class_counts + 1.0) / (class_counts.sum() + len(class_counts))


class Lanes:
    """Token sequences side by side, the longest first, so that step t works on the first ``active[t]`` of them."""

    def __init__(self, symbols: np.ndarray, firsts: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        # Symbols in the order of steps.
        lanes = np.arange(self.offsets[-1]) - np.repeat(self.offsets[:-1], self.active)
        steps = np.repeat(np.arange(longest), self.active)
        self.symbols = symbols[firsts[self.order[lanes]] + steps]

    def forward(self, model: Model, keep: bool = False):
        """log10 likelihood of each sequence by the scaled recursion; with ``keep`` all scaled states and scales."""
        n = len(self.order)
        score = np.zeros(n)
        alphas = np.empty((self.offsets[-1], STATES)) if keep else None
        scales = np.empty(self.offsets[-1]) if keep else None
        alpha = None
        for t, active in enumerate(self.active):
            at = slice(self.offsets[t], self.offsets[t + 1])
            alpha = np.broadcast_to(model.start, (active, STATES)) if t == 0 else alpha[:active] @ model.move
            alpha = alpha * model.emit[self.symbols[at]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            score[:active] += np.log10(scale)
            if keep:
                alphas[at], scales[at] = alpha, scale
        out = np.empty(n)
        out[self.order] = score
        return out, alphas, scales

    def expected(self, model: Model) -> np.ndarray:
        """Expected numbers of starts, moves and emissions, by the forward and backward recursions; last the log10 likelihood and the tokens."""
        scores, alphas, scales = self.forward(model, keep=True)
        moves = np.zeros((STATES, STATES))
        beta = np.ones((0, STATES))
        for t in range(len(self.active) - 1, -1, -1):
            a, b = self.offsets[t], self.offsets[t + 1]
            if len(beta) < b - a:
                beta = np.concatenate([beta, np.ones((b - a - len(beta), STATES))])
            weighted = model.emit[self.symbols[a:b]] * beta / scales[a:b, None] if t else None
            alphas[a:b] *= beta  # now the odds of the states
            if t:
                before = self.offsets[t - 1]
                # Not yet multiplied: step t - 1 comes next.
                moves += alphas[before : before + b - a].T @ weighted
                beta = weighted @ model.move.T
        emitted = [np.bincount(self.symbols, weights=alphas[:, k], minlength=len(model.emit)) for k in range(STATES)]
        start = alphas[: self.offsets[1]].sum(axis=0) if len(self.active) else np.zeros(STATES)
        return np.concatenate([start, (moves * model.move).ravel(), np.stack(emitted, axis=1).ravel(), [scores.sum(), len(self.symbols)]])


def _tokens(rows, k: int, n_classes: int):
    lengths = np.frombuffer(rows["lengths"][k].as_buffer(), "<i4").astype(np.int64)
    low = np.frombuffer(rows["low"][k].as_buffer(), "<u2").astype(np.int64)
    place = low | np.frombuffer(rows["high"][k].as_buffer(), "<u2").astype(np.int64) << 16
    classes = np.frombuffer(rows["classes"][k].as_buffer(), "<u4").astype(np.int64) % n_classes
    return lengths, np.cumsum(lengths) - lengths, place, classes


def _expectation(model: Model):
    def run(batches) -> Iterator:
        sums, held, size = None, [], 0

        def add() -> np.ndarray:
            symbols, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
            found = Lanes(symbols, np.cumsum(lengths) - lengths, lengths).expected(model)
            return found if sums is None else sums + found

        for rows in batches:
            for k in range(rows.num_rows):
                lengths, _, place, classes = _tokens(rows, k, len(model.emit))
                train = ~np.array(rows["held"][k].as_py(), bool)
                if not train.any():
                    continue
                symbols = classes[place[np.repeat(train, lengths)]]
                held.append((symbols, lengths[train]))
                size += len(symbols)
                # Few steps are as long as the longest text; slices together share them.
                if size >= TOGETHER:
                    sums, held, size = add(), [], 0
        if held:
            sums = add()
        if sums is not None:
            yield batch(_PART, [TaskContext.get().partitionId()], [sums.astype("<f8").tobytes()])

    return run


def _scored(model: Model, class_counts: np.ndarray, class_types: np.ndarray):
    def run(batches) -> Iterator:
        for rows in batches:
            for k in range(rows.num_rows):
                lengths, firsts, place, classes = _tokens(rows, k, len(model.emit))
                bucket, order, edges = _by_bucket(rows, k)
                replies = {r["bucket"]: r["counts"] for r in rows["replies"][k].as_py()}
                counts = np.zeros(len(classes))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    raw = replies[bucket[order[a]]]
                    counts[order[a:b]] = np.frombuffer(raw, f"<u{len(raw) // (b - a)}")
                in_class = np.log10((counts + 1) / (class_counts[classes] + class_types[classes] + 1))
                add = lambda x: np.add.reduceat(x[place], firsts)  # noqa: B023, E731
                score, _, _ = Lanes(classes[place], firsts, lengths).forward(model)
                yield batch(
                    _SCORES, rows["doc_ids"][k].as_py(), rows["held"][k].as_py(), lengths, add((counts > 0).astype(np.int64)),
                    add(np.log10(counts + 1)), score, add(in_class),
                )

    return run


def trained(tokens: DataFrame, class_counts: np.ndarray) -> Model:
    """The model after rounds of Baum-Welch over all training texts, until one gains less than ``TOLERANCE`` a token."""
    model, length, before = Model.first(class_counts), STATES + STATES**2 + STATES * len(class_counts) + 2, None
    while True:
        expected = gathered(tokens.mapInArrow(_expectation(model), "task int, sums binary"), length)
        if expected is None:
            return model
        model, now = Model.of(expected, class_counts), expected[-2] / max(expected[-1], 1.0)
        if before is not None and now - before < TOLERANCE:
            return model
        before = now


def scores(docs: DataFrame, held: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's log10 likelihood under the model, and under add-one word frequencies (``base_score``).

    A word is emitted by its class: P(word) = P(class given state) *
    (count + 1) / (count of class + types of class + 1), counted over all training texts. Words fall into classes by hash, and the classes
    grow with the square root of the vocabulary, so that a state's emissions tell more words apart in a larger corpus while the table stays
    small. Each slice of the corpus asks for the counts of its distinct words, which meet by a hash of the word, once per slice however
    common. Baum-Welch adds the expected counts of all training texts over the tasks until the likelihood of the training
    texts has settled (``trained``). The forward recursion is scaled at each token, so it is exact for texts of any length.

    ``held`` is a boolean column: rows where it is true or null are scored only. A text ends
    with one end token; null and empty texts are that token alone. Null ids and repeated rows are
    rows of their own. An empty table gives none; without training rows, all counts are zero.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(held), F.lit(True)).alias("held")
    )
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = materialize(rows.mapInArrow(_slice_rows(buckets), SLICES), "hmm-slices")
    asking = slices.select("slice", "classes", "buckets", "words", "train")
    requests = asking.mapInArrow(_requests, "slice bigint, bucket int, words binary, train binary")
    counted = requests.repartition("bucket").mapInArrow(_counted, "slice bigint, bucket int, counts binary, words binary")
    counted = materialize(counted, "hmm-counts")
    vocabulary = counted.where("slice = -1")
    types = vocabulary.agg(F.sum(F.col("bucket").cast("bigint"))).first()[0] or 0
    classes = max(CLASSES, 1 << int(CLASS_ROOT * types**0.5).bit_length())
    sums = gathered(vocabulary.select("counts", "words").mapInArrow(_class_sums(classes), "task int, sums binary"), 2 * classes)
    sums = np.zeros(2 * classes) if sums is None else sums
    class_counts, class_types = sums[:classes], sums[classes:]
    model = trained(slices.select("held", "lengths", "low", "high", "classes"), class_counts)

    replies = counted.where("slice >= 0").select("slice", "bucket", "counts").repartition("slice")
    replies = replies.groupBy("slice").agg(F.collect_list(F.struct("bucket", "counts")).alias("replies"))
    joined = slices.drop("words", "train").join(replies, "slice")
    joined = joined.select("doc_ids", "held", "lengths", "low", "high", "classes", "buckets", "replies")
    found = joined.mapInArrow(_scored(model, class_counts, class_types), SCORES)
    n, v = float(class_counts.sum()), float(class_types.sum())
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("bigint").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (F.col("class_score") + F.col("word_score")).alias("score"),
    )


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``scores`` with every seventh document, by a checksum of its id, held out; a null id is held out too."""
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return scores(chosen(docs, doc_id=doc_id, text=text).withColumn("held", held), "held")
