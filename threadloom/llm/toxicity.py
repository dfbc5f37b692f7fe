"""Toxic passages: maximal scoring segments of word log-odds, calibrated by the extreme values of clean texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .frames import batch, chosen
from .text import SpanHash, Texts, Words, sorted_distinct, texts_of, words_of

#: Labelled rows that the model is fitted on at most, those least by a hash of their id.
LABELLED = 20_000
#: The prior that the corpus as a whole adds to either side, as a share of all counts.
PRIOR = 0.1
#: Bytes of the beginnings of longer words that are features as well as whole words, for words that are inflected.
BEGINNINGS = (5, 6, 7)
#: A listed feature is in toxic texts more often by a factor of e**ODDS at least, and by CERTAIN standard errors.
ODDS, CERTAIN = 1.0, 4.0
#: What each word without a listed feature takes from a passage.
GAP = 0.15

#: Words here are runs of letters, digits and bytes above ASCII, so marks do not matter.
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_COUNTS = pa.schema([("word", pa.int64()), ("toxic", pa.bool_()), ("n", pa.int64())])
_EVIDENCE = pa.schema([("toxic", pa.bool_()), ("n_words", pa.int64()), ("best", pa.float64()), ("total", pa.list_(pa.float64()))])
SCORED = "doc_id bigint, score double, predicted int, first array<bigint>, last array<bigint>, gain array<double>"
_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()),
    ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("gain", pa.list_(pa.float64())),
])


def features_of(texts: Texts) -> tuple[Words, list[tuple[np.ndarray, np.ndarray]]]:
    """The words of some texts, and their features: the words that have each kind, and its hashes."""
    spans = SpanHash(texts.data, lower=True)
    words = words_of(texts, lower=True, breaks=BREAKS, hashes=spans)
    kinds = [(np.arange(len(words.starts)), words.hashes)]
    for size in BEGINNINGS:
        at = np.flatnonzero(words.ends - words.starts > size)
        kinds.append((at, spans(words.starts[at], words.starts[at] + size)))
    return words, kinds


def maximal_segments(places: list[int], gains: list[float], gap: float = GAP) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text, in time linear in the listed words.

    ``places`` are the listed words' places, ``gains`` their positive scores; every word between costs
    ``gap``. Each candidate keeps the sums of all scores before it and up to its end; a new one is joined to
    the nearest earlier candidate that starts lower and ends lower, as often as there is one.
    """
    found: list[tuple[float, float, int, int]] = []
    total, last = 0.0, -1
    for place, gain in zip(places, gains, strict=True):
        total -= gap * (place - last - 1)
        left, total, first, last = total, total + gain, place, place
        right = total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, last))
                break
            left, first = found[j][0], found[j][2]
            del found[j:]
    return [(first, end, right - left) for left, right, first, end in found]


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # ascending hashes
    gains: np.ndarray
    scale: float  # lambda of the extreme-value law
    size: float  # K of the extreme-value law
    slope: float
    offset: float

    def segments(self, texts: Texts) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """Number of words and maximal segments of each text."""
        words, kinds = features_of(texts)
        best = np.zeros(len(words.starts))
        for of, hashes in kinds if len(self.words) else []:
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == hashes)
            best[of[hit]] = np.maximum(best[of[hit]], self.gains[at[hit]])
        hits = np.flatnonzero(best)
        gains = best[hits]
        bounds = np.searchsorted(hits, words.firsts)
        for k, count in enumerate(words.counts.tolist()):
            a, b = bounds[k], bounds[k + 1]
            if a == b:
                yield count, []
            else:
                yield count, maximal_segments((hits[a:b] - words.firsts[k]).tolist(), gains[a:b].tolist())

    def evidence(self, n_words: int, scores: list[float]) -> float:
        """What the passages' scores are above the best that chance gives in as many clean words, in nats."""
        level = np.log(max(self.size * n_words, 1.0))
        return float(sum(max(self.scale * s - level, 0.0) for s in scores) + 0.1 * self.scale * sum(scores))

    def probability(self, evidence) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.asarray(evidence) + self.offset)))


def _count_words(batches) -> Iterator:
    for rows in batches:
        toxic = np.array(rows["toxic"].to_pylist(), bool)
        for texts in texts_of(rows["text"]):
            words, kinds = features_of(texts)
            owner, feature = sorted_distinct(
                np.concatenate([words.owners()[of] for of, _ in kinds]), np.concatenate([hashes for _, hashes in kinds])
            )
            for side in (False, True):
                word, n = np.unique(feature[toxic[texts.rows[owner]] == side], return_counts=True)
                if len(word):
                    yield batch(_COUNTS, word.view(np.int64), np.full(len(word), side), n)


def _evidence(model: Model):
    def run(batches) -> Iterator:
        for rows in batches:
            toxic = rows["toxic"].to_pylist()
            for texts in texts_of(rows["text"]):
                out = []
                for row, (n, found) in zip(texts.rows, model.segments(texts), strict=True):
                    gains = [s for _, _, s in found]
                    out.append((toxic[row], n, max(gains, default=0.0), gains))
                yield batch(_EVIDENCE, *zip(*out, strict=True))

    return run


def _tilt(gains: np.ndarray, odds: np.ndarray) -> float:
    """lambda > 0 with sum(odds * exp(lambda * gain)) = 1 over listed and unlisted words."""
    rest = max(1 - odds.sum(), 1e-9)
    mean = lambda x: (odds * np.exp(np.minimum(x * gains, 700))).sum() + rest * np.exp(-x * GAP) - 1
    low, high = 0.0, 1e-3
    while mean(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y) by Newton's method, with a little ridge on the slope."""
    beta = np.array([0.0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    rows = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (y - p) - np.array([0.01, 0.0]) * beta
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([0.01, 1e-9])
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", labelled: int = LABELLED
) -> Model:
    """The table of words and beginnings, and the calibration, from labelled documents.

    ``labels`` has an id and a 0/1 label; null labels and ids are left out, an id with several labels has the largest.
    At most ``labelled`` of them are used, and of an id with several texts the first by a hash, so the sample that is broadcast, the word
    table and the calibration rows that reach the driver are all bounded by it. Scores are log-odds of the number of toxic against clean texts with the
    feature, either side smoothed by a Dirichlet prior in proportion to its frequency in both. Without any labelled row of one kind, no word is listed.
    """
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col(label) > 0).alias("toxic"))
    named = named.dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    rows = chosen(docs, doc_id=doc_id, text=text).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    first = F.min(F.struct(F.xxhash64("text"), "text", "toxic")).alias("__r")
    rows = materialize(rows.groupBy("doc_id").agg(first).select("__r.text", "__r.toxic"), "labelled")

    counts = rows.mapInArrow(_count_words, "word bigint, toxic boolean, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(~F.col("toxic"), F.col("n")).otherwise(0)).alias("c")
    )
    sums = counts.agg(F.sum("t"), F.sum("c")).first()
    n_toxic, n_clean = float(sums[0] or 0), float(sums[1] or 0)
    every = max(n_toxic + n_clean, 1.0)
    prior = F.lit(PRIOR) * (F.col("t") + F.col("c"))
    odds = lambda y, n: F.log((F.col(y) + prior) / (F.lit(n + PRIOR * every) - F.col(y) - prior))
    listed = counts.withColumn("gain", odds("t", n_toxic) - odds("c", n_clean))
    listed = listed.withColumn("z", F.col("gain") / F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior)))
    listed = listed.where((F.col("gain") >= ODDS) & (F.col("z") >= CERTAIN))
    table = listed.select("word", "gain", "c").collect() if n_toxic and n_clean else []
    words = np.array([r["word"] for r in table], np.int64).view(np.uint64)
    order = np.argsort(words)
    words = words[order]
    gains = np.array([r["gain"] for r in table], float)[order]
    clean = np.array([r["c"] for r in table], float)[order] / max(n_clean, 1.0)

    model = Model(words, gains, _tilt(gains, clean + 1e-12) if len(words) else 1.0, 0.0, 0.0, 0.0)
    found = rows.mapInArrow(_evidence(model), "toxic boolean, n_words bigint, best double, total array<double>").collect()
    toxic = np.array([r["toxic"] for r in found], float)
    # P(best < s) = exp(-K n exp(-lambda s)) in clean texts; the likeliest K of theirs.
    still = [r["n_words"] * np.exp(-model.scale * r["best"]) for r in found if not r["toxic"]]
    size = len(still) / max(sum(still), 1e-9) if still else 1.0
    model = Model(words, gains, model.scale, size, 0.0, 0.0)
    evidence = np.array([model.evidence(r["n_words"], r["total"]) for r in found], float)
    slope, offset = _logistic(evidence, toxic) if len(found) else (0.0, -10.0)
    return Model(words, gains, model.scale, size, slope, offset)


def passages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``score``, ``predicted``, and its maximal segments: ``first`` and ``last`` word and ``gain`` of each.

    One pass without a shuffle over whole texts. A null or empty text has no segment and the score of no evidence. Null
    ids and repeated rows come out as they are; an empty table gives none.
    """

    def run(batches) -> Iterator:
        for rows in batches:
            for texts in texts_of(rows["text"]):
                found = list(model.segments(texts))
                gains = [[s for _, _, s in x] for _, x in found]
                odds = model.probability([model.evidence(n, g) for (n, _), g in zip(found, gains, strict=True)])
                yield batch(
                    _SCORED, rows["doc_id"].take(pa.array(texts.rows)), odds, (odds >= 0.5).astype(np.int32),
                    [[a for a, _, _ in x] for _, x in found], [[b for _, b, _ in x] for _, x in found], gains,
                )

    rows = chosen(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(run, SCORED)
