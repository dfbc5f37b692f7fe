"""Phrases whose words keep together, the best of each language, by best-first growth of phrases with bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import number_rows, top_per_group
from ..session import discard, materialize
from .frames import batch, chosen
from .text import _ORDER, SLICE, SPACES, Texts, mix, ragged, texts_of, words_of

#: Words of a phrase at most, its occurrences at least, and phrases wanted of a language.
WORDS = 5
LEAST = 100
TOP = 2000
#: One round expands first words of counts within this factor, the rarest of each language that are left.
GROWTH = 16
#: Bits of a set of keys that goes to all tasks: at most 32 MB, whatever the number of keys. More keys let more pass; sums are exact all the same.
MOST_BITS = 28
CHUNK_BITS = 16

#: What ends a piece of text, and what parts its words.
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
BREAKS = ENDS | SPACES
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SLICES = pa.schema([
    ("lang", pa.string()), ("size", pa.int64()), ("words", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
    ("low", pa.binary()), ("high", pa.binary()), ("breaks", pa.binary()),
])  # fmt: skip
_SLICE_COLUMNS = "lang string, size bigint, words array<bigint>, texts array<string>, counts array<int>, low binary, high binary, breaks binary"
_COUNTS = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])
_CHUNKS = pa.schema([("chunk", pa.int64()), ("bits", pa.binary())])
_CUTS = pa.schema([(n, pa.int64()) for n in ("key", "k", "left_key", "right_key", "first", "pair")])
_TARGETS = pa.schema([(n, pa.int64()) for n in ("key", "f", "left_least", "left_most", "right_least", "right_most")])


class KeySet:
    """A set of 64-bit keys in a bounded number of bits: what is in it passes, and some others."""

    def __init__(self, chunks: list, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.bytes = np.zeros(1 << (bits - 3), np.uint8)
        for chunk, raw in chunks:
            at = chunk << (CHUNK_BITS - 3)
            self.bytes[at : at + len(raw)] = np.frombuffer(raw, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.view(np.uint64) & self.mask
        return (self.bytes[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def key_set(keys: DataFrame, count: int) -> KeySet:
    """The set of the keys in the one column of ``keys``, built chunk by chunk in tasks."""
    bits = min(max(CHUNK_BITS, (8 * count).bit_length()), MOST_BITS)
    mask = (1 << bits) - 1

    def build(batches) -> Iterator:
        chunks: dict[int, np.ndarray] = {}
        for rows in batches:
            slots = rows["slot"].to_numpy()
            for chunk in np.unique(slots >> CHUNK_BITS).tolist():
                flags = chunks.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint8))
                flags[slots[slots >> CHUNK_BITS == chunk] & ((1 << CHUNK_BITS) - 1)] = 1
        for chunk, flags in chunks.items():
            yield batch(_CHUNKS, [chunk], [np.packbits(flags, bitorder="little").tobytes()])

    slots = keys.toDF("slot").select(F.col("slot").bitwiseAND(F.lit(mask)).alias("slot"))
    dealt = slots.repartition(F.shiftright("slot", CHUNK_BITS))
    return KeySet([(r["chunk"], r["bits"]) for r in dealt.mapInArrow(build, "chunk bigint, bits binary").collect()], bits)


def phrase_keys(words: np.ndarray) -> np.ndarray:
    """Hashes of phrases, one a row of word hashes."""
    value = np.zeros(len(words), np.uint64)
    for j in range(words.shape[1]):
        value += words[:, j] * _ORDER[j]
    return mix(value + np.uint64(words.shape[1]))


def _stretches(texts: Texts) -> Iterator[Texts]:
    """A long text in stretches that end with a piece, which no phrase crosses."""
    if len(texts.rows) > 1 or len(texts.data) <= 2 * SLICE:
        yield texts
        return
    start, n = 0, len(texts.data)
    while start < n:
        end = min(start + SLICE, n)
        while end < n:
            near = np.flatnonzero(ENDS[texts.data[end : end + SLICE]])
            end = min(end + SLICE, n) if not len(near) else end + int(near[0]) + 1
            if len(near):
                break
        yield Texts(texts.rows, texts.data[start:end], np.array([0, end - start]))
        start = end


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[ragged(starts, lengths)]].tobytes()))


def _encoded(batches) -> Iterator:
    """Slices of one language: the distinct words with their counts, and the text as places among them."""
    for rows in batches:
        langs = pc.fill_null(rows["lang"], "und").dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in names], np.uint64)
        for whole in texts_of(rows["text"]):
            for texts in _stretches(whole):
                words = words_of(texts, True, BREAKS)
                if not len(words.hashes):
                    continue
                ends = np.concatenate([[0], np.cumsum(ENDS[texts.data])])
                breaks = np.ones(len(words.hashes), bool)
                breaks[1:] = ends[words.starts[1:]] != ends[words.ends[:-1]]
                breaks[words.firsts[:-1][words.counts > 0]] = True
                owner = code[texts.rows][words.owners()]
                for k in np.unique(owner).tolist():
                    at = np.flatnonzero(owner == k)
                    hashes = mix(words.hashes[at] ^ salts[k])
                    distinct, first, place, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                    order = np.argsort(-count, kind="stable")
                    rank = np.empty(len(order), np.int64)
                    rank[order] = np.arange(len(order))
                    place, first = rank[place], at[first[order]]
                    strings = _strings(texts.data, words.starts[first], words.ends[first])
                    one = np.array([0, len(order)], np.int32)
                    yield batch(
                        _SLICES, [names[k]], [len(at)], pa.ListArray.from_arrays(one, distinct[order].view(np.int64)),
                        pa.ListArray.from_arrays(one, strings), pa.ListArray.from_arrays(one, count[order].astype(np.int32)),
                        [(place & 0xFFFF).astype("<u2").tobytes()], [(place >> 16).astype("<u2").tobytes()], [np.packbits(breaks[at]).tobytes()],
                    )  # fmt: skip


def _word_counts(batches) -> Iterator:
    for rows in batches:
        sizes = np.diff(rows["words"].offsets.to_numpy())
        langs = rows["lang"].take(pa.array(np.repeat(np.arange(rows.num_rows), sizes)))
        yield batch(_COUNTS, rows["words"].flatten(), langs, rows["texts"].flatten(), rows["counts"].flatten())


def _slices(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each slice's word hashes, the place of each of its words among them, and flags of the words that start a piece."""
    for rows in batches:
        for k in range(rows.num_rows):
            words = rows["words"][k].values.to_numpy().view(np.uint64)
            low, high = (np.frombuffer(rows[n][k].as_buffer(), "<u2").astype(np.int64) for n in ("low", "high"))
            breaks = np.unpackbits(np.frombuffer(rows["breaks"][k].as_buffer(), np.uint8), count=len(low)).astype(bool)
            yield words, low | high << 16, np.append(breaks, True)


def _grown(size: int, heavy, band, prefixes: list):
    """Phrases of ``size`` words that begin in the band and whose every shorter beginning is frequent, counted by slice."""
    schema = pa.schema([("key", pa.int64()), *[(f"w{j}", pa.int64()) for j in range(size)], ("f", pa.int64())])

    def run(batches) -> Iterator:
        for words, place, breaks in _slices(batches):
            frequent, first = heavy.value(words), band.value(words)
            at = np.flatnonzero(first[place[: len(place) - size + 1]]) if len(place) >= size else np.zeros(0, np.int64)
            value = words[place[at]] * _ORDER[0]
            for j in range(1, size):
                on = np.flatnonzero(~breaks[at + j] & frequent[place[at + j]])
                at, value = at[on], value[on] + words[place[at[on] + j]] * _ORDER[j]
                if j + 1 < size:
                    on = np.flatnonzero(prefixes[j - 1].value(mix(value + np.uint64(j + 1))))
                    at, value = at[on], value[on]
            if not len(at):
                continue
            keys, index, count = np.unique(mix(value + np.uint64(size)), return_index=True, return_counts=True)
            columns = [words[place[at[index] + j]].view(np.int64) for j in range(size)]
            yield batch(schema, keys.view(np.int64), *columns, count)

    return run


def _cuts(batches) -> Iterator:
    """Every cut of every candidate: the keys of both parts, and of the right part's first word and first two."""
    for rows in batches:
        lists = rows["words"]
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy().view(np.uint64)
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        keys = rows["key"].to_numpy()
        part = lambda at, m: (flat[at] if m == 1 else phrase_keys(flat[at[:, None] + np.arange(m)])).view(np.int64)  # noqa: B023, E731
        for m in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == m)
            # The whole phrase comes as the right part of a cut before its first word.
            for k in range(m):
                start = firsts[of] + k
                left = np.zeros(len(of), np.int64) if k == 0 else part(firsts[of], k)
                pair = part(start, 2) if m - k > 1 else np.zeros(len(of), np.int64)
                yield batch(_CUTS, keys[of], np.full(len(of), k), left, part(start, m - k), part(start, 1), pair)


def _looked_up(wanted):
    """Counts of the phrases in a set of keys, and the words before and after them: least and most, 0 for none."""

    def run(batches) -> Iterator:
        for words, place, breaks in _slices(batches):
            signed = words.view(np.int64)
            at = np.flatnonzero(wanted.value(words)[place])
            value = words[place[at]] * _ORDER[0]
            found = []
            for j in range(1, WORDS):
                on = np.flatnonzero(~breaks[at + j])  # past the last word there is a break
                at, value = at[on], value[on] + words[place[at[on] + j]] * _ORDER[j]
                key = mix(value + np.uint64(j + 1))
                hit = wanted.value(key)
                if j == 1:
                    at, value, key = at[hit], value[hit], key[hit]
                    hit = hit[hit]
                found.append((key[hit], at[hit], np.full(int(hit.sum()), j + 1)))
            key, at, size = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(key):
                continue
            before = np.where(breaks[at], 0, signed[place[at - 1]])
            end = at + size
            after = np.where(breaks[end], 0, signed[place[np.minimum(end, len(place) - 1)]])
            order = np.argsort(key, kind="stable")
            key, before, after = key[order], before[order], after[order]
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            yield batch(
                _TARGETS, key[edge].view(np.int64), np.diff(np.append(edge, len(key))), np.minimum.reduceat(before, edge),
                np.maximum.reduceat(before, edge), np.minimum.reduceat(after, edge), np.maximum.reduceat(after, edge),
            )  # fmt: skip

    return run


class _Growth:
    """The encoded texts of one run, and the rounds over them."""

    def __init__(self, docs: DataFrame, lang: str, text: str):
        self.spark: SparkSession = docs.sparkSession
        rows = chosen(docs, lang=lang, text=text)
        self.slices = materialize(rows.mapInArrow(_encoded, _SLICE_COLUMNS), "phrases-slices")
        counted = self.slices.select("lang", "words", "texts", "counts").mapInArrow(_word_counts, "h bigint, lang string, word string, f bigint")
        counted = counted.groupBy("h", "lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST)
        sizes = self.slices.groupBy("lang").agg(F.sum("size").alias("n"))
        self.words = materialize(counted.join(sizes, "lang"), "phrases-words")
        self.tokens = self.slices.select("words", "low", "high", "breaks")
        #: For each language the counts up to which first words have been expanded, and the score that is sure of a place.
        self.state = materialize(sizes.select("lang", F.lit(LEAST).cast("bigint").alias("upto"), F.lit(None).cast("bigint").alias("least")), "phrases-state")
        self.kept: DataFrame | None = None
        self.heavy = self._sent(self.words.select("h"))

    def _sent(self, keys: DataFrame):
        return self.spark.sparkContext.broadcast(key_set(keys, keys.count()))

    def frontier(self) -> DataFrame | None:
        """The first words to expand next: the rarest of each language whose bound reaches the last place.

        Of a phrase with count a, cut after its first word w, the score is 1000 a n / (f(w) f(rest)) rounded down, and
        a is at most f(rest). So 1000 n / f(w), rounded down, bounds all phrases that begin with w.
        """
        open_ = self.words.join(self.state, "lang").where("f >= upto and (least is null or (1000 * n) div f >= least)")
        rarest = open_.groupBy("lang").agg(F.min("f").alias("__least")).select("lang", (F.col("__least") * GROWTH).alias("next"))
        band = materialize(open_.join(rarest, "lang").where("f < next").select("h", "lang", "n", "next"), "phrases-band")
        return band if band.limit(1).count() else None

    def candidates(self, band: DataFrame) -> DataFrame | None:
        """Frequent phrases that begin with a word of the band, grown word by word from the frequent ones."""
        first, prefixes, found = self._sent(band.select("h")), [], []
        for size in range(2, WORDS + 1):
            words = [f"w{j}" for j in range(size)]
            schema = f"key bigint, {', '.join(f'{w} bigint' for w in words)}, f bigint"
            grown = self.tokens.mapInArrow(_grown(size, self.heavy, first, prefixes), schema)
            grown = grown.groupBy("key", *words).agg(F.sum("f").alias("a")).where(F.col("a") >= LEAST)
            # The set of first words lets a few others pass.
            grown = grown.join(band.select(F.col("h").alias("w0"), "lang", "n"), "w0")
            grown = materialize(grown.select("key", F.array(*words).alias("words"), "a", "lang", "n"), "phrases-grown")
            if not grown.limit(1).count():
                break
            found.append(grown)
            prefixes.append(self._sent(grown.select("key")))
        out = None
        for frame in found:
            out = frame if out is None else out.unionByName(frame)
        return out

    def scored(self, candidates: DataFrame) -> DataFrame:
        """Candidates that are no part of a longer one as frequent, with their least cut."""
        cuts = materialize(candidates.select("key", "words").mapInArrow(_cuts, "key bigint, k bigint, left_key bigint, right_key bigint, first bigint, pair bigint"), "phrases-cuts")
        longer = cuts.where("pair <> 0")
        wanted = longer.select("right_key").union(longer.select("pair")).union(longer.select("first")).distinct()
        schema = ", ".join(f"{n} bigint" for n in _TARGETS.names)
        seen = self.tokens.mapInArrow(_looked_up(self._sent(wanted)), schema).groupBy("key").agg(
            F.sum("f").alias("f"), F.min("left_least").alias("__l0"), F.max("left_most").alias("__l1"),
            F.min("right_least").alias("__r0"), F.max("right_most").alias("__r1"),
        )  # fmt: skip
        seen = materialize(seen.join(longer.select(F.col("right_key").alias("key")).distinct(), "key", "left_semi"), "phrases-seen")
        known = self.words.select(F.col("h").alias("key"), "f").union(seen.select("key", "f"))
        left = known.select(F.col("key").alias("left_key"), F.col("f").alias("l"))
        right = known.select(F.col("key").alias("right_key"), F.col("f").alias("r"))
        # The same word before each occurrence, or after each, makes a longer candidate of the same count.
        inside = "size(words) < {} and ((__l0 = __l1 and __l0 <> 0) or (__r0 = __r1 and __r0 <> 0))".format(WORDS)
        alone = candidates.join(seen.drop("f"), "key").where(f"not ({inside})").select("key", "words", "a", "lang", "n")
        wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
        cut = cuts.where("k > 0").join(left, "left_key").join(right, "right_key").select("key", "k", "l", "r")
        both = alone.join(cut, "key").withColumns({f"__{c}": v for c, v in wide.items()})
        both = both.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * (__a * __n)) div (__l * __r)"))
        least = both.groupBy("key", "words", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("__c"))
        return least.select("lang", "words", "a", "__c.l", "__c.r", "n", "__c.score")

    def settle(self, band: DataFrame, scored: DataFrame | None) -> None:
        """Keep what may have a place, and raise each language's bound to the score of its last place."""
        if scored is not None:
            kept = materialize(scored if self.kept is None else self.kept.unionByName(scored), "phrases-kept")
            scores = kept.select("lang", "score", F.monotonically_increasing_id().alias("id"))
            place = number_rows(scores, ["lang"], [F.col("score").desc(), F.col("id")])
            last = place.where(F.col("position") == TOP).select("lang", F.col("score").alias("__last"))
            kept = kept.join(last, "lang", "left").where("__last is null or score >= __last").drop("__last")
            self.kept = materialize(kept, "phrases-kept")
        else:
            last = self.state.select("lang", F.col("least").alias("__last")).where("__last is not null")
        next_ = band.groupBy("lang").agg(F.max("next").alias("__next"))
        state = self.state.join(next_, "lang", "left").join(last, "lang", "left")
        state = state.select("lang", F.coalesce("__next", "upto").alias("upto"), F.greatest("least", "__last").alias("least"))
        self.state = materialize(state, "phrases-state")


def best(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``: the first ``TOP`` phrases of each language.

    A phrase has 2 to ``WORDS`` words within a piece of text and a >= ``LEAST`` occurrences. Its score is the least,
    over its cuts into l and r occurrences, of 1000 a n / (l r) rounded down. One that stands inside a longer one
    as often is left out. Order: score and a falling, then the phrase.

    Texts are encoded once. Each round then expands the first words of each language whose bound is highest, word by
    word from the frequent beginnings, counts the right parts that the cuts need, and ends a language once no
    bound reaches its ``TOP``-th score; ties are settled too. Counts are summed before and in the shuffle, so a phrase in every document costs
    a row a task. Sets that go to tasks have a fixed size; words are told apart by 64-bit hashes.

    A null text is empty; a null language is ``und``. Repeated rows count as often as they stand. An empty
    table, or one without a frequent phrase, gives no row. Other columns are not read.
    """
    growth = _Growth(docs, lang, text)
    while (band := growth.frontier()) is not None:
        candidates = growth.candidates(band)
        growth.settle(band, None if candidates is None else growth.scored(candidates))
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if growth.kept is None:
        kinds = {"lang": "string", "phrase": "string"}
        return growth.spark.createDataFrame([], ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in columns))
    words = growth.kept.select("*", F.posexplode("words").alias("__at", "h"))
    words = words.join(growth.words.select("h", "word"), "h")
    phrases = words.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(F.sort_array(F.collect_list(F.struct("__at", "word"))).alias("__w"))
    phrases = phrases.withColumn("phrase", F.concat_ws(" ", F.col("__w.word"))).drop("__w", "words")
    phrases = materialize(phrases, "phrases-text")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    out = top_per_group(phrases, ["lang"], order, TOP, rank="rank").select(*columns)
    discard(growth.slices)
    return out


def sql(table: str = "documents") -> str:
    """The rows of ``best`` in DuckDB's SQL, from the counts of all phrases."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    sizes = ", ".join(f"({m})" for m in range(1, WORDS + 1))
    return rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?
-]')) AS piece FROM {table}),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spoken, (VALUES {sizes}) AS v(m))),
f AS (SELECT lang, m, g, count(*) AS f FROM grams GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
held AS (SELECT * FROM f WHERE m > 1 AND f >= {LEAST}),
alone AS (SELECT * FROM held h WHERE NOT EXISTS (
    SELECT 1 FROM held b WHERE b.lang = h.lang AND b.m > h.m AND 100 * b.f >= 100 * h.f AND contains(' ' || b.g || ' ', ' ' || h.g || ' '))),
cuts AS (SELECT lang, m, g, f, string_split(g, ' ') AS w, unnest(range(1, m)) AS k FROM alone),
cut AS (SELECT lang, g, f, k, array_to_string(w[1:k], ' ') AS lg, array_to_string(w[k + 1:m], ' ') AS rg FROM cuts),
scored AS (SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, n.n, c.k,
      CAST((CAST(1000 AS HUGEINT) * c.f * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cut c JOIN f x ON x.lang = c.lang AND x.g = c.lg JOIN f y ON y.lang = c.lang AND y.g = c.rg JOIN n ON n.lang = c.lang),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM least WHERE o = 1)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}"""
