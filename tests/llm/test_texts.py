"""Operators on documents against brute force, with every odd row at once."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from data import DOCS, odd_documents, prose
from threadloom.llm import hidden_markov, licenses, mixing, ngram_join, packing, quality, repeats, token_files, toxicity
from threadloom.llm.tokens import Encoder, vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns with names that operators use inside.
    frame = spark.createDataFrame(odd_documents(), DOCS).repartition(3)
    return frame.select("*", F.lit(1).alias("key"), F.lit("x").alias("size"), F.lit(2).alias("__row"), F.lit(3).alias("doc")).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def bag(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_ngram_classes(docs, none):
    rows = [(r[0], r[1]) for r in odd_documents()]
    known = brute.jaccard_classes([(1 << 40 if i is None else i, t) for i, t in rows])
    expected = Counter()
    for (i, t), (_, n, c) in zip(rows, known, strict=True):
        expected[(i, n, (i if not brute.shingles(t) else None if c == 1 << 40 else c))] += 1
    assert bag(ngram_join.classes(docs), "doc_id", "n_shingles", "component_id") == expected
    assert ngram_join.classes(none).count() == 0


def test_sketch_keys_meet():
    import pyarrow as pa

    from threadloom.llm.text import texts_of

    rng = np.random.default_rng(4)
    for n in (4, 5, 9, 30, 100, 700):
        words = [f"w{i}" for i in range(n + 4)]
        for _ in range(20):
            other = words[:]
            for _ in range(rng.integers(0, max(2, n // 40 + 1))):
                other[rng.integers(len(other))] = f"o{rng.integers(9999)}"
            a, b = " ".join(words), " ".join(other[: len(other) - rng.integers(0, n // 8 + 1)])
            (texts,) = texts_of(pa.array([a, b]))
            sets = ngram_join.Sets(texts)
            one, two = brute.shingles(a), brute.shingles(b)
            if 100 * len(one & two) >= 80 * len(one | two) and one != two:
                keys, owner = ngram_join.sketch_keys(sets)
                assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_many_members_of_a_key(spark, monkeypatch):
    """A key cut into blocks loses no pair."""
    monkeypatch.setattr(ngram_join, "GROUP", 3)
    base = prose(11, 60).split()
    rows = []
    for k in range(40):
        words = base[:]
        words[k % 60] = f"x{k % 7}"
        words[(7 * k) % 60] = f"y{k % 5}"
        rows.append((k, " ".join(words)))
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(brute.jaccard_classes(rows))


def test_pairs_of_small_and_of_large_keys(spark, monkeypatch):
    """Keys of up to three members give pairs, larger ones go on as keys, cut into blocks."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "GROUP", 5)
    rows = []
    for k in range(60):
        words = prose(20 + k % 4, 50 + 30 * (k % 4)).split()
        for i in range(k % 9):
            words[(7 * k + 11 * i) % len(words)] = f"x{k}"
        rows.append((k, " ".join(words)))
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(brute.jaccard_classes(rows))


def test_members_that_are_near_no_other_are_compared_once(spark, monkeypatch):
    """Texts with a common passage share keys, but no two are alike: later rounds have nothing to compare."""
    compared, rest = [], ngram_join._rest
    monkeypatch.setattr(ngram_join, "_rest", lambda members, *more: compared.append(members.count()) or rest(members, *more))
    passage = prose(12, 48)
    rows = [(k, f"{passage} {' '.join(f'w{k}x{i}' for i in range(12))}") for k in range(40)]
    found = ngram_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(brute.jaccard_classes(rows))
    assert compared[0] > 0 and compared[1:] == [0]


def test_repeats(docs, none):
    rows = odd_documents()
    expected = Counter((r[0], *m) for r, m in zip(rows, brute.repeats([r[1] for r in rows]), strict=True))
    assert bag(repeats.remove(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert repeats.remove(none).count() == 0


def test_repeats_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 2)
    passage = prose(21, 50)
    rows = [(k, prose(k + 50, 30 + k) + passage + prose(k + 90, 20)) for k in range(12)]
    found = repeats.remove(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id")
    got = [tuple(r) for r in found.select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert got == brute.repeats([t for _, t in rows])


def test_strip_keeps_columns_and_characters(docs):
    found = repeats.strip(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    assert {r["text"] for r in found.where("doc_id in (2, 15, 16)").collect()} == {None, ""}


def test_transform_against_counting():
    rng = np.random.default_rng(2)
    for _ in range(10):
        base = [bytes(rng.choice(list(b"ab cd"), 500).tolist()) for _ in range(3)]
        cut = [base[rng.integers(3)][rng.integers(200) :][: rng.integers(1, 450)] for _ in range(9)]
        copies = rng.integers(1, 3, 9)
        seen = Counter()
        for s, c in zip(cut, copies, strict=True):
            for i in range(len(s) - 199):
                seen[s[i : i + 200]] += c
        flags = [f for s in cut for f in [*[i <= len(s) - 200 and seen[s[i : i + 200]] > 1 for i in range(len(s))], False]]
        assert repeats.repeated_starts(cut, copies).tolist() == flags


def test_quality(docs, none):
    expected = Counter((r[0], *brute.measures(r[1])) for r in odd_documents())
    found = quality.ledger(docs)
    assert bag(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == expected
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == found.where(quality.passes(quality.STRICT)).count()
    assert quality.ledger(none).count() == 0 and quality.keep(none).count() == 0
    alone = {(r["policy"], r["rule"]): (r["failing"], r["failing_alone"]) for r in quality.ablation(found, {"s": quality.STRICT}).collect()}
    for rule in quality.RULES:
        fails = found.where(rule.fails)
        assert alone.get(("s", rule.name), (0, 0)) == (fails.count(), fails.where(f"failed = {1 << rule.bit}").count())


def ids_of(text, end):
    encoder = Encoder(vocabulary())
    return np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(docs, none):
    rows = Counter()
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in packing.pack(docs).collect():
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024 and (end == 1024 or end & (end - 1) == 0)
    for i, text, *_ in odd_documents():
        ids = ids_of(text, 0)
        rows[i, len(ids)] += 1
        for r in pieces[i, len(ids)]:
            if i is not None:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for (i, n), count in rows.items():
        assert sum(r["length"] for r in pieces[i, n]) == n * count
    assert packing.pack(none).count() == 0


def test_classes_fill_whole_bins():
    bins = packing.HarmonicBins(100, 0)
    for k in range(9):
        bins.add(bytes([k]) * 4 * 33, k)
    done = bins.take()
    # Three of 33 make a bin; the one token that it lacks is the head of the next.
    assert [d[0] for d in done[:4]] == [0, 1, 2, 3] and [d[2] for d in done[:4]] == [33, 33, 33, 1]
    bins.finish()
    done += bins.take()
    assert sum(d[2] for d in done) == 9 * 33
    assert Counter(Counter(d[4] for d in done).values())[4] >= 2


@pytest.mark.parametrize("capacity", [1024, 96, 1])
def test_sequences_are_full_and_cuts_few(capacity):
    rng = np.random.default_rng(3)
    bins = packing.HarmonicBins(capacity, 7)
    documents = [rng.integers(0, 50_000, n).astype("<u4").tobytes() for n in (rng.lognormal(5, 1.3, 3000) + 1).astype(int)]
    for k, ids in enumerate(documents):
        bins.add(ids, k)
    bins.finish()
    done = bins.take()
    parts, lengths = defaultdict(list), Counter()
    for name, start, length, crc, sequence, offset in done:
        assert crc == zlib.crc32(documents[name][4 * start : 4 * (start + length)])
        assert offset == lengths[sequence]
        lengths[sequence] += length
        parts[name].append((start, length))
    for name, ids in enumerate(documents):
        end = 0
        for start, length in sorted(parts[name]):
            assert start == end
            end += length
        assert end == len(ids) // 4
    short = [n for n in lengths.values() if n != capacity]
    assert all(n & (n - 1) == 0 for n in short) and len(short) == len(set(short))
    assert len(done) <= len(documents) + 2 * len(lengths) + 12


def test_token_files(spark, docs, none, tmp_path):
    named = docs.where("doc_id IS NOT NULL")
    token_files.write_tokens(named, str(tmp_path / "a"))
    found = sorted(map(tuple, token_files.read_digests(spark, str(tmp_path / "a")).collect()))
    rows = sorted(((r[0], ids_of(r[1], 2)) for r in odd_documents() if r[0] is not None), key=lambda x: x[0])
    start, expected = 0, []
    for i, ids in rows:
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    segments = spark.read.parquet(str(tmp_path / "a")).collect()
    one = max(segments, key=lambda s: s["documents"]).asDict()
    names = token_files.names_of(one)
    texts = {r[0]: r[1] for r in odd_documents()}
    for k in range(one["documents"]):
        assert (token_files.document(one, k) == ids_of(texts[one["first_doc"] + names.select(k)], 2)).all()
    token_files.write_tokens(none, str(tmp_path / "b"))
    assert token_files.read_digests(spark, str(tmp_path / "b")).count() == 0


def test_token_files_without_ids(spark, docs, tmp_path):
    token_files.write_tokens(docs, str(tmp_path / "a"))
    found = token_files.read_digests(spark, str(tmp_path / "a")).collect()
    crc = lambda t: zlib.crc32(ids_of(t, 2).tobytes())
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in found) == Counter((r[0], crc(r[1])) for r in odd_documents())
    assert any(r["doc_id"] is None for r in found)
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda i: (i is None, i or 0))
    only = docs.where("doc_id IS NULL")
    token_files.write_tokens(only, str(tmp_path / "b"))
    assert token_files.read_digests(spark, str(tmp_path / "b")).where("doc_id IS NULL").count() == only.count()


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (500, 3), (2000, 10**6), (3000, 2**40)):
        values = np.sort(rng.integers(0, top, n))
        coded = token_files.EliasFano.of(values)
        assert (coded.values() == values).all()
        assert [coded.select(i) for i in range(n)] == values.tolist()
        assert 8 * (len(coded.low) + len(coded.high)) <= n * (3 + max(0, np.log2(max(top, 2) / max(n, 1)))) + 16


def test_encoder_is_the_tokenizer():
    import random

    import pyarrow as pa

    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "B", "é", "×", ".", ",", "'s", "'", "1", " ", "　", "ж", "漢", "\t", "!", "\x1c", "²", " the", "word"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    encoder = Encoder(vocabulary())
    found = [ids[a:b].tolist() for _, ids, o in encoder(pa.array(texts), 5000) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert found == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_mixing(docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    found = mixing.mix(docs).collect()
    assert len(found) == len(odd_documents())
    sizes = Counter()
    for r in odd_documents():
        sizes[r[3]] += len(brute.WORD.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    free, rest, target = set(order), sum(sizes.values()), {}
    while over := [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]:
        for s in over:
            target[s] = 3 * sizes[s]
            rest -= target[s]
            free.remove(s)
    target |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["whole"] * r["size"] + r["part"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1
    again = mixing.mix(docs.repartition(7))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found))
    assert mixing.mix(none).count() == 0


def test_mixing_takes_what_it_says(docs):
    plan = mixing.mix(docs)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    words = taken.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == plan.agg(F.sum("taken")).first()[0]


def test_pivot_keeps_words_and_odds():
    total = Counter()
    for seed in range(400):
        done, held = mixing.pivot([(1, 10, 0.3), (2, 10, 0.5), (3, 20, 0.6)], seed)
        words = sum({1: 10, 2: 10, 3: 20}[row] * n for row, n in done) + (held[1] * held[2] if held else 0)
        assert words == pytest.approx(20)
        for row, n in done:
            total[row] += n
        if held:
            total[held[0]] += held[2]
    for row, share in ((1, 0.3), (2, 0.5), (3, 0.6)):
        assert total[row] / 400 == pytest.approx(share, abs=0.07)


def test_licenses(spark, docs, none):
    mit = dict(licenses.LICENCES[::-1])["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + licenses.LICENCES[0][1].upper().replace("SUBLICENSE", "sub-licence")),
        (2, "text\nreleased under the  MIT Licence!\nmore"), (3, None), (4, ""), (5, "a licence is not a text"),
    ]
    found = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {1: ("MIT", ""), 2: (None, "MIT"), 3: (None, ""), 4: (None, ""), 5: (None, "")}
    assert mit and licenses.scan(docs).count() == len(odd_documents()) and licenses.scan(none).count() == 0


def test_whole_license_texts(spark):
    texts = {}
    for name, text in licenses.whole_texts():
        texts.setdefault(name, text)
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(texts)
    names = sorted(texts)
    ended = texts["Apache-2.0"].split("   END OF TERMS")[0]
    rows = [*enumerate(texts[n] for n in names), (100, ended), (101, " ".join(texts["GPL-3.0"].split())), (102, "My own terms:\nbe kind.")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(frame).collect()}
    assert found == {**dict(enumerate(names)), 100: "Apache-2.0", 101: "GPL-3.0", 102: None}
    own = spark.createDataFrame([("Kind", "My own terms: be kind"), ("Blank", "..")], "license string, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.scan(frame, licences=own).collect()}
    assert found == {**dict.fromkeys([*range(len(names)), 100, 101]), 102: "Kind"}


def test_license_lines_in_any_words(spark):
    named = [(n, " ".join(t.split())) for n, t in licenses.LICENCES if n in ("ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause")]
    named += [("CC0-1.0", "Released  under CC0 1.0."), ("CC0-1.0", "**Released** under CC0 1.0."), ("", "released underneath")]
    frame = spark.createDataFrame([(k, f"before\n{t}\nafter") for k, (_, t) in enumerate(named)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["notices"] for r in licenses.scan(frame).collect()} == {k: n for k, (n, _) in enumerate(named)}


def test_licenses_with_typographic_marks(spark):
    import textwrap

    mit = licenses.LICENCES[0][1]
    curly = mit.replace('"AS', "\u201cAS").replace('IS"', "IS\u201d").replace("(the", "\u2014 (the").replace(" to deal", "\u00a0to deal")
    apache = dict(licenses.whole_texts())["Apache-2.0"]
    texts = [
        ("MIT", curly), ("MIT", "Copyright Foo Inc.\n" + mit), ("MIT", "(c) Foo Inc.\n" + mit), ("MIT", "\u2022 Copyright \u2013 B\u00e4r GmbH\n\n" + curly),
        ("MIT", "\u00a9 Foo\n" + mit), (None, "Copyright holders be liable.\n" + mit),
    ]
    # Wherever the lines break, none that belongs to a licence may go.
    whole = {name: text for name, text in licenses.whole_texts()[::-1]}
    texts += [(name, textwrap.fill(" ".join(text.split()), w)) for name, text in licenses.LICENCES[:1] + licenses.LICENCES[5:9] for w in range(38, 100, 7)]
    frame = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["license"] for r in licenses.scan(frame).collect()} == {k: n for k, (n, _) in enumerate(texts)}
    flat = [(n, textwrap.fill(" ".join(t.split()), w, break_long_words=False)) for n, t in whole.items() if n in ("Apache-2.0", "CC0-1.0", "MPL-2.0") for w in (60, 72, 79, 95)]
    frame = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(flat)], "doc_id bigint, text string")
    assert apache and {r["doc_id"]: r["license"] for r in licenses.scan(frame).collect()} == {k: n for k, (n, _) in enumerate(flat)}
    lines = [(0, "\u2022\u00a0Released under the \u201cMIT License\u201d"), (1, "\u2013 Licensed under CC\u00a0BY 4.0 \u2013")]
    frame = spark.createDataFrame(lines, "doc_id bigint, text string")
    assert {r["doc_id"]: r["notices"] for r in licenses.scan(frame).collect()} == {0: "MIT", 1: "CC-BY-4.0"}


def test_hidden_markov(docs, none):
    found = hidden_markov.score(docs, "doc_id", "text").collect()
    rows = odd_documents()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*brute.WORD.findall((t or "").translate(brute.LOWER)), None]
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected, got = Counter(), Counter()
    for i, t, *_ in rows:
        words = tokens(t)
        base = sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        expected[i, held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)] += 1
    for r in found:
        got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)] += 1
        assert np.isfinite(r["score"]) and r["score"] < 0
    assert got == expected
    assert hidden_markov.score(none, "doc_id", "text").count() == 0


def test_forward_recursion_sums_over_paths():
    import itertools

    rng = np.random.default_rng(3)
    model = hidden_markov.Model.first(rng.integers(1, 9, hidden_markov.CLASSES).astype(float))
    symbols = rng.integers(0, hidden_markov.CLASSES, 9)
    firsts, lengths = np.array([0, 4, 5]), np.array([4, 1, 4])
    lanes = hidden_markov.Lanes(symbols, firsts, lengths)
    score, _, _ = lanes.forward(model)
    expected = hidden_markov.Lanes(symbols, firsts, lengths).expected(model)
    states, starts, moves = range(hidden_markov.STATES), np.zeros(hidden_markov.STATES), np.zeros((hidden_markov.STATES,) * 2)
    for k, (a, n) in enumerate(zip(firsts, lengths, strict=True)):
        odds = {}
        for path in itertools.product(states, repeat=int(n)):
            p = model.start[path[0]] * model.emit[symbols[a], path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * model.emit[symbols[a + t], path[t]]
            odds[path] = p
        total = sum(odds.values())
        assert score[k] == pytest.approx(np.log10(total))
        for path, p in odds.items():
            starts[path[0]] += p / total
            for x, y in zip(path, path[1:]):
                moves[x, y] += p / total
    s = hidden_markov.STATES
    assert expected[:s] == pytest.approx(starts)
    assert expected[s : s + s * s] == pytest.approx(moves.ravel())
    assert expected[s + s * s : -2].sum() == pytest.approx(lengths.sum())
    assert expected[-2:] == pytest.approx([score.sum(), lengths.sum()])


def test_hidden_markov_end_to_end(spark):
    """Scores against plain recursions, word by word, over the same first model and rounds."""
    from threadloom.llm.text import texts_of, words_of

    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = [(k, " ".join(rng.choice(["a", "b", "c", "D", "e.", "ff"], rng.integers(0, 12)))) for k in range(60)]
    held = [zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    lists = [[*brute.WORD.findall(t.translate(brute.LOWER)), None] for _, t in rows]
    names = sorted({w for ws in lists for w in ws if w})
    (texts,) = texts_of(pa.array([" ".join(names)]))
    hashes = dict(zip(names, words_of(texts, lower=True).hashes.tolist(), strict=True)) | {None: int(hidden_markov.END)}
    size = hidden_markov.CLASSES
    of = {w: (h & 0xFFFFFFFF) % size for w, h in hashes.items()}
    counts = Counter(w for ws, out in zip(lists, held, strict=True) if not out for w in ws)
    class_counts, class_types = np.zeros(size), np.zeros(size)
    for w, n in counts.items():
        class_counts[of[w]] += n
        class_types[of[w]] += 1

    def recursions(model, ws):
        alphas, log = [], 0.0
        for t, w in enumerate(ws):
            a = (model.start if t == 0 else alphas[-1] @ model.move) * model.emit[of[w]]
            log += np.log10(a.sum())
            alphas.append(a / a.sum())
        return alphas, log

    model, before, rounds = hidden_markov.Model.first(class_counts), None, 0
    while True:
        starts, moves, emits, log, tokens = np.zeros(6), np.zeros((6, 6)), np.zeros((size, 6)), 0.0, 0
        for ws, out in zip(lists, held, strict=True):
            if out:
                continue
            alphas, one = recursions(model, ws)
            log, tokens, beta = log + one, tokens + len(ws), np.ones(6)
            for t in range(len(ws) - 1, -1, -1):
                odds = alphas[t] * beta / (alphas[t] @ beta)
                emits[of[ws[t]]] += odds
                if t:
                    pairs = alphas[t - 1][:, None] * model.move * (model.emit[of[ws[t]]] * beta)[None, :]
                    moves += pairs / pairs.sum()
                    beta = model.move @ (model.emit[of[ws[t]]] * beta)
                    beta /= beta.sum()
                else:
                    starts += odds
        model, rounds = hidden_markov.Model.of(np.concatenate([starts, moves.ravel(), emits.ravel(), [0, 0]]), class_counts), rounds + 1
        if before is not None and log / tokens - before < hidden_markov.TOLERANCE:
            break
        before = log / tokens
    found = {r["doc_id"]: r["score"] for r in hidden_markov.score(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    for (k, _), ws in zip(rows, lists, strict=True):
        within = sum(np.log10((counts[w] + 1) / (class_counts[of[w]] + class_types[of[w]] + 1)) for w in ws)
        assert found[k] == pytest.approx(recursions(model, ws)[1] + within, abs=1e-6)
    assert rounds >= 2


def test_hidden_markov_beats_word_frequencies(spark):
    found = hidden_markov.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    sums = found.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert sums["score"] / sums["n"] > sums["base"] / sums["n"] + 0.02


def test_toxic_passages(spark, docs, none):
    rows, labels = [], []
    for k in range(400):
        words = prose(k + 1000, 120).split()
        toxic = k % 8 == 0
        if toxic:
            words[40:60] = [w for x in words[40:50] for w in (x, "vileword" if k % 16 else "nastyword")]
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.learn(frame, spark.createDataFrame([*labels[:300], (None, 1), (3, None)], "doc_id bigint, toxic int"))
    found = {r["doc_id"]: r for r in toxicity.passages(frame, model).collect()}
    assert all((found[k]["predicted"] == 1) == bool(y) for k, y in labels[300:])
    assert all(38 <= a and b <= 62 for k, y in labels[300:] if y for a, b in zip(found[k]["first"], found[k]["last"], strict=True))
    odd = toxicity.passages(docs, model)
    assert odd.count() == len(odd_documents()) and odd.where("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.passages(none, model).count() == 0
    blank = toxicity.learn(none, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.passages(docs, blank).where("predicted = 1").count() == 0


def test_maximal_segments_by_definition():
    """Every maximal segment is the best of its own sub-segments, and none can be joined to a better one."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        scores = np.where(rng.random(n) < 0.5, np.round(rng.random(n) * 2 + 0.1, 3), -0.15)
        places = np.flatnonzero(scores > 0)
        found = toxicity.maximal_segments(places.tolist(), scores[places].tolist(), 0.15)

        def split(a, b, scores=scores):
            best = max(((scores[i:j].sum(), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if not best or best[0] <= 0:
                return []
            i, j = best[3:]
            return [*split(a, i), (i, j - 1, best[0]), *split(j, b)]

        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in split(0, n)]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in split(0, n)])


def test_long_texts_in_windows(monkeypatch):
    """Windows of one text give each string once, under the anchor that it has in the whole."""
    import pyarrow as pa

    from threadloom.llm.text import texts_of

    (whole,) = texts_of(pa.array([prose(40, 700) + "é" * 100 + prose(41, 300)]))
    expected = {s + i: int(a) for _, s, n, a, _ in zip(*repeats.segments_of(whole), strict=True) for i in range(n)}
    monkeypatch.setattr(repeats, "SLICE", 300)
    found = []
    for texts, shift in repeats.windows_of(whole):
        assert len(texts.data) < 600
        found += [(shift + s + i, int(a)) for _, s, n, a, _ in zip(*repeats.segments_of(texts), strict=True) for i in range(n)]
    assert len(found) == len(expected) == len(whole.data) - repeats.LENGTH + 1 and dict(found) == expected


def test_long_texts_in_stretches(monkeypatch):
    import pyarrow as pa

    from threadloom.llm import collocations

    rows = pa.RecordBatch.from_pydict({"lang": ["en", "fr", "en"], "text": [prose(42, 900), "un deux. trois", prose(43, 900) + " no end of a piece" * 200]})

    def words():
        out = Counter()
        for part in collocations._encoded([rows]):
            for names, place, breaks in collocations._slices([part]):
                runs, at = [], part["lang"][0].as_py()
                for k, w in enumerate(names[place].tolist()):
                    if breaks[k]:
                        runs.append([])
                    runs[-1].append(w)
                out.update((at, tuple(run)) for run in runs)
        return out

    expected = words()
    monkeypatch.setattr(collocations, "SLICE", 100)
    assert words() == expected


def test_registered_queries_keep_their_contracts(spark):
    from threadloom.llm import queries

    folder = "/root/testdata/sf0.001"
    stored = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(stored) == 200
    packed = queries.QUERIES["op2_harmonic_packing"](spark, folder).collect()
    ends = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    pieces = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for name, text in stored.items():
        ids, end = ids_of(text, 0), 0
        for start, length in sorted(pieces[name]):
            assert start == end
            end += length
        assert end == len(ids)
    assert all(n == 1024 or n & (n - 1) == 0 for n in ends.values())
    toxic = {r["doc_id"]: r for r in queries.QUERIES["op10_toxic_segments"](spark, folder).collect()}
    assert set(toxic) == set(stored)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for i, r in toxic.items())
    removed = queries.QUERIES["op8_suffix_array_repeats"](spark, folder)
    names = sorted(stored)
    expected = Counter((i, *x) for i, x in zip(names, brute.repeats([stored[i] for i in names]), strict=True))
    assert bag(removed, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
