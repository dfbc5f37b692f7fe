"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def classes(pairs, n):
    """The least member that each of n members reaches over the pairs."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_classes(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows with ids."""
    sets = [shingles(t) for _, t in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    least = defaultdict(lambda: 1 << 62)
    found = classes(pairs, len(rows))
    for (name, _), c in zip(rows, found, strict=True):
        least[c] = min(least[c], name)
    return [(name, len(s), least[c]) for (name, _), s, c in zip(rows, sets, found, strict=True)]


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    twice = {k for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)


def regrafted(rows):
    """conv_id -> [(role, text)] of (conv_id, turn, role, text) rows, with the first turns of its stem."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((0, 0) if turn is None else (1, turn), (role or "").encode(), (text or "").encode()))
    own = {c: [(r.decode(), t.decode()) for _, r, t in sorted(x)] for c, x in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def trie(convs):
    """Rows of the prefix trie of conv_id -> list of turns."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    inside = {node: [0, 0] for node in members}
    kids = Counter(node[:-1] for node in members if node)
    for node, names in members.items():
        saved = (len(names) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            inside[node[:d]][0] += not kids[node]
            inside[node[:d]][1] += saved
    out = Counter()
    for node, names in members.items():
        ends = ",".join(str(c) for c in sorted(names) if len(convs[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out[(min(names), len(node), up, len(names), kids[node], *inside[node], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def collocations(rows, words, least, top):
    """Rows of the best phrases of (lang, text) rows."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for m in range(1, words + 1):
                counts[lang].update(tuple(found[i : i + m]) for i in range(len(found) - m + 1))
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in held.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        n, scored = totals[lang], []
        for p, a in held.items():
            if 100 * inside[p] < 100 * a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out
