"""Rows that every operator on documents has to stand."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def odd_documents():
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies, shared passages."""
    long, base, passage = prose(1, 6000), prose(2, 300), prose(3, 60)
    near = base.split()
    near[7], near[200] = "changed", "words"
    texts = [
        (1, ""), (2, None), (3, "one"), (4, "one two three four"), (5, "One TWO three four"), (6, "a b c d e"),
        (7, base), (8, base), (9, base.upper()), (10, " ".join(near)), (11, long), (12, passage), (13, prose(4, 80) + "\n" + passage + "\n" + prose(5, 70)),
        (14, passage + " " + prose(6, 90)), (15, "é" * 300), (16, "x" * 500), (17, " \n\t "), (18, "ß ñ 漢字 " * 40), (None, base), (None, None), (7, base),
        (20, prose(7, 40) + "\n" + prose(7, 40)), (21, long + " tail"), (22, "word " * 50), (23, "<|endoftext|> a  b   c "), (24, "end of line\n\n  indented\n\nx"),
    ]
    rng = random.Random(9)
    for k in range(100, 130):
        words = near[:]
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = rng.choice(["other", "thing", "here"])
        texts.append((k, " ".join(words)))
    return [(i, t, "en" if k % 3 else None, None if k % 5 == 0 else f"s{k % 4}", 7) for k, (i, t) in enumerate(texts)]
