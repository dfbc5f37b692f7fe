"""Thread building against a plain walk, deep chains, cycles, orphans, tree output."""

import json
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import threads

SHAPE = "link_id string, reddit_id string, parent_id string, ord bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def walk(rows):
    """(link, id) -> (depth, root) by following parents, None when unreachable."""
    parents = {(l.split("_")[-1], i): p.split("_")[-1] for l, i, p, _ in rows}
    out = {}
    for (link, node) in parents:
        path, at = [node], parents[(link, node)]
        while at != link and (link, at) in parents and at not in path:
            path.append(at)
            at = parents[(link, at)]
        out[(link, node)] = (len(path) - 1, path[-1]) if at == link else None
    return out


def placed(df):
    return {(r["link"], r["id"]): (r["depth"], r["root_comment_id"]) if r["reached"] else None for r in df.collect()}


def test_sample_of_two(spark):
    rows = [("t3_abc123", "qwerty1", "t3_abc123", 0), ("t3_abc123", "hjkl234", "t1_qwerty1", 1)]
    assert placed(threads.thread_depth(frame(spark, rows))) == {
        ("abc123", "qwerty1"): (0, "qwerty1"), ("abc123", "hjkl234"): (1, "qwerty1"),
    }


def test_chain_of_300_takes_few_rounds(spark):
    rows = [("t3_p", "c0", "t3_p", 0)] + [("t3_p", f"c{i}", f"t1_c{i - 1}", i) for i in range(1, 300)]
    random.Random(1).shuffle(rows)
    result = threads.thread_depth(frame(spark, rows)).cache()
    assert placed(result) == walk(rows)
    last = result.where("id = 'c299'").select(threads.path_ids().alias("p")).first()["p"]
    assert last == "/".join(f"c{i}" for i in range(300))


def test_missing_parents_and_cycles_are_orphans(spark):
    rows = [
        ("t3_p", "a", "t3_p", 0), ("t3_p", "b", "t1_gone", 1), ("t3_p", "c", "t1_b", 2),
        ("t3_p", "d", "t1_e", 3), ("t3_p", "e", "t1_d", 4), ("t3_p", "f", "t1_e", 5), ("t3_p", "g", "t1_g", 6),
        ("t3_q", "b", "t3_q", 0),
    ]
    result = threads.thread_depth(frame(spark, rows), with_path=False)
    orphans = {(r["link"], r["id"]) for r in threads.thread_orphans(result).collect()}
    assert orphans == {("p", x) for x in "bcdefg"}


@pytest.mark.parametrize("seed", [3, 4])
def test_random_forests(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for link in ("x", "y", "z"):
        ids = [f"{link}{i}" for i in range(60 if link != "x" else 400)]
        for n, i in enumerate(ids):
            kind = rnd.random()
            parent = f"t3_{link}" if n == 0 or kind < 0.1 else ("t1_gone" if kind < 0.13 else f"t1_{rnd.choice(ids)}" if kind < 0.2 else f"t1_{ids[max(0, n - rnd.randint(1, 3))]}")
            rows.append((f"t3_{link}", i, parent, n))
    rnd.shuffle(rows)
    assert placed(threads.thread_depth(frame(spark, rows), with_path=False)) == walk(rows)


def test_order_and_limits(spark):
    rows = [
        ("t3_p", "a", "t3_p", 0), ("t3_p", "b", "t1_a", 1), ("t3_p", "c", "t3_p", 2),
        ("t3_p", "d", "t1_b", 3), ("t3_p", "e", "t1_c", 4),
    ]
    result = threads.thread_depth(frame(spark, rows))
    ordered = threads.thread_raw_order(result).orderBy("position").collect()
    assert [r["id"] for r in ordered] == ["a", "c", "b", "e", "d"]
    assert [r["position"] for r in ordered] == [1, 2, 3, 4, 5]
    assert {r["id"] for r in threads.thread_limit(result, 1).collect()} == {"a", "b", "d"}
    assert {r["id"] for r in threads.thread_limit(result, 3, style="raw").collect()} == {"a", "c", "b"}
    assert threads.thread_limit(result, 0).count() == 5


def test_tree_fragments_join_to_nested_json(spark):
    rows = [
        ("t3_p", "a", "t3_p", 0), ("t3_p", "b", "t1_a", 1), ("t3_p", "c", "t1_b", 2), ("t3_p", "d", "t3_p", 3),
        ("t3_p", "e", "t1_a", 4), ("t3_q", "z", "t1_gone", 0),
    ]
    lines = threads.thread_tree_json(frame(spark, rows), ["id"]).orderBy("link", "line_no").collect()
    text = {}
    for line in lines:
        text[line["link"]] = text.get(line["link"], "") + line["fragment"]
    assert json.loads(text["p"]) == [
        {"id": "a", "replies": [{"id": "b", "replies": [{"id": "c", "replies": []}]}, {"id": "e", "replies": []}]},
        {"id": "d", "replies": []},
    ]
    assert json.loads(text["q"]) == []


def nested(rows):
    """The places of a plain walk: (link, id) -> (depth, enter, leave)."""
    reach, replies = walk(rows), {}
    for link, i, up, at in sorted(rows, key=lambda r: (r[3], r[1])):
        replies.setdefault((link.split("_")[-1], up.split("_")[-1]), []).append(i)
    out = {}
    for link in {r[0].split("_")[-1] for r in rows}:
        step, stack = 0, [(i, 0, False) for i in reversed(replies.get((link, link), []))]
        while stack:
            i, depth, closes = stack.pop()
            if closes:
                out[(link, i)] = (depth, out[(link, i)], step)
            else:
                out[(link, i)] = step
                stack.append((i, depth, True))
                stack += [(x, depth + 1, False) for x in reversed(replies.get((link, i), []))]
            step += 1
    assert set(out) == {k for k, v in reach.items() if v}
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_tour_against_a_plain_walk(spark, seed):
    rnd = random.Random(seed)
    rows = [("t3_cycle", "a", "t1_b", 0), ("t3_cycle", "b", "t1_a", 1), ("t3_cycle", "c", "t3_cycle", 2), ("t3_gone", "x", "t1_y", 0)]
    for link in ("x", "y"):
        ids = [f"{link}{i}" for i in range(90)]
        rows += [(f"t3_{link}", i, f"t3_{link}" if n == 0 or rnd.random() < 0.1 else f"t1_{rnd.choice([*ids[:n], 'gone'])}", rnd.randint(0, 9)) for n, i in enumerate(ids)]
    rows += [("t3_hot", f"h{i}", "t3_hot", i % 7) for i in range(300)]
    rnd.shuffle(rows)
    found = {(r["link"], r["id"]): (r["depth"], r["enter"], r["leave"]) for r in threads.thread_tour(frame(spark, rows)).collect()}
    assert found == nested(rows)
    assert all(r["size"] == (r["leave"] - r["enter"] + 1) // 2 for r in threads.thread_tour(frame(spark, rows)).collect())
    assert threads.thread_tour(frame(spark, [])).count() == 0


def chain_of(spark, n):
    up = F.when(F.col("id") == 0, "t3_p").otherwise(F.concat(F.lit("t1_c"), F.col("id") - 1))
    return spark.range(n).select(F.lit("t3_p").alias("link_id"), F.concat(F.lit("c"), "id").alias("reddit_id"), up.alias("parent_id"), F.col("id").alias("ord"))


def test_one_chain_of_56107_comments(spark):
    n = 56_107
    tour = threads.thread_tour(chain_of(spark, n)).cache()
    wrong = tour.where("id <> concat('c', depth) or enter <> depth or leave <> 2 * 56107 - 1 - depth or size <> 56107 - depth")
    assert tour.count() == n and wrong.count() == 0


def test_tree_of_a_deep_chain(spark):
    n = 1500
    lines = threads.thread_tree_json(chain_of(spark, n), ["id"]).orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == list(range(1, 2 * n + 3))
    assert "".join(r["fragment"] for r in lines) == "[" + "".join(f'{{"id":"c{i}","replies":[' for i in range(n)) + "]}" * n + "]"


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_flatten_nested_of_any_depth(spark, levels):
    node = None
    for i in reversed(range(20)):
        node = {"body": f"b{i}", "replies": [node] if node else []}
    docs = spark.createDataFrame(
        [(1, json.dumps([node, {"body": "x", "replies": []}])), (2, "[]")], "doc int, j string"
    ).select("doc", F.from_json("j", "array<variant>").alias("comments"))
    flat = threads.flatten_nested(docs, levels_per_pass=levels).select(
        "doc", "depth", F.try_variant_get("comment", "$.body", "string").alias("body")
    )
    assert sorted(map(tuple, flat.collect())) == sorted([(1, i, f"b{i}") for i in range(20)] + [(1, 0, "x")])


def test_flatten_takes_only_what_is_asked_for(spark):
    nested = '[{"body":"a","replies":[{"body":"b","replies":[{"body":"c","replies":[]}]}]},{"body":null}]'
    docs = spark.createDataFrame([(1, nested)], "doc int, j string").select("doc", F.from_json("j", "array<variant>").alias("comments"))
    flat = threads.flatten_nested(docs, levels_per_pass=2, take=lambda c: F.try_variant_get(c, "$.body", "string"))
    assert flat.schema["comment"].dataType.simpleString() == "string"
    assert sorted(map(tuple, flat.collect()), key=str) == [(1, 0, "a"), (1, 0, None), (1, 1, "b"), (1, 2, "c")]
